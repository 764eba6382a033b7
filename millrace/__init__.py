"""millrace: corpus curation and instruction-dataset building on Spark.

Every public function takes and returns DataFrames (or Columns); term lists,
limits, templates and clients are arguments.
"""

__all__ = ["session"]
