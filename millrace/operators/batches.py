"""Prompt jobs with a commit log (PIP-8): batches are cut first, every commit is written once and then named in a manifest.

A commit holds the open rows of some consecutive batches. Its results are written to a folder of their own and
count from the moment the manifest has its entry: a job that is lost repeats the open commit at most, and what
it left half written is overwritten. Resuming asks for rows without a committed result only; rows whose call
failed have an ``error`` and are asked again on demand.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import prompting as PR
from millrace.sources import io as IO
from millrace.session import scratch_path

RESULT_SCHEMA = "url string, source string, content string, task string, total_tokens bigint, generated_text string, costs double, error string"
MANIFEST_SCHEMA = "commit bigint, first_batch bigint, last_batch bigint, n_rows bigint, n_failed bigint"


class CommitLog:
    """Results of one job under ``folder``; ``key`` tells its rows apart (null keys are never seen as done)."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "url", schema: str = RESULT_SCHEMA):
        self.spark, self.folder, self.key, self.schema = spark, folder.rstrip("/"), key, schema

    def manifest(self) -> DataFrame:
        """One row a commit."""
        path = f"{self.folder}/manifest"
        if not IO.path_exists(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(path)

    def attempts(self) -> DataFrame:
        """All committed rows, with their ``commit``; a folder that the manifest does not name is not read."""
        path, named = f"{self.folder}/results", self.manifest().select("commit")
        if not IO.path_exists(self.spark, path):
            return self.spark.createDataFrame([], self.schema + ", commit bigint")
        rows = IO.read_csv(self.spark, path, self.schema + ", commit bigint")
        return rows.join(named, "commit", "left_semi")

    def results(self) -> DataFrame:
        """The result of each row: its last attempt (failed ones are asked again only on demand)."""
        rows = self.attempts()
        last = rows.groupBy(F.col(self.key).alias("_key")).agg(F.max("commit").alias("_last"))
        return rows.join(last, F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("commit") == F.col("_last")), "left_semi").drop("commit")

    def done(self, retry_failed: bool = False) -> DataFrame:
        rows = self.attempts()
        return (rows.where("error IS NULL") if retry_failed else rows).select(self.key)

    def _commit(self, number: int, out: DataFrame, first: int, last: int) -> None:
        IO.write_csv(out, f"{self.folder}/results/commit={number}", "overwrite")
        written = IO.read_csv(self.spark, f"{self.folder}/results/commit={number}", self.schema)
        entry = written.agg(F.count(F.lit(1)).alias("n_rows"), F.count("error").alias("n_failed"))
        entry = entry.select(*[F.lit(v).cast("long").alias(n) for n, v in (("commit", number), ("first_batch", first), ("last_batch", last))], "n_rows", "n_failed")
        entry.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/commit={number}")

    def run(
        self,
        rows: DataFrame,
        task: str | Column,
        template: str | Column,
        client_factory: Callable,
        order: list,
        batch_size: int = 20,
        batches_per_commit: int = 1,
        system_prompt: str | None = None,
        retry_failed: bool = False,
        head: int | None = None,
        at_once: int = 1,
    ) -> list[int]:
        """Ask for every row of ``rows`` that has no result yet, commit by commit; returns the numbers of the commits made.

        Batches of ``batch_size`` rows in ``order`` (unique) are cut over all rows, done or not, so they may be
        short (WIN-2); one commit, one Spark job, takes ``batches_per_commit`` of them. ``head``: only the first
        rows in ``order`` (SRT-2). An error outside the calls ends the run; what was committed stays. A commit is a
        small job that leaves most of a cluster idle: ``at_once`` of them run side by side, and a lost run repeats
        these at most.
        """
        if head is not None:
            rows = rows.orderBy(*order).limit(head)
        cut = PR.batch_numbers(rows, order, batch_size, "_batch")
        todo = PR.pending(cut, self.done(retry_failed), self.key)
        todo = todo.withColumn("_commit", F.floor(F.col("_batch") / batches_per_commit))
        path = scratch_path(self.spark, "prompt-batches")
        # a folder a commit: each job reads its own rows only
        todo.repartition("_commit", F.pmod(F.xxhash64(self.key), F.lit(16))).write.partitionBy("_commit").parquet(path)
        held = self.spark.read.schema(todo.schema).parquet(path)
        # one row a commit
        waiting = held.groupBy("_commit").agg(F.min("_batch").alias("first"), F.max("_batch").alias("last")).orderBy("_commit").collect()
        number = (self.manifest().agg(F.max("commit")).first()[0] or 0) + 1
        commits = list(enumerate(waiting, number))

        def commit(n: int, w) -> None:
            part = held.where(F.col("_commit") == w["_commit"])
            self._commit(n, PR.run_prompts(part, template, task, client_factory, system_prompt), w["first"], w["last"])

        if at_once <= 1:
            for n, w in commits:
                commit(n, w)
        else:
            with ThreadPoolExecutor(at_once) as pool:
                jobs = [pool.submit(inheritable_thread_target(self.spark)(commit), n, w) for n, w in commits]
                ended, later = wait(jobs, return_when=FIRST_EXCEPTION)
                for job in later:  # after an error, what has not begun is left for the next run
                    job.cancel()
                for job in ended:
                    job.result()
        return [n for n, _ in commits]
