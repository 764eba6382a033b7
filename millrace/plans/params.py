"""Parameters the registered queries pass on the driver tables.

Fixed values of our own for the synthetic prose (the reference's own term
lists are domain words that the test prose does not contain).
"""

# Wanted and unwanted queries built from words the prose holds.
POS_QUERY = "th er nd ha tion ing ed es en re the, of, and,"
NEG_QUERY = "der die und den von zu das mit sich auf des für ist nicht"

# Composite terms to close up (list order, case-sensitive).
COMPOSITE_TERMS = ["of the", "in the", "der die", "de la"]

MIN_TOKENS = 100
MAX_TOKENS = 1000
KEEP_FRACTION = 0.8
OVERRIDE_SOURCE = "src3"
