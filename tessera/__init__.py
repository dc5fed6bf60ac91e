"""tessera: statistics, word counting and point selection on Spark DataFrames.

Every public operator takes DataFrames (plus plain Python parameters) and
returns a DataFrame; Catalyst plans the work.  Random choices come from a
keyed hash (``functions.rand.u01``) so that reruns and task retries repeat.
"""

__version__ = "0.1.0"
