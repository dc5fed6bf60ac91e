"""Operators for preparing training corpora.

Nothing outside this folder imports it but ``tables`` (what its tasks need on workers); ``queries`` holds the registered
queries.  Operators take and return DataFrames, read ``spark.checkpoint.dir``
from the session for intermediate tables, and treat null texts as empty.
"""
