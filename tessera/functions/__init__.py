"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from tessera.functions.rand import u01
from tessera.functions.text import fold_key, split_lines, tokenize
from tessera.functions.vectors import l2dist, sqdist, to_vector

__all__ = ["u01", "fold_key", "split_lines", "tokenize", "l2dist", "sqdist", "to_vector"]
