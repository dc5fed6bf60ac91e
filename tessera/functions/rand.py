"""Keyed uniform random numbers.

``rand()`` draws differ when a task is retried on another executor, which would
change a selected center after an executor loss.  Every random choice in the
library is instead a pure function of ``(seed, round, key...)``: the first 13 hex
digits (52 bits) of ``md5("seed:round:key...")`` divided by 2^52, a uniform value
in [0, 1).  DuckDB computes the same number with
``('0x' || substr(md5(s), 1, 13))::BIGINT / 4503599627370496.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2**52)


def u01(seed: int, round_: int | str, *cols: str) -> Column:
    """Uniform [0,1) double determined by seed, round (a number or a short label) and the key columns."""
    return F.expr(u01_spark_sql(seed, round_, *cols))


def u01_spark_sql(seed: int, round_: int | str, *cols: str) -> str:
    """:func:`u01` as Spark SQL text over column names."""
    keys = ", ".join(f"CAST(`{c}` AS STRING)" for c in cols)
    h = f"substring(md5(concat_ws(':', '{int(seed)}', '{round_}', {keys})), 1, 13)"
    return f"(CAST(conv({h}, 16, 10) AS BIGINT) / {TWO_POW_52!r}D)"


def u01_sql(seed: int, round_: int | str, *key_sql: str) -> str:
    """The same number as DuckDB SQL text (used by the oracle queries)."""
    parts = " || ':' || ".join([f"'{int(seed)}'", f"'{round_}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return f"(CAST('0x' || substr(md5({parts}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def u01_value(seed: int, round_: int | str, *keys: object) -> float:
    """The same number for literal keys, computed in Python (for scalar draws)."""
    import hashlib

    text = ":".join([str(int(seed)), str(round_)] + [str(k) for k in keys])
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / TWO_POW_52
