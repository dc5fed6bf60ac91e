"""DuckDB oracle text for the point queries.

Iterative selections are unrolled: one materialized CTE per round, so the
oracle follows the same greedy order as the Spark loop.  Squared distances
are summed left to right over the dimensions, as in the Spark expression.
"""

from __future__ import annotations

from tessera.functions.rand import u01_sql

POINTS = "p AS MATERIALIZED (SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def sqd(a: str, b: str) -> str:
    return (
        f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])),"
        " lambda x, y: x + y)"
    )


def mass(m: str, w: str, exponent: float) -> str:
    if exponent == 2:
        return f"({w} * {m})"
    if exponent == 4:
        return f"({w} * ({m} * {m}))"
    return f"({w} * pow({m}, {exponent / 2.0}))"


def traverse(
    src: str,
    k: int,
    prefix: str,
    blocked: bool = False,
    first: str = "min",
    seed: int | None = None,
    kind: str = "farthest",
    exponent: float = 2.0,
    weighted: bool = False,
) -> tuple[list[str], str]:
    """CTEs for farthest-first (``kind="farthest"``) or k-means++ (``"pp"``).

    ``src`` names a CTE with ``id, v`` (plus ``block`` if ``blocked``, ``w`` if
    ``weighted``).  Returns the CTE list and the name of the final result CTE
    (``block, pos, id, v``).
    """
    blk = "block" if blocked else "0"
    qblk = "q.block" if blocked else "0"
    w = "q.w" if weighted else "1.0"
    ctes = []
    if first == "min":
        pick0 = f"SELECT {blk} AS block, min(id) AS cid FROM {src} GROUP BY ALL"
    elif first == "seed":
        pick0 = f"SELECT {blk} AS block, arg_min(id, ({u01_sql(seed, 0, 'id')}, id)) AS cid FROM {src} GROUP BY ALL"
    else:  # a literal id
        pick0 = f"SELECT 0 AS block, CAST({int(first)} AS BIGINT) AS cid"
    ctes.append(f"{prefix}c0 AS MATERIALIZED ({pick0})")
    ctes.append(
        f"{prefix}s0 AS MATERIALIZED (SELECT {qblk} AS block, q.id, q.v, {w} AS w, {sqd('q.v', 'cv.v')} AS m,"
        f" CASE WHEN q.id = c.cid THEN 0 END AS pos"
        f" FROM {src} q JOIN {prefix}c0 c ON {qblk} = c.block JOIN {src} cv ON cv.id = c.cid)"
    )
    for h in range(1, k):
        prev = f"{prefix}s{h - 1}"
        if kind == "farthest":
            pick = f"SELECT block, arg_max(id, (m, -id)) AS cid FROM {prev} WHERE pos IS NULL GROUP BY block"
        else:
            ms = mass("m", "w", exponent)
            race = f"(-ln(1.0 - {u01_sql(seed, h, 'id')}) / {ms})"
            pick = (
                f"SELECT block, coalesce(arg_min(id, ({race}, id)) FILTER (WHERE {ms} > 0), min(id)) AS cid"
                f" FROM {prev} WHERE pos IS NULL GROUP BY block"
            )
        ctes.append(f"{prefix}c{h} AS MATERIALIZED ({pick})")
        upd_m = "s.m" if h == k - 1 else f"CASE WHEN s.pos IS NULL THEN least(s.m, {sqd('s.v', 'cv.v')}) ELSE s.m END"
        ctes.append(
            f"{prefix}s{h} AS MATERIALIZED (SELECT s.block, s.id, s.v, s.w, {upd_m} AS m,"
            f" CASE WHEN s.pos IS NULL AND s.id = c.cid THEN {h} ELSE s.pos END AS pos"
            f" FROM {prev} s JOIN {prefix}c{h} c ON s.block = c.block JOIN {src} cv ON cv.id = c.cid)"
        )
    ctes.append(
        f"{prefix}res AS MATERIALIZED (SELECT CAST(block AS INTEGER) AS block, CAST(pos AS INTEGER) AS pos, id, v"
        f" FROM {prefix}s{k - 1} WHERE pos IS NOT NULL)"
    )
    return ctes, f"{prefix}res"


def matching(src: str, k: int, prefix: str) -> tuple[list[str], str]:
    """Greedy farthest-pair matching over CTE ``src(id, v)``; result ``pos, id``."""
    ctes = [
        f"{prefix}pr AS MATERIALIZED (SELECT a.id AS i, b.id AS j, sqrt({sqd('a.v', 'b.v')}) AS d"
        f" FROM {src} a JOIN {src} b ON a.id < b.id)"
    ]
    used = []
    parts = []
    for r in range(k // 2):
        cond = ""
        if used:
            lst = " UNION ALL ".join(used)
            cond = f" WHERE i NOT IN ({lst}) AND j NOT IN ({lst})"
        ctes.append(f"{prefix}m{r} AS MATERIALIZED (SELECT i, j FROM {prefix}pr{cond} ORDER BY d DESC, i, j LIMIT 1)")
        used += [f"SELECT i FROM {prefix}m{r}", f"SELECT j FROM {prefix}m{r}"]
        parts += [f"SELECT {2 * r} AS pos, i AS id FROM {prefix}m{r}", f"SELECT {2 * r + 1} AS pos, j AS id FROM {prefix}m{r}"]
    if k % 2:
        cond = f" WHERE id NOT IN ({' UNION ALL '.join(used)})" if used else ""
        parts.append(f"SELECT {k - 1} AS pos, min(id) AS id FROM {src}{cond}")
    ctes.append(
        f"{prefix}res AS MATERIALIZED (SELECT CAST(o.pos AS INTEGER) AS pos, o.id, s.v"
        f" FROM ({' UNION ALL '.join(parts)}) o JOIN {src} s ON s.id = o.id)"
    )
    return ctes, f"{prefix}res"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
