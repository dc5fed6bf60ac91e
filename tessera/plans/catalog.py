"""The registered queries: one Spark callable and one DuckDB oracle per name.

Every query reads whole fixture tables (``sf_dir``) and nothing else.  Doubles
that come out of a sum are rounded to 6 places on both sides, because the
order of a floating-point sum differs between engines and between runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.rand import u01_sql, u01_value
from tessera.functions.vectors import norm2
from tessera.operators import numeric, sampling, selection, vectors, wordcount
from tessera.plans import sql_text as T
from tessera.plans import sql_vec as V
from tessera.session import scratch_path
from tessera.sources.sinks import write_numbers, write_points, write_scored_points
from tessera.sources.tables import lines_from, load_table, numbers_from, points_from
from tessera.sources.text import read_lines, read_numbers, read_points

QueryFn = Callable[[SparkSession, str], DataFrame]

ROUND = 6
SALT_SEED = 0
TOP_K = 20
SEED = 5  # k-means++ draws, random first points
BLOCK_SEED = 0  # block assignment
BLOCKS = 4
K_CENTER = 6
K_PP = 5
K1 = 20
K_DIV = 6
K_NEAREST = 5


def _r(c: str, alias: str | None = None):
    return F.round(F.col(c), ROUND).alias(alias or c)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(load_table(spark, sf_dir, "documents"))


# --------------------------------------------------------------------------- numbers


def q_num_summary(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "events"), "value")
    s = numeric.summary(nums)
    return s.select("n", _r("total"), _r("mean"), _r("var_pop"), _r("var_moments"))


def q_num_abs_dev(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "events"), "value", "event_id")
    return numeric.abs_deviation(nums, "value", "event_id").select("event_id", _r("abs_dev"))


def q_num_min_abs_dev(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "events"), "value")
    return numeric.min_abs_deviation(nums).select(_r("min_dev"))


def q_num_min_abs_dev_sorted(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "events"), "value")
    return numeric.min_abs_deviation_sorted(nums).select(_r("min_dev"))


def q_num_residue_sums(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "lineitem"), "l_quantity")
    return numeric.residue_sums(nums).select("residue", "label", _r("total"), "n")


def q_num_residue_sums_signed(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer")
    nums = cust.select(F.floor("c_acctbal").cast("double").alias("value"))
    return numeric.residue_sums(nums).select("residue", "label", _r("total"), "n")


def q_num_population_variance(spark, sf_dir):
    nums = numbers_from(load_table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return numeric.population_variance(nums).select(_r("var_pop"), F.round("var_moments", 2).alias("var_moments"))


_NUM_SQL = {
    "num_summary": """SELECT count(value) AS n, round(sum(value), 6) AS total, round(avg(value), 6) AS mean,
        round(var_pop(value), 6) AS var_pop, round(avg(value * value) - pow(avg(value), 2), 6) AS var_moments
        FROM events""",
    "num_abs_dev": """SELECT event_id, round(abs(value - (SELECT avg(value) FROM events)), 6) AS abs_dev FROM events""",
    "num_min_abs_dev": """SELECT round(min(abs(value - (SELECT avg(value) FROM events))), 6) AS min_dev FROM events""",
    "num_min_abs_dev_sorted": """SELECT round(d, 6) AS min_dev FROM (
        SELECT abs(value - (SELECT avg(value) FROM events)) AS d FROM events ORDER BY d LIMIT 1)""",
    "num_residue_sums": """SELECT r AS residue, CASE WHEN r = 0 THEN 'even' ELSE 'odd' END AS label,
        round(sum(v), 6) AS total, count(v) AS n
        FROM (SELECT CAST(l_quantity AS DOUBLE) AS v, (CAST(l_quantity AS DOUBLE) % 2.0) + 0.0 AS r FROM lineitem)
        GROUP BY r""",
    "num_residue_sums_signed": """SELECT r AS residue, CASE WHEN r = 0 THEN 'even' ELSE 'odd' END AS label,
        round(sum(v), 6) AS total, count(v) AS n
        FROM (SELECT CAST(floor(c_acctbal) AS DOUBLE) AS v, (CAST(floor(c_acctbal) AS DOUBLE) % 2.0) + 0.0 AS r
              FROM customer)
        GROUP BY r""",
    "num_population_variance": """SELECT round(var_pop(l_extendedprice), 6) AS var_pop,
        round(avg(l_extendedprice * l_extendedprice) - pow(avg(l_extendedprice), 2), 2) AS var_moments FROM lineitem""",
}


# --------------------------------------------------------------------------- text


def q_txt_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def q_txt_lines_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "lines-text")
    _lines(spark, sf_dir).select("line").write.text(path)
    return read_lines(spark, path).select("line")


def q_txt_tokens(spark, sf_dir):
    return wordcount.tokens(_lines(spark, sf_dir))


def q_txt_word_count(spark, sf_dir):
    return wordcount.word_count(_lines(spark, sf_dir))


def q_txt_word_count_line_folded(spark, sf_dir):
    return wordcount.word_count_line_folded(_lines(spark, sf_dir))


def q_txt_word_count_salted(spark, sf_dir):
    n_lines = wordcount.line_count(load_table(spark, sf_dir, "documents"))
    return wordcount.word_count_salted(_lines(spark, sf_dir), seed=SALT_SEED, n_lines=n_lines)


def q_txt_word_frequency(spark, sf_dir):
    return wordcount.word_frequency(wordcount.word_count(_lines(spark, sf_dir)))


def q_txt_top_words(spark, sf_dir):
    return wordcount.top_words(wordcount.word_count(_lines(spark, sf_dir)), TOP_K)


_SALT = u01_sql(SALT_SEED, 0, "doc_id", "line_no", "fold")

_TXT_SQL = {
    "txt_lines": T.with_(T.LINES) + "SELECT doc_id, line_no, line FROM lines",
    "txt_lines_roundtrip": T.with_(T.LINES) + "SELECT line FROM lines",
    "txt_tokens": T.with_(T.LINES, T.TOKENS) + "SELECT doc_id, line_no, pos, word FROM toks",
    "txt_word_count": T.with_(T.LINES, T.TOKENS, T.WORD_COUNT) + "SELECT word, n FROM wc",
    "txt_word_count_line_folded": T.with_(T.LINES, T.TOKENS, T.PER_LINE)
    + "SELECT word, CAST(sum(n) AS BIGINT) AS n FROM per_line GROUP BY word",
    "txt_word_count_salted": T.with_(
        T.LINES,
        T.TOKENS,
        T.PER_LINE,
        "nl AS (SELECT count(*) AS nlines FROM lines)",
        f"salted AS (SELECT p.*, CAST(floor({_SALT} * sqrt(CAST(nl.nlines AS DOUBLE))) AS BIGINT) AS salt"
        " FROM per_line p, nl)",
        "r1 AS (SELECT salt, fold, arg_max(word, (doc_id, line_no)) AS word, sum(n) AS n"
        " FROM salted GROUP BY salt, fold)",
    )
    + "SELECT word, CAST(sum(n) AS BIGINT) AS n FROM r1 GROUP BY word",
    "txt_word_frequency": T.with_(T.LINES, T.TOKENS, T.WORD_COUNT) + "SELECT n, word FROM wc ORDER BY n DESC, word",
    "txt_top_words": T.with_(T.LINES, T.TOKENS, T.WORD_COUNT)
    + f"SELECT word, n FROM wc ORDER BY n DESC, word LIMIT {TOP_K}",
}


# --------------------------------------------------------------------------- points


def _points(spark, sf_dir) -> DataFrame:
    return points_from(load_table(spark, sf_dir, "embeddings"))


def _coreset(spark, sf_dir) -> DataFrame:
    pts = sampling.with_block(_points(spark, sf_dir), BLOCKS, BLOCK_SEED)
    return selection.kcenter_blocks(pts, K_CENTER)


def q_num_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "numbers-text")
    write_numbers(numbers_from(load_table(spark, sf_dir, "events"), "value"), path)
    return read_numbers(spark, path)


def q_vec_points_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "points-text")
    write_points(_points(spark, sf_dir), path, fmt="text")
    back = read_points(spark, path, with_id=True)
    return back.select("id", F.size("v").alias("dim"), F.round(norm2("v"), ROUND).alias("norm2"))


def q_vec_weights(spark, sf_dir):
    pts = _points(spark, sf_dir)
    unit = sampling.with_weights(pts, "unit", col="w_unit")
    both = sampling.with_weights(unit, "random", seed=SEED, col="w_random")
    return both.select("id", "w_unit", "w_random")


def _kc_centers(spark, sf_dir, k=K_NEAREST):
    return selection.kcenter(_points(spark, sf_dir), k)


def q_vec_nearest_center(spark, sf_dir):
    nc = vectors.nearest_center(_points(spark, sf_dir), _kc_centers(spark, sf_dir).select("id", "v"))
    return nc.select("id", "center_id", _r("sqdist"))


def q_vec_points_in(spark, sf_dir):
    return vectors.points_in(_points(spark, sf_dir), _kc_centers(spark, sf_dir).select("id", "v")).select("id")


def q_vec_points_not_in(spark, sf_dir):
    return vectors.points_not_in(_points(spark, sf_dir), _kc_centers(spark, sf_dir).select("id", "v")).select("id")


def q_vec_kmeans_objective(spark, sf_dir):
    c = _kc_centers(spark, sf_dir).select("id", "v")
    both = vectors.kmeans_objectives(_points(spark, sf_dir), c)
    return both.select(_r("obj_non_center"), _r("obj_all"))


def q_vec_pairwise(spark, sf_dir):
    return vectors.pairwise_distances(_coreset(spark, sf_dir).select("id", "v")).select("i", "j", _r("dist"))


def q_vec_farthest_pair(spark, sf_dir):
    return vectors.farthest_pair(_coreset(spark, sf_dir).select("id", "v")).select("i", "j", _r("dist"))


def q_vec_mean_pairwise(spark, sf_dir):
    return vectors.mean_pairwise_distance(_coreset(spark, sf_dir).select("id", "v")).select(_r("avg_dist"))


def q_sel_random_point(spark, sf_dir):
    return sampling.random_point(_points(spark, sf_dir), SEED).select("id")


def _mass_cdf(spark, sf_dir):
    pts = _points(spark, sf_dir)
    first = sampling.random_point(pts, SEED)
    return sampling.cumulative_mass(sampling.sampling_mass(pts, first, 2.0))


def q_sel_sampling_mass(spark, sf_dir):
    return _mass_cdf(spark, sf_dir).select("id", _r("mass"), _r("cdf"))


DRAW_R = u01_value(SEED, "r")


def q_sel_draw_by_cdf(spark, sf_dir):
    return sampling.draw_by_cdf(_mass_cdf(spark, sf_dir), DRAW_R)


def q_sel_kcenter(spark, sf_dir):
    return selection.kcenter(_points(spark, sf_dir), K_CENTER).select("pos", "id")


def q_sel_kcenter_seeded(spark, sf_dir):
    return selection.kcenter(_points(spark, sf_dir), K_CENTER, seed=SEED).select("pos", "id")


def q_sel_kmeanspp(spark, sf_dir):
    return selection.kmeanspp(_points(spark, sf_dir), K_PP, seed=SEED).select("pos", "id")


def q_sel_kmeanspp_weighted(spark, sf_dir):
    pts = sampling.with_weights(_points(spark, sf_dir), "random", seed=SEED)
    return selection.kmeanspp(pts, K_PP, seed=SEED, weight_col="w").select("pos", "id")


def q_sel_kmeanspp_as_coded(spark, sf_dir):
    return selection.kmeanspp(_points(spark, sf_dir), K_PP, seed=SEED, exponent=4.0).select("pos", "id")


def q_sel_seed_and_score(spark, sf_dir):
    return selection.seed_and_score(_points(spark, sf_dir), K_PP, seed=SEED).select(_r("objective"))


def q_sel_coreset_kmeans(spark, sf_dir):
    return selection.coreset_kmeans(_points(spark, sf_dir), K1, K_PP, seed=SEED).select(_r("objective"))


def q_sel_kcenter_blocks(spark, sf_dir):
    return _coreset(spark, sf_dir).select("block", "pos", "id")


def q_sel_kcenter_blocks_mod(spark, sf_dir):
    pts = sampling.with_block(_points(spark, sf_dir), BLOCKS, method="mod")
    return selection.kcenter_blocks(pts, K_CENTER).select("block", "pos", "id")


def q_sel_max_matching(spark, sf_dir):
    return selection.max_matching(_coreset(spark, sf_dir).select("id", "v"), K_DIV).select("pos", "id")


def q_sel_max_matching_odd(spark, sf_dir):
    return selection.max_matching(_coreset(spark, sf_dir).select("id", "v"), K_DIV - 1).select("pos", "id")


def q_sel_diversify(spark, sf_dir):
    return selection.diversify(_points(spark, sf_dir), K_DIV, BLOCKS, seed=BLOCK_SEED).select("pos", "id")


def q_sel_diversify_score(spark, sf_dir):
    _, score = selection.diversify_and_score(_points(spark, sf_dir), K_DIV, BLOCKS, seed=BLOCK_SEED)
    return score.select("k", _r("avg_dist"))


def q_sel_scored_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "scored")
    result, score = selection.diversify_and_score(_points(spark, sf_dir), K_DIV, BLOCKS, seed=BLOCK_SEED)
    write_scored_points(result.select("id", "v"), score, path)
    fields = F.split("value", ",")
    back = spark.read.text(f"{path}/score").select(fields[0].cast("int").alias("k"), fields[1].cast("double").alias("avg_dist"))
    points = read_points(spark, f"{path}/points", with_id=True).select("id", F.size("v").alias("dim"))
    return points.select("id", "dim", back.select("k").scalar().alias("k"), F.round(back.select("avg_dist").scalar(), ROUND).alias("avg_dist"))


def _vec_sql() -> dict[str, str]:
    P = V.POINTS
    sq = V.sqd
    out: dict[str, str] = {}
    out["num_text_roundtrip"] = "SELECT value FROM events"
    out["vec_points_roundtrip"] = V.with_(P) + (
        "SELECT id, CAST(len(v) AS INTEGER) AS dim,"
        " round(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b), 6) AS norm2 FROM p"
    )
    out["vec_weights"] = V.with_(P) + (
        f"SELECT id, 1.0::DOUBLE AS w_unit, CAST(floor({u01_sql(SEED, 'w', 'id')} * 1000) AS DOUBLE) AS w_random FROM p"
    )
    kc5, kc5_res = V.traverse("p", K_NEAREST, "kc_")
    nearest = (
        f"SELECT q.id, arg_min(c.id, ({sq('q.v', 'c.v')}, c.id)) AS center_id, round(min({sq('q.v', 'c.v')}), 6) AS sqdist"
        f" FROM p q, {kc5_res} c GROUP BY q.id"
    )
    out["vec_nearest_center"] = V.with_(P, *kc5) + nearest
    out["vec_points_in"] = V.with_(P, *kc5) + f"SELECT id FROM p q WHERE EXISTS (SELECT 1 FROM {kc5_res} c WHERE c.v = q.v)"
    out["vec_points_not_in"] = V.with_(P, *kc5) + (
        f"SELECT id FROM p q WHERE NOT EXISTS (SELECT 1 FROM {kc5_res} c WHERE c.v = q.v)"
    )
    nc = f"nc AS (SELECT q.id, min({sq('q.v', 'c.v')}) AS sqdist FROM p q, {kc5_res} c GROUP BY q.id)"
    out["vec_kmeans_objective"] = V.with_(P, *kc5, nc) + (
        f"SELECT round(sum(sqdist) / (count(*) - {K_NEAREST}), 6) AS obj_non_center, round(sum(sqdist) / count(*), 6) AS obj_all FROM nc"
    )
    bp = f"bp AS MATERIALIZED (SELECT id, v, CAST(floor({u01_sql(BLOCK_SEED, 'b', 'id')} * {BLOCKS}) AS INTEGER) AS block FROM p)"
    kb, kb_res = V.traverse("bp", K_CENTER, "kb_", blocked=True)
    core = [P, bp, *kb, f"cs AS MATERIALIZED (SELECT id, v FROM {kb_res})"]
    pairs = f"SELECT a.id AS i, b.id AS j, sqrt({sq('a.v', 'b.v')}) AS dist FROM cs a JOIN cs b ON a.id < b.id"
    out["vec_pairwise"] = V.with_(*core) + f"SELECT i, j, round(dist, 6) AS dist FROM ({pairs})"
    out["vec_farthest_pair"] = V.with_(*core) + f"SELECT i, j, round(dist, 6) AS dist FROM ({pairs}) ORDER BY dist DESC, i, j LIMIT 1"
    out["vec_mean_pairwise"] = V.with_(*core) + f"SELECT round(avg(dist), 6) AS avg_dist FROM ({pairs})"
    rp = f"rp AS MATERIALIZED (SELECT id, v FROM p ORDER BY {u01_sql(SEED, 0, 'id')}, id LIMIT 1)"
    out["sel_random_point"] = V.with_(P, rp) + "SELECT id FROM rp"
    mass = (
        "mc AS MATERIALIZED (SELECT id, mass, sum(mass) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        " / sum(mass) OVER () AS cdf FROM ("
        f"SELECT q.id, {sq('q.v', 'rp.v')} AS mass FROM p q, rp WHERE q.id <> rp.id))"
    )
    out["sel_sampling_mass"] = V.with_(P, rp, mass) + "SELECT id, round(mass, 6) AS mass, round(cdf, 6) AS cdf FROM mc"
    out["sel_draw_by_cdf"] = V.with_(P, rp, mass) + (
        f"SELECT coalesce(min(id) FILTER (WHERE cdf > {DRAW_R!r}), min(id)) AS id FROM mc"
    )
    kc6, kc6_res = V.traverse("p", K_CENTER, "k6_")
    out["sel_kcenter"] = V.with_(P, *kc6) + f"SELECT pos, id FROM {kc6_res}"
    kcs, kcs_res = V.traverse("p", K_CENTER, "ks_", first="seed", seed=SEED)
    out["sel_kcenter_seeded"] = V.with_(P, *kcs) + f"SELECT pos, id FROM {kcs_res}"
    pp, pp_res = V.traverse("p", K_PP, "pp_", first="seed", seed=SEED, kind="pp")
    out["sel_kmeanspp"] = V.with_(P, *pp) + f"SELECT pos, id FROM {pp_res}"
    pw = f"pw AS MATERIALIZED (SELECT id, v, CAST(floor({u01_sql(SEED, 'w', 'id')} * 1000) AS DOUBLE) AS w FROM p)"
    ppw, ppw_res = V.traverse("pw", K_PP, "pw_", first="seed", seed=SEED, kind="pp", weighted=True)
    out["sel_kmeanspp_weighted"] = V.with_(P, pw, *ppw) + f"SELECT pos, id FROM {ppw_res}"
    pp4, pp4_res = V.traverse("p", K_PP, "p4_", first="seed", seed=SEED, kind="pp", exponent=4.0)
    out["sel_kmeanspp_as_coded"] = V.with_(P, *pp4) + f"SELECT pos, id FROM {pp4_res}"

    def objective(centers: str) -> str:
        return (
            f"SELECT round(sum(d) / (count(*) - {K_PP}), 6) AS objective FROM ("
            f"SELECT q.id, min({sq('q.v', 'c.v')}) AS d FROM p q, {centers} c GROUP BY q.id)"
        )

    out["sel_seed_and_score"] = V.with_(P, *pp) + objective(pp_res)
    k20, k20_res = V.traverse("p", K1, "k20_")
    x = f"x AS MATERIALIZED (SELECT id, v FROM {k20_res})"
    ppx, ppx_res = V.traverse("x", K_PP, "px_", first="seed", seed=SEED, kind="pp")
    out["sel_coreset_kmeans"] = V.with_(P, *k20, x, *ppx) + objective(ppx_res)
    out["sel_kcenter_blocks"] = V.with_(P, bp, *kb) + f"SELECT block, pos, id FROM {kb_res}"
    bm = f"bm AS MATERIALIZED (SELECT id, v, CAST(id % {BLOCKS} AS INTEGER) AS block FROM p)"
    kbm, kbm_res = V.traverse("bm", K_CENTER, "km_", blocked=True)
    out["sel_kcenter_blocks_mod"] = V.with_(P, bm, *kbm) + f"SELECT block, pos, id FROM {kbm_res}"
    mm, mm_res = V.matching("cs", K_DIV, "mm_")
    out["sel_max_matching"] = V.with_(*core, *mm) + f"SELECT pos, id FROM {mm_res}"
    out["sel_diversify"] = out["sel_max_matching"]
    mo, mo_res = V.matching("cs", K_DIV - 1, "mo_")
    out["sel_max_matching_odd"] = V.with_(*core, *mo) + f"SELECT pos, id FROM {mo_res}"
    out["sel_diversify_score"] = V.with_(*core, *mm, f"r AS (SELECT id, v FROM {mm_res})") + (
        f"SELECT {K_DIV} AS k, round(avg(sqrt({sq('a.v', 'b.v')})), 6) AS avg_dist FROM r a JOIN r b ON a.id < b.id"
    )
    out["sel_scored_roundtrip"] = V.with_(*core, *mm, f"r AS (SELECT id, v FROM {mm_res})") + (
        f"SELECT id, CAST(len(v) AS INTEGER) AS dim, {K_DIV} AS k, (SELECT round(avg(sqrt({sq('a.v', 'b.v')})), 6)"
        " FROM r a JOIN r b ON a.id < b.id) AS avg_dist FROM r"
    )
    return out


# --------------------------------------------------------------------------- registry

_QUERIES: dict[str, QueryFn] = {
    "num_summary": q_num_summary,
    "num_abs_dev": q_num_abs_dev,
    "num_min_abs_dev": q_num_min_abs_dev,
    "num_min_abs_dev_sorted": q_num_min_abs_dev_sorted,
    "num_residue_sums": q_num_residue_sums,
    "num_residue_sums_signed": q_num_residue_sums_signed,
    "num_population_variance": q_num_population_variance,
    "txt_lines": q_txt_lines,
    "txt_lines_roundtrip": q_txt_lines_roundtrip,
    "txt_tokens": q_txt_tokens,
    "txt_word_count": q_txt_word_count,
    "txt_word_count_line_folded": q_txt_word_count_line_folded,
    "txt_word_count_salted": q_txt_word_count_salted,
    "txt_word_frequency": q_txt_word_frequency,
    "txt_top_words": q_txt_top_words,
    "num_text_roundtrip": q_num_text_roundtrip,
    "vec_points_roundtrip": q_vec_points_roundtrip,
    "vec_weights": q_vec_weights,
    "vec_nearest_center": q_vec_nearest_center,
    "vec_points_in": q_vec_points_in,
    "vec_points_not_in": q_vec_points_not_in,
    "vec_kmeans_objective": q_vec_kmeans_objective,
    "vec_pairwise": q_vec_pairwise,
    "vec_farthest_pair": q_vec_farthest_pair,
    "vec_mean_pairwise": q_vec_mean_pairwise,
    "sel_random_point": q_sel_random_point,
    "sel_sampling_mass": q_sel_sampling_mass,
    "sel_draw_by_cdf": q_sel_draw_by_cdf,
    "sel_kcenter": q_sel_kcenter,
    "sel_kcenter_seeded": q_sel_kcenter_seeded,
    "sel_kmeanspp": q_sel_kmeanspp,
    "sel_kmeanspp_weighted": q_sel_kmeanspp_weighted,
    "sel_kmeanspp_as_coded": q_sel_kmeanspp_as_coded,
    "sel_seed_and_score": q_sel_seed_and_score,
    "sel_coreset_kmeans": q_sel_coreset_kmeans,
    "sel_kcenter_blocks": q_sel_kcenter_blocks,
    "sel_kcenter_blocks_mod": q_sel_kcenter_blocks_mod,
    "sel_max_matching": q_sel_max_matching,
    "sel_max_matching_odd": q_sel_max_matching_odd,
    "sel_diversify": q_sel_diversify,
    "sel_diversify_score": q_sel_diversify_score,
    "sel_scored_roundtrip": q_sel_scored_roundtrip,
}

_SQL: dict[str, str] = {**_NUM_SQL, **_TXT_SQL, **_vec_sql()}


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _SQL.items() if k in _QUERIES}


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_txt_top_words(spark, sf_dir)
