"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    divergence,
    mixing,
    near_dup,
    packing,
    periodic,
    phrases,
    pivot_search,
    quality_qda,
    quotes,
    site_text,
    toxicity,
    unigram_counts,
    warc,
)
from tessera.llm.tables import written
from tessera.session import ensure_checkpoint_dir, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Vocabulary files; any other path works as well.
UNIGRAM_FILE = public_tokenizers.path("piece_bpe_32k.model")
PACKING_FILE = public_tokenizers.path("byte_bpe_50k.json")

TOXIC_FOLDS, TOXIC_FOLD = 5, 0
QUALITY_FOLDS, QUALITY_FOLD = 3, 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 85 % of equal 5-word shingles; texts without words are components of their own."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; null html gives an empty text."""
    return site_text.main_texts(_table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and log score of every document under the unigram vocabulary; null texts have none."""
    return unigram_counts.token_counts(_table(spark, sf_dir, "documents"), unigram_counts.read_vocabulary(UNIGRAM_FILE))


def op4_reply_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its parent by quotation, its path and its own text; ``parent_turn`` is -1 without a parent."""
    replies = quotes.reply_ordered(_table(spark, sf_dir, "conversations"))
    return replies.withColumn("parent_turn", F.coalesce("parent_turn", F.lit(-1).cast("long")))


def op5_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and its slots; null texts have size 0."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; null texts have no words and fail the base rules."""
    return divergence.quality_rules(_table(spark, sf_dir, "documents"))


def op7_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 1,024 tokens; a null text is the closing id alone."""
    return packing.packed(_table(spark, sf_dir, "documents"), packing.read_ranks(PACKING_FILE))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the held-out fold; empty texts get the intercept."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"), TOXIC_FOLDS, TOXIC_FOLD)
    weights = toxicity.train(docs, labels.where(~held_out))
    return toxicity.toxicity(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold; empty texts have the statistics of no words."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"), QUALITY_FOLDS, QUALITY_FOLD)
    return quality_qda.quality(docs, labels.where(~held_out)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every 50th vector; vectors with null or non-finite components take no part."""
    return pivot_search.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language; languages without a frequent phrase have no row."""
    return phrases.collocations(phrases.phrase_counts(_table(spark, sf_dir, "documents")))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives in the shared folder, then read back through the index."""
    folder = scratch_path(spark, "warc")
    index = written(warc.write_archives(_table(spark, sf_dir, "pages"), folder), "warc-index")
    read = warc.read_records(index, folder, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after every tenth text was given a periodic tail."""
    return periodic.periodic_digests(_table(spark, sf_dir, "documents"), tails=True)


def queries() -> dict[str, QueryFn]:
    found = [
        op1_near_duplicates,
        op2_main_text,
        op3_token_counts,
        op4_reply_ordered,
        op5_mixed_sources,
        op6_quality_rules,
        op7_packed_sequences,
        op8_toxicity,
        op9_quality,
        op10_top_inner_products,
        op11_collocations,
        op12_warc,
        op13_periodic_runs,
    ]
    return {f.__name__: f for f in found}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SQL = {
    "op1_near_duplicates": rf"""WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
      sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s
        FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
      sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
      common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
      reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
      SELECT reach.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(r) AS component_id, reach.doc_id = min(r) AS kept
      FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id""",
    "op4_reply_ordered": r"""WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations),
      split AS (SELECT rid, conv_id, turn, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM m WHERE text IS NOT NULL),
      raw AS (SELECT rid, conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
      pre AS (SELECT *, regexp_extract(line, '^[ \t]*(?:>[ \t]?)+') AS prefix FROM raw),
      ln AS (SELECT rid, conv_id, turn, i, length(prefix) - length(replace(prefix, '>', '')) AS level, substr(line, length(prefix) + 1) AS body FROM pre),
      marked AS (SELECT *, lag(level) OVER (PARTITION BY rid ORDER BY i) AS before, lead(level) OVER (PARTITION BY rid ORDER BY i) AS after FROM ln),
      numbered AS (SELECT *, sum(CASE WHEN level > 0 AND before IS DISTINCT FROM level THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS passage,
        lower(trim(regexp_replace(body, '\s+', ' ', 'g'))) AS norm FROM marked),
      orig AS (SELECT conv_id, norm, min(turn) AS q FROM numbered WHERE level = 0 AND norm <> '' GROUP BY ALL),
      quoted AS (SELECT DISTINCT conv_id, turn, passage, level, i, norm FROM numbered WHERE level > 0 AND norm <> '' AND turn IS NOT NULL),
      votes AS (SELECT a.conv_id, a.turn, passage, level, o.q, count(*) AS n FROM quoted a JOIN orig o ON a.conv_id = o.conv_id AND a.norm = o.norm AND o.q < a.turn
        GROUP BY ALL),
      best AS (SELECT conv_id, turn, passage, level, arg_max(q, (n, q)) AS q, arg_max(n, (n, q)) AS n FROM votes GROUP BY 1, 2, 3, 4),
      direct AS (SELECT conv_id, turn, q, sum(n) AS n FROM best WHERE level = 1 GROUP BY ALL),
      parent AS (SELECT conv_id, turn, arg_max(q, (n, q)) AS p FROM direct GROUP BY 1, 2),
      total AS (SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS n_quoted FROM best GROUP BY 1, 2),
      chain AS (SELECT conv_id, turn, p AS up, lpad(CAST(turn AS VARCHAR), 19, '0') AS path, 0 AS depth FROM parent
        UNION ALL SELECT c.conv_id, c.turn, parent.p, lpad(CAST(c.up AS VARCHAR), 19, '0') || '/' || c.path, c.depth + 1
        FROM chain c LEFT JOIN parent ON parent.conv_id = c.conv_id AND parent.turn = c.up WHERE c.up IS NOT NULL),
      paths AS (SELECT conv_id, turn, path, depth FROM chain WHERE up IS NULL),
      own AS (SELECT rid, string_agg(body, chr(10) ORDER BY i) AS body FROM numbered WHERE level = 0 AND NOT (coalesce(after, 0) > 0 AND
        regexp_matches(body, '^\s*(?:On\b.*\bwrote|Am\b.*\bschrieb.*|Le\b.*\ba écrit|El\b.*\bescribió)\s*:\s*$')) GROUP BY rid)
      SELECT m.conv_id, m.turn, m.role, coalesce(parent.p, -1) AS parent_turn, CAST(coalesce(paths.depth, 0) AS BIGINT) AS depth,
        coalesce(paths.path, lpad(CAST(m.turn AS VARCHAR), 19, '0')) AS path, coalesce(total.n_quoted, 0) AS n_quoted,
        CASE WHEN m.text IS NOT NULL THEN regexp_replace(coalesce(own.body, ''), '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') END AS text
      FROM m LEFT JOIN own ON own.rid = m.rid LEFT JOIN parent ON parent.conv_id = m.conv_id AND parent.turn = m.turn
        LEFT JOIN total ON total.conv_id = m.conv_id AND total.turn = m.turn LEFT JOIN paths ON paths.conv_id = m.conv_id AND paths.turn = m.turn""",
    "op10_top_inner_products": """WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
      r AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
      SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_collocations": rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
      w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
      total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
      grams AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m)),
      f AS (SELECT lang, m, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 30),
      cand AS (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
      cuts AS (SELECT lang, m, phrase, a, ws, unnest(generate_series(1, m - 1)) AS k FROM cand),
      scored AS (SELECT cuts.lang, cuts.m, cuts.phrase, a, k, x.c AS l, y.c AS r, CAST(2000000 * CAST(a AS HUGEINT) // (CAST(x.c AS HUGEINT) + y.c) AS BIGINT) AS score
        FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:k], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[k + 1:], ' ')),
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS p FROM scored) WHERE p = 1),
      inside AS (SELECT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, max(a) AS around FROM (SELECT lang, ws, a, z, unnest(generate_series(1, m - z + 1)) AS i
        FROM cand, (SELECT unnest([2, 3]) AS z) WHERE z < m) GROUP BY ALL),
      ranked AS (SELECT best.lang, CAST(row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS INTEGER) AS rank, best.phrase, a, l, r, score
        FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
        WHERE around IS NULL OR 100 * CAST(around AS HUGEINT) < 80 * CAST(a AS HUGEINT))
      SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000""",
    "op12_warc": """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
      g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM p),
      t AS (SELECT *, payload_bytes >= 1000 AND newest IS NOT NULL AND page_id IS DISTINCT FROM newest AS again FROM g)
      SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN again THEN newest END AS refers_to FROM t""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
