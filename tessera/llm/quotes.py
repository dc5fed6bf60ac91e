"""Quotation linking in conversations, in DataFrame functions only.

A line's quote level is the number of ``>`` in front of it.  Consecutive
lines of one level above 0 are a quoted passage; its lines are normalised
(case, white space) and hashed.  The original of a line is the first message
of the conversation whose own text (level 0) holds it; a passage belongs to
the earlier message that is the original of most of its lines (then the
latest).  A message answers the original of its level-1 passages with the most
linked lines (then the latest).  ``path`` is the chain of answered turns: text
order of paths is the reply order, an answer directly follows what it quotes.

Only hashes of lines are shuffled, and only of conversations that hold a
quote; the original is a partial ``min``, so a line, or a conversation, that
is a third of all rows meets nowhere.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import small_side, written

#: Digits of the largest turn.
KEY_DIGITS = 19

_PREFIX = r"^[ \t]*(?:>[ \t]?)+"
_ATTRIBUTION = r"^\s*(?:On\b.*\bwrote|Am\b.*\bschrieb.*|Le\b.*\ba écrit|El\b.*\bescribió)\s*:\s*$"


def _lines(text: str) -> F.Column:
    """Array of ``(level, body)`` of a text's lines."""
    split = F.split(F.regexp_replace(F.col(text), r"\r\n?", "\n"), "\n", -1)

    def one(line: F.Column) -> F.Column:
        prefix = F.regexp_extract(line, _PREFIX, 0)
        return F.struct(
            (F.length(prefix) - F.length(F.replace(prefix, F.lit(">")))).cast("int").alias("level"),
            F.substr(line, F.length(prefix) + F.lit(1)).alias("body"),
        )

    return F.transform(split, one)


def _normal(body: F.Column) -> F.Column:
    return F.lower(F.trim(F.regexp_replace(body, r"\s+", " ")))


def parsed(messages: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, lines`` with the level and body of each line."""
    rows = messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(text_col).cast("string").alias("text")
    )
    return rows.where("conv_id is not null and turn is not null and text is not null").withColumn("lines", _lines("text")).drop("text")


def quote_links(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, passage, level, quoted_turn, n_lines, n_linked`` of quoted passages with an original.

    ``passage`` numbers a message's passages from 1.  Messages with a null
    conversation, turn or text quote nothing and are no originals; repeated
    rows count once; blank lines are not compared.
    """
    rows = parsed(messages, conv_col, turn_col, text_col)
    quoting = rows.where(F.exists("lines", lambda x: x["level"] > 0))
    # a passage begins where the level changes to one above 0, and is cut out once: the work is linear in the lines
    lines = F.col("lines")
    level = lambda i: F.get(lines, i)["level"]
    begins = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (level(i) > 0) & ((i == 0) | (level(i - 1) != level(i))))
    until = lambda p: F.coalesce(F.get(F.col("begins"), p + 1), F.size(lines))
    passages = F.transform("begins", lambda s, p: F.struct(s.alias("start"), F.slice(lines, s + 1, until(p) - s).alias("part")))
    cut = quoting.withColumn("begins", begins).select("conv_id", "turn", F.posexplode(passages).alias("p", "x"))
    numbered = cut.select("conv_id", "turn", (F.col("p") + 1).alias("passage"), F.col("x.start").alias("start"), F.posexplode("x.part").alias("i", "x"))
    quoted = written(
        numbered.where("x.level > 0")
        .select(
            "conv_id",
            "turn",
            "passage",
            F.col("x.level").alias("level"),
            (F.col("start") + F.col("i")).alias("line"),
            F.when(_normal(F.col("x.body")) != "", F.xxhash64(_normal(F.col("x.body")))).alias("hash"),
        )
        .where("hash is not null")
        .distinct(),
        "quoted-lines",
    )
    threads = written(quoted.select("conv_id").distinct(), "quoting")
    originals = (
        rows.join(small_side(threads), "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode(F.filter("lines", lambda x: x["level"] == 0)).alias("x"))
        .select("conv_id", "turn", _normal(F.col("x.body")).alias("own"))
        .where("own <> ''")
        .groupBy("conv_id", F.xxhash64("own").alias("hash"))
        .agg(F.min("turn").alias("quoted_turn"))
    )
    linked = quoted.join(originals, ["conv_id", "hash"], "left")
    votes = linked.groupBy("conv_id", "turn", "passage", "level", F.when(F.col("quoted_turn") < F.col("turn"), F.col("quoted_turn")).alias("quoted_turn")).agg(
        F.count("*").alias("n")
    )
    best = votes.groupBy("conv_id", "turn", "passage", "level").agg(
        F.sum("n").alias("n_lines"), F.max(F.when(F.col("quoted_turn").isNotNull(), F.struct("n", "quoted_turn"))).alias("best")
    )
    return best.where("best is not null").select(
        "conv_id", "turn", "passage", "level", F.col("best.quoted_turn").alias("quoted_turn"), "n_lines", F.col("best.n").alias("n_linked")
    )


def _key(turn: F.Column) -> F.Column:
    """Turn as text that sorts like the number, all 64 bits of it (negative ones first)."""
    up = (turn.cast("decimal(20,0)") + F.lit(Decimal(1 << 63))).cast("string")
    return F.when(turn < 0, F.concat(F.lit("-"), F.lpad(up, KEY_DIGITS, "0"))).otherwise(F.lpad(turn.cast("string"), KEY_DIGITS, "0"))


def _paths(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, path, depth`` by doubling: each round a path reaches twice as far up."""
    now = written(
        parents.select("conv_id", "turn", "parent_turn", F.col("parent_turn").alias("up"), _key(F.col("turn")).alias("path")),
        "paths",
    )
    while True:
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        step = now.join(above, ["conv_id", "up"], "left").select(
            "conv_id",
            "turn",
            "parent_turn",
            F.col("next").alias("next_up"),
            F.when(F.col("head").isNotNull(), F.concat_ws("/", "head", "path")).when(F.col("up").isNotNull(), F.concat_ws("/", _key(F.col("up")), "path")).otherwise(F.col("path")).alias("path"),
        )
        now = written(step.withColumnRenamed("next_up", "up"), "paths")
        if now.where("up is not null").limit(1).count() == 0:
            return now.drop("up")


def reply_ordered(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turn, role, parent_turn, depth, path, n_quoted, text`` per row of ``messages``.

    ``text`` is the message without quoted lines and the attribution line in
    front of them, without blank lines at its ends (null stays null).  ``depth``
    counts the answers above it.  Order by ``conv_id, path`` for the reply
    order.  Messages with a null conversation or turn have no parent and, with
    a null turn, a null path.  Repeated rows give repeated results.
    """
    links = written(quote_links(messages, conv_col, turn_col, text_col), "quote-links")
    answered = links.where("level = 1").groupBy("conv_id", "turn", "quoted_turn").agg(F.sum("n_linked").alias("n"))
    parents = answered.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "quoted_turn")).alias("best")).select("conv_id", "turn", F.col("best.quoted_turn").alias("parent_turn"))
    paths = _paths(parents)
    quoted = links.groupBy("conv_id", "turn").agg(F.sum("n_linked").alias("n_quoted"))
    known = written(paths.join(quoted, ["conv_id", "turn"], "full_outer"), "reply-paths")

    lines = F.col("lines")
    own = F.filter(
        lines,
        lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(_ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)),
    )
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")
    rows = messages.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("lines", _lines("text"))
    rows = rows.select("conv_id", "turn", "role", body.alias("text"))
    out = rows.join(small_side(known), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "parent_turn",
        F.coalesce("path", _key(F.col("turn"))).alias("path"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        "text",
    ).withColumn("depth", F.coalesce(F.length("path") - F.length(F.replace("path", F.lit("/"))), F.lit(0)).cast("long")).select(
        "conv_id", "turn", "role", "parent_turn", "depth", "path", "n_quoted", "text"
    )
