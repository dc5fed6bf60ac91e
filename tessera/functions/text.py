"""Text expressions: line splitting, single-space tokenisation, case folding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


NEWLINE = r"\r\n|\r|\n"


def split_lines(text: Column | str) -> Column:
    """A document's lines as the text reader gives them: they end at LF, CR or
    CR LF, one last line end adds no line, an empty text has no line."""
    text = _c(text)
    body = F.regexp_replace(text, rf"(?:{NEWLINE})\z", "")
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(body, NEWLINE))


def count_lines(text: Column | str) -> Column:
    """Number of lines of :func:`split_lines`, without making them."""
    text = _c(text)
    ended = (text == F.lit("")) | text.rlike(r"[\r\n]\z")
    return F.regexp_count(text, F.lit(NEWLINE)) + F.when(ended, 0).otherwise(1)


def tokenize(line: Column | str) -> Column:
    """Tokens of a line split on single spaces, with the rules of a plain
    ``split(" ")``: leading and inner empty tokens are kept, trailing empty
    tokens are dropped, an empty line is one empty token and a line of only
    spaces has no token.  Tabs and other white space do not split.

    ``rtrim`` removes trailing U+0020 only, which is exactly what drops the
    trailing empty tokens.
    """
    line = _c(line)
    trimmed = F.rtrim(line)
    return F.when((F.length(line) > 0) & (trimmed == F.lit("")), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, " ")
    )


# Case-insensitive equality compares characters, each upper-cased and then
# lower-cased by itself.  ``lower`` of a whole string differs: a dotted capital
# I becomes two characters, a last capital sigma a final sigma, and letters
# with two small forms keep both.  The first map goes in front of ``lower``,
# the second, made by the rule, behind it.
_BEFORE = {"\u0130": "i", "\u03a3": "\u03c3"}


def _one_form() -> dict[str, str]:
    forms = {}
    for c in (chr(i) for i in range(0x80, 0x10000) if not 0xD800 <= i < 0xE000):
        upper = c.upper()
        one = (upper if len(upper) == 1 else c).lower()
        if len(one) == 1 and len(c.lower()) == 1 and c.lower() != one:
            forms[c.lower()] = one
    return forms


_AFTER = _one_form()
FOLD_BEFORE = ("".join(_BEFORE), "".join(_BEFORE.values()))
FOLD_AFTER = ("".join(_AFTER), "".join(_AFTER.values()))


def fold_key(word: Column | str) -> Column:
    """Grouping key under case-insensitive equality, character by character
    (so ß and SS stay apart, ſ and s, ς and σ, µ and μ meet).  Text of ASCII
    characters alone, told by its length in bytes, only needs ``lower``."""
    word = _c(word)
    full = F.translate(F.lower(F.translate(word, *FOLD_BEFORE)), *FOLD_AFTER)
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(full)
