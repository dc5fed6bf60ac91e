"""Frames with the cases every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import pytest

WORDS = "the of and to in that is was for on with as by at from this have are not be".split()


def prose(seed: int, n: int) -> str:
    """``n`` words, reproducible, some of them common."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        r = x >> 8
        out.append(WORDS[r % 20] if r % 3 == 0 else "w%x" % (r % 50021))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with odd rows and extra columns named like those of the operators."""
    rows = [(i, prose(i, 60 + 7 * i), "en" if i % 3 else None, f"s{i % 4}") for i in range(40)]
    rows += [
        (100, None, "en", "s0"),
        (101, "", "en", None),
        (102, " \t\n ", None, "s1"),
        (103, "one", "de", "s1"),
        (103, "one", "de", "s1"),
        (104, prose(3, 30_000), "en", "s2"),
        (None, prose(5, 80), "en", "s3"),
        (105, prose(5, 95), "xx", "s3"),
        (106, prose(5, 95) + " tail", "xx", None),
        (107, "naïve 漢字 😀 " * 40 + "\n" + "naïve 漢字 😀 " * 40, "fr", "s0"),
    ]
    rows = [(*r, 1, "x", 2.0) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, node long, tree string, size double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
