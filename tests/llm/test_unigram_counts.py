import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tessera.llm.unigram_counts import Counter, read_vocabulary, token_counts
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def reference(vocabulary):
    pieces = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + vocabulary
    t = Tokenizer(models.Unigram(pieces, 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids) if text else 0


ODD = ["", " ", "  a  b ", "héllo\n\tworld 漢字😀😀 x▁y", "▁a", "a ▁ b", "\n", "a" * 500, "   ", "\x00\x7f", "𐍈𐍈 é"]


def test_counts_equal_the_tokenizer(vocabulary):
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet")["text"].to_pylist() + ODD
    count, ref = Counter(vocabulary), reference(vocabulary)
    assert [count.of_text(t)[1] for t in texts] == [ref(t) for t in texts]


def test_ties_go_to_the_longer_last_piece():
    vocabulary = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("▁ab", -3.0), ("ba", -2.0)]
    count, ref = Counter(vocabulary), reference(vocabulary)
    for text in ("ab", "abab", "aabb", "baab", "abc", "abcab", "bababa"):
        assert count.of_text(text)[1] == ref(text), text


def test_frames(vocabulary, odd_docs, no_docs):
    rows = token_counts(odd_docs, vocabulary).collect()
    ref = reference(vocabulary)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == sorted((str(r["doc_id"]), ref(r["text"])) for r in odd_docs.collect())
    assert token_counts(no_docs, vocabulary).collect() == []


def whole_text(vocabulary):
    """Counts and scores of a Unigram model that is not split at spaces."""
    pieces = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + vocabulary
    t = Tokenizer(models.Unigram(pieces, 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return lambda text: t.encode(text, add_special_tokens=False).tokens if text else []


SPACES = ["a" + " " * n + "b" for n in range(1, 40)] + [" " * n for n in range(1, 40)] + [" " * n + "x = 1\n" + " " * n + "y  " for n in range(30)]


def test_runs_of_spaces_equal_the_whole_text(spark, vocabulary):
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet")["text"].to_pylist()[:50] + ODD + SPACES
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_counts(df, vocabulary).collect()}
    ref, score = whole_text(vocabulary), dict(vocabulary)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == [len(ref(t)) for t in texts]
    for i, t in enumerate(texts):
        if all(p in score for p in ref(t)):
            assert got[i]["log_score"] == pytest.approx(sum(score[p] for p in ref(t)))


def test_pieces_across_words_equal_the_whole_text():
    vocabulary = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("▁a", -1.5), ("a▁b", -1.25), ("▁▁", -1.1), ("▁a▁a", -1.75)]
    count, ref = Counter(vocabulary, split=False), whole_text(vocabulary)
    for text in ("a b", "a a b", "a  b a", "  a b  ", "b a b a a"):
        assert count.of_text(text)[1] == len(ref(text)), text
