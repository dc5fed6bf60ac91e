import zlib

import numpy as np
import pytest

from tessera.llm import quality_qda, queries, toxicity
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def auc(label, score):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    for s in np.unique(score):  # ties share their mean rank
        order[score == s] = order[score == s].mean()
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("name, column, folds, fold, least", [("op8_toxicity", "toxic", 5, 0, 0.85), ("op9_quality", "quality", 3, 1, 0.98)])
def test_held_out_accuracy(spark, name, column, folds, fold, least):
    got = queries.queries()[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % folds == fold) for d, h in zip(got["doc_id"], got["held_out"]))
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    held = got[got["held_out"]]
    assert auc(held[column].to_numpy(), held["score"].to_numpy()) >= least


def test_held_out_labels_change_nothing(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, toxic int, quality int")
    held = toxicity.held_out(labels["doc_id"], 5, 0)
    flipped = labels.withColumn("toxic", (held != (labels["toxic"] == 1)).cast("int"))
    a, b = (toxicity.train(odd_docs, x.where(~held)) for x in (labels, flipped))
    assert np.array_equal(a, b)


def brute_features(text):
    words = [w.strip(".,;:!?'\"()[]{}<>#*$%&|-_=+/\\~`^@") or w for w in text.lower().split()]
    return len(set(words)) + len(set(zip(words, words[1:]))) + len(set(zip(words, words[2:])))


def test_features(spark):
    for text in ("", "a", "a b", "Stop, stop! (now) -- x.y z", prose(1, 200)):
        raw = np.frombuffer(text.encode(), np.uint8)
        found, _ = toxicity.features(raw, np.array([0, len(raw)]))
        assert abs(len(np.unique(found)) - brute_features(text)) <= 1  # a rare collision in 2^20


def test_toxic_words_are_learned_sparsely(spark):
    rows = [(i, prose(i, 80) + (" vile rotten" if i % 5 == 0 else " fine")) for i in range(400)] + [(900, None), (901, ""), (None, "vile rotten")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    weights = toxicity.train(docs, labels)
    assert 0 < np.count_nonzero(weights) < 200
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, weights).collect()}
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(400))
    assert got[900]["score"] == got[901]["score"] < 0.5 and got[None]["predicted"] == 1
    assert toxicity.toxicity(docs.limit(0), weights).collect() == []


def plain_ftrl(stream, epochs=toxicity.EPOCHS):
    """Per-coordinate FTRL-proximal with dictionaries, one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for found, label in stream:
            used = [*found, 1 << toxicity.BITS]
            w = {i: weight(i) for i in used}
            g = 1 / (1 + np.exp(-max(-35.0, min(35.0, sum(w.values()))))) - label
            for i in used:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / toxicity.ALPHA * w[i]
    return {i: weight(i) for i in z if weight(i)}


def feature_set(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.unique(toxicity.features(raw, np.array([0, len(raw)]))[0]).astype(np.int32)


def test_training_equals_a_plain_one(spark):
    rows = [(i, prose(i, 40) + (" vile rotten" if i % 4 == 0 else " fine day")) for i in range(150)]
    docs = spark.createDataFrame(rows + rows[:30] + [(7, prose(7, 90)), (8, prose(300, 90))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)], "doc_id long, toxic int")
    at = {r["doc_id"]: r["o"] for r in labels.selectExpr("doc_id", "xxhash64(doc_id) AS o").collect()}
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(feature_set(r["text"]))
    one = {d: min(sets, key=lambda f: f.tobytes()) for d, sets in texts.items()}
    stream = [(one[d], float(d % 4 == 0)) for d in sorted(one, key=lambda d: at[d])]
    for bound in (toxicity.MAX_TRAINING_BYTES, 20_000):
        sizes = np.cumsum([4 * len(f) for f, _ in stream])
        want = plain_ftrl([x for x, s in zip(stream, sizes) if s <= bound])
        got = toxicity.train(docs, labels, most_bytes=bound)
        assert set(np.flatnonzero(got)) == set(want) and want
        assert np.allclose([got[i] for i in want], list(want.values()), rtol=1e-5)


def test_no_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r["score"] for r in toxicity.toxicity(odd_docs, toxicity.train(odd_docs, labels)).collect()} == {0.5}
    assert all(0 <= r["score"] <= 1 for r in quality_qda.quality(odd_docs, labels).collect())
    assert quality_qda.quality(odd_docs.limit(0), labels).collect() == []


def test_qda_moments_and_density(spark, odd_docs):
    stats = quality_qda.document_statistics(odd_docs).where("doc_id < 40")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)], "doc_id long, quality int")
    model = quality_qda.train(stats, labels)
    x = {r["doc_id"]: np.frombuffer(r["stats"]) for r in stats.collect()}
    for k in (0, 1):
        mine = np.array([x[i] for i in range(40) if i % 2 == k])
        assert np.allclose(model.classes[k][0], mine.mean(0))
    probe = np.array([x[0], x[1]])
    density = []
    for k in (0, 1):
        mean, inverse, log_det, share = model.classes[k]
        cov = np.linalg.inv(inverse) @ np.linalg.inv(inverse).T
        y = probe - mean
        density.append(share - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y))
    assert np.allclose(model.score(probe), 1 / (1 + np.exp(density[0] - density[1])))
