"""Subword classifier: features against a plain version, held-out accuracy, edges."""

import numpy as np
import pytest

from ferret.llm import catalog, subwords

SF = "/root/testdata/sf0.01"


def plain_features(text):
    """Kinds and bytes of all features of a text."""
    words = (text or "").encode().split()
    out = [("w", w) for w in words]
    for w in words:
        x = b" " + w + b" "
        out += [("3", x[k:k + 3]) for k in range(len(x) - 2)] + [("4", x[k:k + 4]) for k in range(len(x) - 3)]
    return out


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_features(monkeypatch, piece):
    monkeypatch.setattr(subwords, "PIECE", piece)
    text = "Größe und  naïve\tcafés a ab abc !!! " + "lorem ipsum dolor " * 30 + "x" * 70
    want = plain_features(text)
    got = np.concatenate(list(subwords.features(text)))
    assert len(got) == len(want)
    # equal features share a bucket: as many distinct ones, but for collisions
    at, counts = subwords.tally(text)
    assert counts.sum() == len(want) and 0.97 * len(set(want)) <= len(at) <= len(set(want))
    lone = np.concatenate(list(subwords.features("dolor")))
    assert set(lone) <= set(at.tolist()) and len(lone) == len(plain_features("dolor"))
    assert not any(len(x) for x in subwords.features(" \n ")) and not any(len(x) for x in subwords.features(None))


def test_held_out(spark):
    got = catalog.QUERIES["op11_quality_classifier"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == docs and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() >= 0.95
    assert (held[held.quality == 1].predicted == 1).mean() >= 0.97
    pos, neg = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([[p > n for n in neg] for p in pos]) >= 0.97
    again = catalog.QUERIES["op11_quality_classifier"](spark, SF).toPandas()
    assert got.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()


def test_edges(spark, monkeypatch):
    columns = "doc_id long, text string, label string, score int, n int"
    texts = [None, "", " \t", "good words here", "BAD!! WORDS!!", "good words here", "x" * 400_000, "é " * 100_000]
    docs = spark.createDataFrame([(k or None, t, "l", 1, 2) for k, t in enumerate(texts)] + [(3, "again good words", "l", 1, 2)], columns)
    marks = [(3, 1), (3, 1), (4, 0), (4, 0), (5, None), (99, 1), (None, 0), (6, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int").withColumnRenamed("quality", "label")
    model = subwords.learn(docs, labels)
    got = {(r.doc_id, r.n): r for r in subwords.predict(docs, model, ["doc_id", "n"]).collect()}
    rows = subwords.predict(docs, model, ["doc_id", "n"]).collect()
    assert len(rows) == len(texts) + 1 and all(0 <= r.score <= 1 for r in rows) and got
    score = {r.doc_id: r.score for r in rows if r.doc_id != 3}
    assert score[1] == score[2] == score[None] and score[5] > score[4]
    none = subwords.learn(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r.score for r in subwords.predict(docs, none, ["doc_id"]).collect()} == {0.5}
    empty = spark.createDataFrame([], columns)
    assert subwords.predict(empty, model, ["doc_id"]).count() == 0
    assert subwords.predict(empty, subwords.learn(empty, labels), ["doc_id"]).count() == 0
    monkeypatch.setattr(subwords, "SAMPLE", 1)
    one = subwords.learn(docs, labels)
    assert one.tables.shape == (2, subwords.BUCKETS)


def test_training_separates_classes():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(200):
        at = np.unique(rng.integers(0, 1000, 60)).astype(np.int32) + (k % 2) * 700
        rows.append((k % 2, at, np.ones(len(at))))
    model = subwords.train(rows, [0, 1])
    z = [float((model.tables[:, at].mean(1) + model.bias) @ [-1, 1]) for _, at, _ in rows]
    assert np.mean([(v > 0) == (r[0] == 1) for v, r in zip(z, rows, strict=True)]) >= 0.98
