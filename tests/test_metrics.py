"""Metric goldens computable without the original corpus (binary relevance
by rank -> P / R / F1 at min(k, N), R-precision, early stop)."""

import pytest

from ferret.operators import evaluate as E

CASES = [
    ([1, 0, 1], 2, 3, 3, 0.6667, 1.0, 0.8, 0.5),
    ([1, 1, 1, 0, 1, 1], 5, 6, 6, 0.8333, 1.0, 0.9091, 0.8),
    ([1] * 8, 12, 8, 8, 1.0, 0.6667, 0.8, 1.0),
    ([1] * 7, 7, 7, 7, 1.0, 1.0, 1.0, 1.0),
    ([1] * 10 + [0] * 5, 10, 10, 10, 1.0, 1.0, 1.0, 1.0),
    ([0, 0], 0, 2, 2, 0.0, None, None, 0.0),
]


@pytest.mark.parametrize("rels,n_rel,N,k,p,r,f1,rp", CASES)
def test_metrics_goldens(spark, rels, n_rel, N, k, p, r, f1, rp):
    hits = spark.createDataFrame([(1, i, float(100 - i)) for i in range(len(rels))], "qid int, doc_id long, score double")
    judged = [i for i, x in enumerate(rels) if x]
    # relevant but never retrieved documents make up n_rel
    judged += [1000 + j for j in range(n_rel - len(judged))]
    qrels = spark.createDataFrame([(1, d) for d in judged], "topic int, doc_id long") if judged else \
        spark.createDataFrame([], "topic int, doc_id long")
    topics = spark.createDataFrame([(1,)], "topic int")
    m = E.metrics(hits, qrels, topics, k=10).first()
    assert (m.N, m.k, m.nrelevant_gt) == (N, k, n_rel)
    assert (m.precision, m.recall, m.f1, m.r_precision) == (p, r, f1, rp)


def test_no_hits_all_null(spark):
    hits = spark.createDataFrame([], "qid int, doc_id long, score double")
    qrels = spark.createDataFrame([(1, 5)], "topic int, doc_id long")
    topics = spark.createDataFrame([(1,)], "topic int")
    m = E.metrics(hits, qrels, topics, k=10).first()
    assert (m.N, m.k, m.nrelevant_gt) == (0, 10, 1)
    assert m.precision is None and m.recall is None and m.f1 is None and m.r_precision is None


def test_cutoff_zero_reads_the_last_row(spark):
    hits = spark.createDataFrame([(1, i, float(9 - i)) for i in range(3)], "qid int, doc_id long, score double")
    qrels = spark.createDataFrame([(1, 0), (1, 7)], "topic int, doc_id long")
    topics = spark.createDataFrame([(1,)], "topic int")
    zero, last = (E.metrics(hits, qrels, topics, k=k).first() for k in (0, 3))
    assert zero.k == 0 and (zero.precision, zero.recall, zero.f1) == (last.precision, last.recall, last.f1) == (0.3333, 0.5, 0.4)


def test_short_and_stop_word_passages_are_judged(spark, tmp_path):
    from ferret.operators import index as I

    docs = [(1, "xx alpha beta gamma yy", "en", "s", 1), (2, "to be or not to be", "en", "s", 1), (3, "nothing", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    items = [(10, "alpha beta"), (11, "be or not to"), (12, "alpha beta gamma"), (13, "alph"), (14, "absent"), (15, "a absent z")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = E.qrels_containment(spark, str(tmp_path), I.open_index(spark, str(tmp_path))).collect()
    assert sorted(map(tuple, got)) == [(10, 1), (11, 2), (12, 1), (13, 1)]


def test_passages_by_their_edge_words_match_plain_containment(spark, tmp_path, monkeypatch):
    """Passages of one or two words, cut inside words, around punctuation, like
    stop words or without a word, against a plain scan."""
    import random

    from ferret.operators import index as I

    monkeypatch.setattr(E, "PASSAGES_AT_ONCE", 5)
    rng = random.Random(6)
    words = ["alpha", "beta.gamma", "don't", "the", "then", "other", "of", "It", "Über", "ΟΔΟΣ", "3.5", "x_y", "a"]
    docs = [(k, " ".join(rng.choice(words) + rng.choice(["", "", ",", ".", "!", " -"]) for _ in range(12)), "en", "s", 1) for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    items = {"", " ", "!", "the", "he", "ta.ga", "gamma", "ΟΣ", "of t", "n't the", "Über", "über", "lpha, b", "a", "ha.", "5 x_", "zzz", "zzz the", "the zzz"}
    for _ in range(60):
        text = rng.choice(docs)[1]
        at = rng.randrange(len(text) - 12)
        items.add(text[at:at + rng.randrange(1, 12)])
    items = list(enumerate(sorted(items)))
    spark.createDataFrame([*items, (999, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = E.qrels_containment(spark, str(tmp_path), I.open_index(spark, str(tmp_path))).collect()
    assert sorted(map(tuple, got)) == sorted((k, d[0]) for k, p in items for d in docs if p in d[1])


def test_pool_size_and_seed_are_arguments(spark):
    pool, ids = spark.createDataFrame([(1,), (2,)], "doc_id long"), spark.range(50).withColumnRenamed("id", "doc_id")
    run = lambda **how: {(r.doc_id, r.origin) for r in E.fill_pool(pool, ids, **how).collect()}
    assert run(size=1) == {(1, "pool"), (2, "pool")} and len(run()) == 50
    a, b = run(size=10), run(size=10, seed=1)
    assert len(a) == len(b) == 10 and a != b and a == run(size=10) and a < run(size=12)
