"""What an evaluation of many topics costs: hits exchanged once, postings
filtered by the terms asked for before they are joined."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ferret import session as SS
from ferret.operators import evaluate as E
from ferret.operators import index as I
from ferret.operators import search as S
from ferret.plans import querysets as QS

from .conftest import SF_SMALL


@pytest.fixture
def no_guess(spark):
    """The planner broadcasts nothing on its own, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_hits_are_not_exchanged_again(spark, no_guess):
    hits = spark.createDataFrame([(q, d, d % 7 / 7) for q in (1, 2) for d in range(500)], "qid int, doc_id long, score double")
    qrels = spark.createDataFrame([(1, 3), (1, 1000)], "topic int, doc_id long")
    c = E.curve(hits, qrels)
    assert "Exchange hashpartitioning" not in plan(c) and "Window" not in plan(c)
    assert c.count() == 1000


def test_numbers_go_on_over_batches():
    rng = random.Random(1)
    topics = sorted(rng.randrange(6) for _ in range(200))
    rel = [rng.randrange(2) for _ in topics]
    rows = pa.RecordBatch.from_arrays([pa.array(topics), pa.array(rel)], ["topic", "rel"])
    want = [(sum(x == t for x in topics[: i + 1]), sum(r for x, r in zip(topics[: i + 1], rel) if x == t)) for i, t in enumerate(topics)]
    for step in (1, 7, 200):
        out = pa.Table.from_batches(E._numbered(rows.slice(at, step) for at in range(0, 200, step)))
        assert list(zip(out["_lr"].to_pylist(), out["_lrel"].to_pylist())) == want
    assert not list(E._numbered([rows.slice(0, 0)]))


def test_hits_near_the_last_relevant_one(spark):
    """Hits are read up to the last relevant one by rounded score and id, however near the scores are."""
    rng = random.Random(2)
    last = 1.2345675
    rows = [(1, d, last + rng.randrange(-40, 40) * 1e-7) for d in range(300)] + [(1, 300, last)]
    hits = spark.createDataFrame(rows, "qid int, doc_id long, score double")
    got = E.curve(hits, spark.createDataFrame([(1, 300)], "topic int, doc_id long")).count()
    place = {d: (-s, d) for _, d, s in hits.selectExpr("qid", "doc_id", "round(score, 6) s").collect()}
    assert got == sum(p <= place[300] for p in place.values()) and 0 < got < 300


def test_metrics_read_at_any_cut(spark):
    hits = spark.createDataFrame([(q, d, 1.0 / (d + 1)) for q in (1, 2) for d in range(20)], "qid int, doc_id long, score double")
    qrels = spark.createDataFrame([(1, 2), (1, 4), (2, 7), (2, 99)], "topic int, doc_id long")
    topics = spark.createDataFrame([(1,), (2,), (3,)], "topic int")
    for k, cut in ((3, {1: 3, 2: 3}), (50, {1: 5, 2: 20}), (0, {1: 5, 2: 20}), (-2, {1: 4, 2: 19}), (-30, {1: -24, 2: -9})):
        got = {r.topic: r for r in E.metrics(hits, qrels, topics, k=k).collect()}
        for t, found in ((1, (2, 4)), (2, (7,))):
            want = round(sum(d < cut[t] for d in found) / cut[t], 4) if cut[t] > 0 else None
            assert got[t].precision == want and got[t].r_precision == 0.0 and got[t].N == {1: 5, 2: 20}[t], (k, t)
        assert got[3].N == 0 and got[3].precision is None


def test_postings_are_filtered_by_the_terms_asked_for(spark, monkeypatch):
    index = I.open_index(spark, SF_SMALL)
    terms = index.term_stats.filter("field = 'content'").orderBy("df", "term").limit(5).select("term")
    few = index.lookup(terms)
    assert "In(term" in plan(few) and few.filter("field = 'content'").count() == 5
    none = index.lookup(terms.limit(0))
    assert none.count() == 0
    queries = QS.phrase(spark, SF_SMALL)
    rows = lambda: sorted((r.qid, r.doc_id, round(r.score, 9)) for r in S.score(index, queries).collect())
    found = rows()
    monkeypatch.setattr(I, "FILTER_TERMS", 2)
    assert "In(term" not in plan(index.lookup(terms)) and index.lookup(terms).count() == index.postings.count()
    assert found and rows() == found


def test_exchanges_grow_with_the_tables(spark, tmp_path, monkeypatch):
    """Partitions of an exchange by what is scanned, not by the setting alone nor by a join's estimate."""
    spark.range(400_000).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    few = spark.createDataFrame([(k,) for k in range(20)], "id long")
    want = -(-size // 50_000)
    assert [SS.scan_parallelism(x, 50_000) for x in (t, t.join(few, "id"), few.join(t.selectExpr("id AS other")))] == [want] * 3
    assert want > SS.parallelism(spark)
    monkeypatch.setattr(I, "BUCKET_BYTES", 50_000)
    assert I.bucket_count(t) == want
    assert SS.scan_parallelism(t) == SS.scan_parallelism(spark.createDataFrame([(1,)], "a int")) == SS.parallelism(spark)
