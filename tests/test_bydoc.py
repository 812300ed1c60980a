"""Queries evaluated document by document: rows exchanged, wide clauses, ranks read."""

import random

import numpy as np
import pyarrow as pa

from ferret.functions import analyze as A
from ferret.operators import bydoc as B
from ferret.operators import dictionary as D
from ferret.operators import evaluate as E
from ferret.operators import index as I
from ferret.operators import terms as TM

from .conftest import SF_SMALL
from .test_operators import WORDS, glob, ix, run  # noqa: F401


def test_term_of_many_queries_is_exchanged_once(spark, ix, monkeypatch):  # noqa: F811
    """As many matched rows as (term, document) pairs, however many queries ask for a term."""
    index, docs = ix
    rows = []
    monkeypatch.setattr(B, "_by_document", lambda m, f=B._by_document: rows.append(m.count()) or f(m))
    word = max(WORDS, key=lambda w: sum(w in t for t in docs.values()))
    got = run(spark, index, *[word] * 30)
    want = {k for k, t in docs.items() if word in t}
    assert all(set(g) == want for g in got) and rows == [len(want)]


def test_wide_clauses_read_the_postings_once(spark, ix, monkeypatch):  # noqa: F811
    """Ranges, prefixes and wildcards that match many terms: no term is joined,
    and the documents are those of the definition."""
    index, docs = ix
    docs = {k: t - set(A.STANDARD.stop_list) for k, t in docs.items()}
    monkeypatch.setattr(D, "LOOKUP_TERMS", 0)
    lo, hi = sorted(WORDS)[2], sorted(WORDS)[-3]
    checks = {f"[{lo} TO {hi}]": lambda w: lo <= w <= hi, "[* TO *]": lambda w: True, f"[{lo} TO *]": lambda w: w >= lo, f"[{hi} TO {lo}]": lambda w: False}
    for w in WORDS[:6]:
        checks |= {w[:2] + "*": lambda x, w=w: x.startswith(w[:2]), "*" + w[-2:]: glob("*" + w[-2:]).fullmatch,
                   w[:1] + "?" + w[2:]: glob(w[:1] + "?" + w[2:]).fullmatch, "*" + w[1:3] + "*": glob("*" + w[1:3] + "*").fullmatch}
    got = run(spark, index, *checks)
    for (q, ok), g in zip(checks.items(), got):
        assert set(g) == {k for k, t in docs.items() if any(ok(w) for w in t)}, q
    asked = spark.createDataFrame([(1, "range", lo, hi), (1, "prefix", hi[:1], None), (2, "prefix", lo[:1], None)], "g int, kind string, term string, hi string")
    n = {r.g: r.n_docs for r in TM.count_docs(asked, index, ["g"]).collect()}
    has = lambda f: sum(any(f(w) for w in t) for t in docs.values())
    assert n == {1: has(lambda w: lo <= w <= hi or w.startswith(hi[:1])), 2: has(lambda w: w.startswith(lo[:1]))}


def test_slots_and_best_against_plain():
    rng = random.Random(5)
    ranges = [(p, a, a + rng.randrange(6)) for p, a in enumerate(rng.randrange(20) for _ in range(40))]
    held = [(d, rng.randrange(20)) for d in range(30) for _ in range(rng.randrange(4))]
    cols = np.array(ranges)
    d, p = B.Slots(cols[:, 0], cols[:, 1], cols[:, 2], 26).hit(*np.array(held).T)
    got = list(zip(d.tolist(), p.tolist()))
    assert len(got) == len(set(got)) and set(got) == {(d, p) for d, s in held for p, a, b in ranges if a <= s < b}
    best, rows = B._Best(3, 4), []
    for doc in range(300):
        q, s = rng.randrange(4), rng.randrange(5) / 7
        rows.append((q, -round(s, 6), doc))
        best.add(np.array([q]), pa.array([doc]), np.array([s]))
    got = sorted(zip(best.kept[0].tolist(), best.kept[1].to_pylist()))
    assert got == sorted((q, doc) for k in range(4) for q, _, doc in sorted(r for r in rows if r[0] == k)[:3])
    assert B.micro(np.array([0.0000005, 0.1234565, 2.5])).tolist() == [1, 123457, 2500000]


def test_hits_after_full_recall_are_not_ranked(spark, monkeypatch):
    hits = spark.createDataFrame([(q, d, 1.0 / (d + 1)) for q in (1, 2, 3) for d in range(50)], "qid int, doc_id long, score double")
    qrels = spark.createDataFrame([(1, 2), (1, 4), (2, 7), (2, 99)], "topic int, doc_id long")
    ranked = []
    monkeypatch.setattr(E, "running_ranks", lambda j, f=E.running_ranks: ranked.append({r.topic: r["count"] for r in j.groupBy("topic").count().collect()}) or f(j))
    got = {}
    for r in E.curve(hits, qrels).collect():
        got.setdefault(r.topic, []).append((r["rank"], r.rel))
    assert ranked == [{1: 5, 2: 50, 3: 50}]
    assert max(got[1]) == (5, 1) and len(got[1]) == 5 and len(got[2]) == len(got[3]) == 50


def test_texts_stay_where_they_are(spark):
    """Candidates go to the documents; texts are not exchanged for the join."""
    index = I.open_index(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.qrels_containment(spark, SF_SMALL, index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
