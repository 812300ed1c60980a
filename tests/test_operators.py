"""Query operators as clauses: what the strings become, what they match
(against brute force over the whole small vocabulary), how they score."""

import bisect
import random
import re

import pytest
from pyspark.sql import functions as F

from ferret.operators import dictionary as D
from ferret.operators import index as I
from ferret.operators import ordinals
from ferret.operators import query as Q
from ferret.operators import search as S
from tests.conftest import SF_SMALL
from tests.test_terms import _lev

WORDS = ["a", "ab", "abc", "abd", "b", "ba", "bab", "cab", "cabs", "cäb", "dab", "d_b", "d.b", "écab", "zz", "zzz", "cabcab"]


@pytest.fixture(scope="module")
def ix(spark):
    """Documents of a few of the words each, with the index lazily derived."""
    rng = random.Random(3)
    rows = [(k, " ".join(rng.sample(WORDS, rng.randrange(1, 6)))) for k in range(60)]
    docs = spark.createDataFrame([(k, t, "s", "en") for k, t in rows], "doc_id long, text string, source string, lang string")
    rec = docs.select("doc_id", F.lit("").alias("title"), F.col("text").alias("content"), F.col("source").alias("venue"), F.col("lang").alias("year"))
    x = I.index_records(rec)
    post, _ = S.materialize(x.postings)
    stats, _ = S.materialize(x.term_stats)
    corpus, _ = S.materialize(x.corpus)
    return I.Index(post, stats, corpus, x.buckets), {k: set(t.split()) for k, t in rows}


def run(spark, ix, *queries):
    df = spark.createDataFrame([(k, q) for k, q in enumerate(queries)], "qid int, query string").withColumn("adv", F.lit(None).cast("map<string,string>"))
    out = [{} for _ in queries]
    for r in S.score(ix, df, operators=True).collect():
        out[r.qid][r.doc_id] = r.score
    return out


def glob(pattern):
    return re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern))


def test_strings_become_leaves(spark):
    q = 'plain -gone half-way opti* -op?n x^2 [a TO c]^3 word~ Word~1 "a phrase"'
    df = spark.createDataFrame([(1, q, None)], "qid int, query string, adv map<string,string>")
    lv = Q.leaves(df, operators=True).collect()
    got = sorted((r.kind, r.term, r.hi, r.edits, r.boost, r.no) for r in lv if r.ga == "0:K")
    assert got == sorted([("term", "plain", None, None, 1.0, False), ("term", "gone", None, None, 1.0, True), ("term", "half", None, None, 1.0, False),
                          ("term", "way", None, None, 1.0, False), ("prefix", "opti", None, None, 1.0, False), ("wildcard", "op?n", None, None, 1.0, True),
                          ("term", "x", None, None, 2.0, False), ("range", "a", "c", None, 3.0, False), ("fuzzy", "word", None, 2, 1.0, False),
                          ("fuzzy", "word", None, 1, 1.0, False)], key=str)
    assert {r.n_b for r in lv if r.ga == "0:K"} == {7}  # prohibited clauses do not count
    off = Q.leaves(df).collect()
    assert "no" not in off[0].asDict() and all(r.kind in ("term", "phrase") for r in off)


@pytest.mark.parametrize("block,fan", [(64, 16), (2, 2)])
def test_matches_are_those_of_brute_force(spark, ix, monkeypatch, block, fan):
    index, docs = ix
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "FAN", fan)
    index = I.Index(index.postings, index.term_stats, index.corpus, index.buckets)
    patterns = ["a*", "cab*", "nothere*", "*b", "?ab", "c*b", "*", "??", "z?*", "d?b", "d_b*", "*a*a*", "C?B"]
    ranges = [("a", "b"), ("ab", "cab"), ("*", "b"), ("cab", "*"), ("*", "*"), ("b", "a"), ("x", "y"), ("A", "ABD"), ("zz", "zzz"), ("", "")]
    ranges = [r for r in ranges if r[0]]
    fuzzy = [("cab", 1), ("cab", 2), ("cab", 0), ("zzzz", 1), ("qqqqqq", 2), ("a", 1), ("écab", 1)]
    queries = patterns + [f"[{a} TO {b}]" for a, b in ranges] + [f"{w}~{e}" for w, e in fuzzy]
    stop = "a"  # a stop word: no document is indexed by it
    vocab = set(WORDS) - {stop}

    def terms_of(k):
        if k < len(patterns):
            rx = glob(patterns[k].lower())
            return {t for t in vocab if rx.fullmatch(t)}
        if k < len(patterns) + len(ranges):
            a, b = (x.lower() for x in ranges[k - len(patterns)])
            return {t for t in vocab if (a == "*" or t.encode() >= a.encode()) and (b == "*" or t.encode() <= b.encode())}
        w, e = fuzzy[k - len(patterns) - len(ranges)]
        return {t for t in vocab if _lev(w, t) <= e}

    for k, got in enumerate(run(spark, index, *queries)):
        want = {d for d, ws in docs.items() if ws & terms_of(k)}
        assert set(got) == want, queries[k]
        assert all(abs(s - 1.0) < 1e-9 for s in got.values())  # a lone constant clause: boost * queryNorm


def test_scores_and_scope_of_clauses(spark, ix):
    index, docs = ix
    plain, both, no, only, boosted, mixed, scoped = run(
        spark, index, "cab bab", "cab bab -zz", "cab bab -z*", "-cab", "cab^3 bab", "cab ca*", '"cab" -zz')
    assert set(both) == set(plain) - {d for d, w in docs.items() if "zz" in w}
    assert all(abs(both[d] - plain[d]) < 1e-12 for d in both)  # prohibited clauses do not score
    assert set(no) == set(plain) - {d for d, w in docs.items() if w & {"zz", "zzz"}} and only == {}
    assert set(boosted) == set(plain) and any(abs(boosted[d] - plain[d]) > 1e-6 for d in plain)
    assert set(mixed) == {d for d, w in docs.items() if w & {"cab", "cabs", "cabcab"}}
    one = next(d for d in mixed if "cab" not in docs[d])
    assert all(mixed[d] > mixed[one] for d in mixed if "cab" in docs[d])
    # a prohibited word takes documents out of its own group, not out of the phrase's
    assert set(scoped) == {d for d, w in docs.items() if "cab" in w}


def test_slop_is_an_argument(spark):
    rows = [(1, "red green blue"), (2, "red x green blue"), (3, "red x y green blue"), (4, "green red blue"), (5, "red"), (6, "red green q red green blue")]
    rec = spark.createDataFrame([(k, "", t, "s", "en") for k, t in rows], "doc_id long, title string, content string, venue string, year string")
    index = I.index_records(rec)
    q = spark.createDataFrame([(1, '"red green"')], "qid int, query string").withColumn("adv", F.lit(None).cast("map<string,string>"))
    lv, n = S.materialize(Q.leaves(q))
    freq = {slop: {r.doc_id: r.freq for r in S.sloppy_phrase_freq(lv, index, n, slop).collect()} for slop in (1, 2)}
    assert freq[1] == {1: 1.0, 2: 0.5, 6: 2.0}
    assert freq[2] == {1: 1.0, 2: 0.5, 3: 1 / 3, 4: 1 / 3, 6: 2.0}
    near, far = ({r.doc_id: r.score for r in S.score(index, q, slop=s).collect()} for s in (0, 2))
    assert far[2] > near[2] and abs(far[1] / near[1] - 1) < 1e-9  # a sloppy match scores, an exact one as before
    heavy = {r.doc_id: r.score for r in S.score(index, q, boost=9.0).collect()}
    assert heavy[1] / heavy[5] > near[1] / near[5]


def test_ordinals(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(500)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = sorted((r.g, r.ord, r.v) for r in ordinals.placed(df, ["v"], "g").collect())
    for g in "ab":
        assert [v for x, _, v in got if x == g] == sorted(v for x, v in rows if x == g)
        assert [o for x, o, _ in got if x == g] == list(range(sum(x == g for x, _ in rows)))
    assert sorted(r.ord for r in ordinals.placed(df, ["v"]).collect()) == list(range(800))
    keys = sorted({f"{rng.randrange(900):03}" for _ in range(200)})
    marks = spark.createDataFrame([("g", k, i) for i, k in enumerate(keys)], "g string, key string, m long")
    probes = spark.createDataFrame([("g", f"{k:03}", k) for k in range(0, 900, 7)] + [("h", "500", -1)], "g string, key string, id long")
    got = {r.id: r.m for r in ordinals.last_mark(probes, marks, "g", "key", "m").collect()}
    want = {k: (bisect.bisect_right(keys, f"{k:03}") - 1) for k in range(0, 900, 7)}
    assert got == {k: (v if v >= 0 else None) for k, v in want.items()} | {-1: None}


def test_range_plan_forms_no_pairs_with_terms(spark):
    """A range over nearly all terms reads few nodes and the terms of two blocks."""
    index = I.open_index(spark, SF_SMALL)
    x = spark.createDataFrame([(1, "0:K", 0, 0, "range", "content", "b", "y")], "qid int, ga string, b int, c int, kind string, field string, term string, hi string")
    covered, edges = D.ranges(x, index)
    inside = index.term_stats.filter("field = 'content' AND term BETWEEN 'b' AND 'y'").count()
    assert edges.count() <= 2 * D.BLOCK and covered.count() <= 4 * D.FAN and inside > 4 * D.BLOCK
