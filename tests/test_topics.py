"""Chunk grammar and lexicon as arguments, popular phrases against brute
force, saved topic models."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferret.operators import similar as SIM
from ferret.operators import topics as TP
from ferret.sources import sinks
from tests.conftest import SF_SMALL

TITLES = ["Fast parallel sorting networks of large graphs", "The cats", "", "networks, networks and a network", "zog zig zag", None,
          "very " + "graph " * 3000 + "end"]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame(list(enumerate(TITLES)), "doc_id long, title string")


def phrases(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append((r.idx, r.phrase, r.n_words))
    return {k: [p for _, p, _ in sorted(v)] for k, v in out.items()}


def test_grammar_is_an_argument(spark, titles):
    base = phrases(TP.noun_phrases(titles, ["doc_id"]))
    assert base[0][0] == "fast parallel" and base[3] == ["network"] and 1 not in base and 2 not in base and 5 not in base
    assert base[6] == [" ".join(["graph"] * 3000 + ["end"])]
    nouns = phrases(TP.noun_phrases(titles, ["doc_id"], grammar="[NS]+"))
    assert nouns[1] == ["cats"] and nouns[3] == ["networks", "networks", "network"]
    pairs = phrases(TP.noun_phrases(titles, ["doc_id"], grammar="NN|S(?=C)"))
    assert pairs[4] == ["zog zig"] and pairs[3] == ["networks"] and len(pairs[6]) == 1500
    assert phrases(TP.noun_phrases(titles, ["doc_id"], grammar="9*")) == {}  # matches of nothing are none


def test_lexicon_is_a_table(spark, titles):
    lex = spark.createDataFrame([("zig", "JJ"), ("Zog", "DT"), ("graph", "VB"), ("zig", "NN")], "word string, tag string")
    got = phrases(TP.noun_phrases(titles, ["doc_id"], lexicon=lex))
    assert got[4] == ["zig zag"] and got[6] == ["very", "end"]  # "very" is not in this lexicon
    assert phrases(TP.noun_phrases(titles, ["doc_id"], lexicon=lex, grammar="D")) == {4: ["zog"]}
    every = spark.createDataFrame([(w, t) for t, ws in TP.LEXICON.items() for w in ws], "word string, tag string")
    assert phrases(TP.noun_phrases(titles, ["doc_id"], lexicon=every)) == phrases(TP.noun_phrases(titles, ["doc_id"]))


def test_no_exchange_of_tokens(spark, titles):
    plan = TP.noun_phrases(titles, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_popular_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for year, n in (("hot", 6000), ("cold", 300), ("one", 1)):
        for _ in range(n):
            k = rng.choice([1, 1, 1, 2, 3, 4])
            rows.append((year, " ".join(f"w{int(rng.paretovariate(0.5)) % 3000}" for _ in range(k)), k))
    rows += [("ties", f"t{k:04}", 1) for k in range(1000)]
    got = {}
    for r in TP.popular(spark.createDataFrame(rows, "year string, phrase string, n_words int"), "year", 10).collect():
        got.setdefault(r.year, []).append((r.rank, r.phrase, r.cnt))
    for year in {r[0] for r in rows}:
        best = []
        for k in (1, 2, 3):
            ranked = sorted(Counter(p for y, p, n in rows if y == year and n == k).items(), key=lambda x: (-x[1], x[0]))
            skip = len(ranked) // 100 if k == 1 else 0
            best += ranked[skip:skip + 10]
        best = sorted(best, key=lambda x: (-x[1], x[0]))[:10]
        assert sorted(got[year]) == [(i + 1, p, c) for i, (p, c) in enumerate(best)]
    assert min(p for _, p, _ in got["ties"]) == "t0010"


def test_topic_model_bundle(spark, tmp_path):
    corpus, vocab, size = SIM.lda_corpus(spark, SF_SMALL)
    first = corpus.first()["features"]
    assert first.size == size and list(first.indices) == sorted(first.indices)
    model = SIM.lda_fit(corpus, k=4, max_iter=3)
    path = str(tmp_path / "bundle")
    sinks.save_topics(path, model, vocab, corpus.select("venue", "year"))
    other = spark.newSession()
    again, words, groups = sinks.load_topics(other, path)
    want = sorted(map(tuple, SIM.topic_words(model, vocab).collect()))
    assert sorted(map(tuple, SIM.topic_words(again, words).collect())) == want and len(want) == 32
    assert groups.count() == corpus.count() and words.count() == size
    with pytest.raises(FileNotFoundError):
        sinks.load_topics(spark, str(tmp_path / "none"))
    steps = SIM.lda_steps(corpus, k=4, steps=(1, 8)).collect()
    assert [r.iterations for r in steps] == [1, 8] and steps[1].log_perplexity < steps[0].log_perplexity


def test_unknown_group_is_a_row(spark):
    groups = spark.createDataFrame([("v1", "en", 3)], "venue string, year string, n_terms int")
    asked = spark.createDataFrame([("v1", "en"), ("v1", "xx"), ("v9", "en")], "venue string, year string")
    got = sorted(map(tuple, SIM.looked_up(asked, groups, ["venue", "year"]).collect()))
    assert got == [("v1", "en", True, 3), ("v1", "xx", False, None), ("v9", "en", False, None)]


def test_rewrite_leaves_text_after_an_unclosed_quote(spark):
    from ferret.plans import catalog

    q = spark.createDataFrame([(1, 0, 'a "b c" d "e f'), (2, 0, '"b c"'), (3, 0, "plain authors:x y")], "qid int, shape int, q string")
    real = catalog._topic_strings
    catalog._topic_strings = lambda *_: q
    try:
        got = {r.qid: r.rewritten for r in catalog.QUERIES["query_rewrite"](spark, "").collect()}
    finally:
        catalog._topic_strings = real
    assert got == {1: 'a b.c d "e f', 2: "b.c", 3: "plain author:x y"}
