"""Variants of words: against brute force, and what is exchanged to find them."""

import random
import re

import pytest

from ferret.operators import dictionary as D
from ferret.operators import index as I

from .test_terms import _lev


@pytest.fixture(scope="module")
def strings(spark):
    rng = random.Random(11)
    words = {"".join(rng.choice("abä") for _ in range(rng.randrange(1, 10))) for _ in range(500)} | {"a", "aa", "aaaaaaaaa", "ababababab"}
    stats = spark.createDataFrame([("content", w, 1 + k) for k, w in enumerate(sorted(words))] + [("title", "ab", 7)], "field string, term string, df long")
    return sorted(words), I.Index(stats, stats, stats, 8)


def test_variants_are_those_of_brute_force_once_each(spark, strings):
    """Strings of few letters: most pairs share several pieces."""
    words, index = strings
    rng = random.Random(4)
    ask = [(w, e) for w in rng.sample(words, 60) + ["bbbbbbbbbbb", "äa", "c"] for e in (0, 1, 2)]
    asked = spark.createDataFrame([("content", *x) for x in ask], "field string, word string, edits int")
    got = sorted((r.word, r.edits, r.term, r.dist) for r in D.variants(asked, index).collect())
    assert got == sorted((w, e, t, _lev(w, t)) for w, e in ask for t in words if abs(len(w) - len(t)) <= e and _lev(w, t) <= e)


def test_only_terms_are_exchanged(spark, strings):
    """Neither pieces nor the pairs found go through an exchange."""
    words, index = strings
    asked = spark.createDataFrame([("content", w, 2) for w in words[:40]], "field string, word string, edits int")
    plan = D.variants(asked, index)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert len(dealt) == 1 and re.match(r"field#\d+, term#\d+, ", dealt[0]) and "SortMergeJoin" not in plan
    assert not [name for name in index.parts if name == "pieces"]
