"""Decomposition of the ten topic query shapes into clause leaves."""

from pyspark.sql import functions as F

from ferret.operators import query as Q


def _leaves(spark, q, adv=None):
    df = spark.createDataFrame([(1, q, adv)], "qid int, query string, adv map<string,string>")
    return Q.leaves(df).collect()


def test_phrase_plus_facet(spark):
    """'"garden walls"' + year:2000 -> MUST(phrase group: 2 terms +
    phrase^5) and MUST(year = 2000)."""
    lv = _leaves(spark, '"garden walls"', {"year": "2000"})
    kinds = sorted((r.ga, r.kind, r.boost) for r in lv)
    assert kinds == [("0:P", "phrase", 5.0), ("0:P", "term", 1.0), ("0:P", "term", 1.0), ("1:K", "term", 1.0)]
    assert all(r.must for r in lv) and lv[0].n_a == 2 and lv[0].n_must == 2


def test_free_text_should(spark):
    lv = _leaves(spark, "copper kettle 1987")
    assert len(lv) == 3 and not any(r.must for r in lv) and lv[0].n_b == 3 and lv[0].n_must == 0


def test_hyphen_two_terms_one_clause(spark):
    lv = _leaves(spark, "half-timbered barns")
    by_b = {}
    for r in lv:
        by_b.setdefault(r.b, []).append(r.term)
    assert sorted(map(sorted, by_b.values())) == [["barns"], ["half", "timbered"]]


def test_title_is_stemmed(spark):
    lv = _leaves(spark, "", {"title": "marble analysis", "year": "2010"})
    terms = sorted((r.field, r.term) for r in lv)
    assert terms == [("title", "analysi"), ("title", "marbl"), ("year", "2010")]


def test_empty_query_has_no_leaves(spark):
    assert _leaves(spark, "   ") == []


def test_two_phrases_both_required(spark):
    lv = _leaves(spark, '"river ferries" "clay pipes"')
    assert {r.n_b for r in lv} == {2} and all(r.b_all for r in lv)
