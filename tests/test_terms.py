"""fuzzy_match against a brute force over the whole small vocabulary."""

from tests.conftest import SF_SMALL

from ferret.operators import index as I
from ferret.plans import catalog


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_brute_force(spark):
    got = {(r.qid, r.term, r.variant, r.dist) for r in catalog.QUERIES["fuzzy_match"](spark, SF_SMALL).collect()}
    ix = I.open_index(spark, SF_SMALL)
    vocab = [r.term for r in ix.term_stats.filter("field = 'content'").select("term").collect()]
    terms = {(q, t) for q, t, _, _ in got}
    want = {(q, t, v, _lev(t, v)) for q, t in terms for v in vocab if _lev(t, v) <= 2}
    assert got == want and len(terms) > 0


def test_fuzzy_asks_every_passage_term(spark):
    from ferret.operators import terms

    asked = {tuple(r) for r in terms.passage_terms(spark, SF_SMALL).select("qid", "term").distinct().collect()}
    vocab = {r.term for r in I.open_index(spark, SF_SMALL).term_stats.filter("field = 'content'").select("term").collect()}
    known = {(q, t) for q, t in asked if t in vocab}
    got = catalog.QUERIES["fuzzy_match"](spark, SF_SMALL).collect()
    assert known <= {(r.qid, r.term) for r in got} <= asked and len(known) > len({q for q, _ in known})
    assert len({(r.qid, r.term, r.variant) for r in got}) == len(got) and all((r.dist == 0) == (r.term == r.variant) for r in got)
    some = sorted({t for _, t in asked})[::40]
    pairs = {(r.term, r.variant, r.dist) for r in got if r.term in some}
    assert pairs == {(t, v, _lev(t, v)) for t in some for v in vocab if abs(len(t) - len(v)) <= 2 and _lev(t, v) <= 2}
