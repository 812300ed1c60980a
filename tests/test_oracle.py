"""Spark plans against their DuckDB oracle text on the smallest tables."""

import pytest
from tests.conftest import SF_SMALL

from ferret.plans import catalog
from tests.oracle_harness import compare, duck

FAST = ["tokenize", "porter_stem", "stopword_filter", "vocab_size_grid", "build_postings", "term_stats",
        "keyword_topk", "phrase_match", "fielded_search", "total_hits", "eval_metrics", "pool_random_fill",
        "similar_groups_bow", "cosine_topk", "popular_topics", "page_snippet", "query_fields", "phrase_slop"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    s, d, *_ = compare(spark, catalog.QUERIES[name], catalog.oracle_text(name), SF_SMALL, con)
    assert s == d


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "score" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
