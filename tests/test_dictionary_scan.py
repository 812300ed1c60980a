"""The dictionary of an index is scanned, not exchanged, for the terms of queries."""

import pytest

from ferret.operators import index as I
from ferret.operators import query as Q
from ferret.operators import search as S
from ferret.operators import terms as TM
from ferret.plans import querysets as QS

from .conftest import SF_SMALL


@pytest.fixture
def no_guess(spark):
    """The planner broadcasts nothing on its own, as with a large dictionary."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_asked_terms_leave_the_dictionary(spark, no_guess):
    index = I.open_index(spark, SF_SMALL)
    rows = []
    terms = TM.passage_terms(spark, SF_SMALL)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    weights = S.leaf_weights(Q.leaves(QS.keyword(spark, SF_SMALL)), index)
    assert "LeftSemi, BuildRight" in plan(weights)
    assert all(w.idf > 0 for w in weights.select("idf").collect())
    for pick in (TM.rarest_term, TM.most_common_term):
        rows.append(pick(terms, index))
        assert "BroadcastHashJoin" in plan(rows[-1]) and "SortMergeJoin" not in plan(rows[-1])
    assert rows[0].count() == rows[1].count() > 0
