"""The join that leaves rows without a partner where they are."""

import pytest

from ferret.llm import common


@pytest.mark.parametrize("limit, bits", [(400_000, 1 << 28), (0, 1 << 28), (0, 1 << 16), (0, 8)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_matched_is_the_join(spark, monkeypatch, limit, bits, how):
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", limit)
    monkeypatch.setattr(common, "SIEVE_BITS", bits)
    x = spark.createDataFrame([(None if k == 7 else k, str(k % 5), f"text {k}") for k in range(3000)] + [(3, "3", "twice")], "id long, k string, __bits string")
    few = common.stored(spark.createDataFrame([(None, "2", 0)] + [(k, str(k % 4), k) for k in range(-5, 4000, 3)], "id long, k string, found int"), "keys")
    got = common.matched(x, few, ["id", "k"], how=how)
    assert got.columns == ["id", "k", "__bits", "found"]
    assert sorted(map(str, got.collect())) == sorted(map(str, x.join(few, ["id", "k"], how).select(*got.columns).collect()))
    empty = few.filter("id = -99")
    assert common.matched(x, empty, ["id", "k"], how=how).count() == (3001 if how == "left" else 0)
