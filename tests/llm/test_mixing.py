"""Pfair mixing against a slot-by-slot simulation and its lag bound."""

import math
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferret.llm import catalog, mixing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 8), st.integers(1, 60), min_size=1, max_size=8))
def test_round_stays_within_one_block(weights):
    quota = mixing.shares(weights)
    slots, size = mixing.pfair_round(quota), sum(quota.values())
    assert sorted(s for x in slots.values() for s in x) == list(range(size))
    for s, places in slots.items():
        for j, at in enumerate(places):  # j blocks served before slot ``at``
            assert j - 1 < quota[s] * at / size + 1e-9 and abs(j + 1 - quota[s] * (at + 1) / size) < 1


ROWS = [(k, None if k % 7 == 0 else "a" if k % 3 == 0 else "b" if k % 5 else "c", f"t{k}", k % 4) for k in range(700)]


def brute(rows, block, weights):
    """The definition, slot by slot: of the sources whose next block is released
    at floor((j - 1) / w) the earliest due, ceil(j / w); ties by source. When a
    source has no block left, the others begin anew with their shares."""
    names = sorted({r.source for r in rows}, key=lambda s: (s is not None, s or ""))
    n = Counter(r.source for r in rows)
    left = [-(-n[s] // block) for s in names]
    served, order = Counter(), []
    while any(left):
        live = [k for k, x in enumerate(left) if x]
        whole = {k: Fraction(str(weights.get(names[k], 1.0))) for k in live}
        w = {k: x / sum(whole.values()) for k, x in whole.items()}
        j, t = dict.fromkeys(live, 1), 0
        while all(left[k] for k in live):
            _, k = min((math.ceil(j[k] / w[k]), k) for k in live if math.floor((j[k] - 1) / w[k]) <= t)
            order.append((names[k], served[k]))
            served[k] += 1
            left[k] -= 1
            j[k] += 1
            t += 1
    return order


@pytest.mark.parametrize("weights", [{}, {"a": 5.0, "c": 0.5}, {"a": 0.37, "b": 3.3333}])
def test_schedule_matches_simulation(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 40)
    df = spark.createDataFrame([*ROWS, ROWS[3], ROWS[3]], "doc_id long, source string, block string, position int")
    got = mixing.schedule(df, weights, block=16, out=("b", "slot", "pos")).collect()
    assert sorted(r.pos for r in got) == list(range(len(ROWS) + 2))
    by_slot = sorted({(r.slot, r.source, r.b) for r in got}, key=lambda x: x[0])
    assert [(s, b) for _, s, b in by_slot] == brute(got, 16, weights)
    assert [r.slot for r in sorted(got, key=lambda r: r.pos)] == sorted(r.slot for r in got)


def test_edges(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.schedule(spark.createDataFrame([], schema)).count() == 0
    one = mixing.schedule(spark.createDataFrame([(None, None, None)], schema)).collect()
    assert (one[0].block, one[0].slot, one[0].position) == (0, 0, 0)
    with pytest.raises(ValueError):
        mixing.schedule(spark.createDataFrame([], schema), {"a": 0.0})


def test_mixed_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, __row string, position int")
    got = mixing.mixed(df, block=8)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


SKEWED = {0: 1.0, 1: 0.0001, 2: 0.37, 3: 3.3333}


@pytest.mark.parametrize("weights", [*(dict.fromkeys(range(n), 1.0) for n in (11, 19, 20, 2000)), SKEWED])
def test_lag_to_true_weights_over_many_rounds(weights):
    many = {s: 60_000 * w / sum(weights.values()) for s, w in weights.items()}
    blocks = {s: int(n) + 1 + (s == 3) * 500 for s, n in many.items()} | ({19: 1} if len(weights) == 20 else {})
    served, taken = dict.fromkeys(weights, 0), 0
    for p in mixing.phases(blocks, weights):
        live = sum(weights[s] for s in weights if served[s] < blocks[s])
        for s, (first, n, quota, slots) in p["of"].items():
            assert first == served[s]
            w = weights[s] / live
            for j in range(n):  # j blocks of the phase served before slot ``at``
                at = j // quota * p["size"] + slots[j % quota]
                assert j - w * at < 1 + 1e-9 and w * (at + 1) - (j + 1) < 1 + 1e-9
            served[s] += n
            taken += n
    assert served == blocks and taken == sum(blocks.values())


def test_pieces_of_long_rounds(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, block string, position int")
    run = lambda: sorted(map(tuple, mixing.schedule(df, {"a": 5.0, "c": 0.123}, block=2, out=("b", "slot", "pos")).collect()), key=str)
    want = run()
    assert sorted(r[-1] for r in want) == list(range(len(ROWS)))
    monkeypatch.setattr(mixing, "INLINE", 2)
    monkeypatch.setattr(mixing, "PIECE", 8)
    assert run() == want
    monkeypatch.setattr(mixing, "MAX_PIECES", 0)
    assert run() == want


def test_registered_weights_differ(spark, tmp_path):
    rows = [(k, [None, "src0", "src1", "src5"][k % 4], "t") for k in range(3200)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op3_mix_sources"](spark, str(tmp_path)).select("source", "slot").distinct().collect()
    first = sorted((r.slot, r.source) for r in got)[:15]  # a round of 1 + 8 + 4 + 2 slots
    assert Counter(s for _, s in first) == {None: 1, "src0": 8, "src1": 4, "src5": 2}
