"""Random-projection forest against all pairs."""

import numpy as np
import pytest

from ferret.llm import rptrees
from tests.conftest import SF_SMALL


def brute(rows, threshold):
    good = {k: np.array(v, float) for k, (i, v) in enumerate(rows) if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)}
    top, n = {k: k for k in range(len(rows))}, [0] * len(rows)

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = list(good)
    for a, k in enumerate(keys):
        for j in keys[a + 1:]:
            x, y = good[k], good[j]
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold - 1e-12:
                n[k] += 1
                n[j] += 1
                p, q = sorted((find(k), find(j)), key=lambda z: rows[z][0])
                top[q] = p
    low = {}
    for k in range(len(rows)):
        if rows[k][0] is not None:
            low[find(k)] = min(low.get(find(k), rows[k][0]), rows[k][0])
    return sorted(((i, n[k], low.get(find(k)) if i is not None else None, i is None or low[find(k)] == i) for k, (i, _) in enumerate(rows)), key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, rptrees.near_duplicates(df, **how).collect()), key=str)


def test_sample_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows, 0.95)


def test_dense_cluster_and_edges(spark, monkeypatch):
    monkeypatch.setattr(rptrees, "CHUNK", 16)
    monkeypatch.setattr(rptrees, "LEAF", 30)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(12)
    rows = [(k, (base + rng.standard_normal(12) * 0.12).astype(np.float32).tolist()) for k in range(150)]
    rows += [(1000 + k, rng.standard_normal(12).astype(np.float32).tolist()) for k in range(300)]
    rows += [(2000 + k, rows[5][1]) for k in range(40)] + [(3000, (np.array(rows[5][1]) * 3).tolist()), (5, rows[5][1])]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 12), (4003, [float("nan")] + [1.0] * 11), (4004, [None] + [1.0] * 11),
             (4005, [1.0, 2.0]), (4006, [1.0, 2.0]), (None, rows[5][1]), (4007, [float("inf")] * 12)]
    got, want = run(spark, rows), brute(rows, 0.95)
    linked = sum(x[1] for x in want)
    assert sum(x[1] for x in got) >= 0.97 * linked
    assert [(x[0], x[2], x[3]) for x in got] == [(x[0], x[2], x[3]) for x in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def turned(rng, x, cosine):
    """A vector at this cosine to the unit vector ``x``."""
    y = rng.standard_normal(len(x))
    y -= (y @ x) * x
    return cosine * x + np.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y)


@pytest.mark.parametrize("chunk", [512, 7])
def test_pairs_paths_stars_and_even_cycles(spark, monkeypatch, chunk):
    """Groups without an odd cycle, within a chunk and across chunks, in leaves
    shared by several trees; ids that occur twice, on unlike vectors too."""
    monkeypatch.setattr(rptrees, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(24))
    rows = []
    for _ in range(25):
        a = unit()
        rows += [a, turned(rng, a, 0.96)]
        path = [unit()]
        while len(path) < 6:
            path.append(turned(rng, path[-1], 0.955))
        rows += path
        hub = unit()
        rows += [hub, *(turned(rng, hub, 0.955) for _ in range(5))]
        e, f, g = unit(), unit(), unit()  # a square: neighbours at 0.9525, diagonals near 0.905
        rows += [e + 0.158 * (p * f + q * g) for p, q in ((1, 1), (1, -1), (-1, -1), (-1, 1))]
    ids = rng.permutation(len(rows)).tolist()
    table = [(i, x.tolist()) for i, x in zip(ids, rows, strict=True)]
    table += [(table[k][0], table[k + 40][1]) for k in range(0, 200, 23)] + [(900 + k, table[k][1]) for k in range(0, 60, 7)]
    table = [(i, np.float32(x).tolist()) for i, x in table]
    want = brute(table, 0.95)
    assert sum(x[1] > 0 for x in want) > 300
    assert run(spark, table, threshold=0.95) == want


def test_large_leaves_are_split_again(spark, monkeypatch):
    """A forest that is one leaf a tree is grown by the tasks: the same links,
    from leaves that are small but for a dense cluster."""
    monkeypatch.setattr(rptrees, "FLOATS", 0)
    monkeypatch.setattr(rptrees, "TREES", 6)
    monkeypatch.setattr(rptrees, "BIG", 120)
    rng = np.random.default_rng(12)
    rows = [x / np.linalg.norm(x) for x in rng.standard_normal((900, 16))]
    rows += [turned(rng, rows[k], 0.953) for k in range(250)]
    dense = rng.standard_normal(16)
    rows += [dense + rng.standard_normal(16) * 0.02 for _ in range(150)]
    table = [(k, np.float32(x).tolist()) for k, x in enumerate(rows)] + [(5000, [1.0, 2.0]), (5001, [1.0, 2.01]), (5002, None)]
    seen = []
    real = rptrees._split_again
    monkeypatch.setattr(rptrees, "_split_again", lambda led, t: seen.append(real(led, t)) or seen[-1])
    got, want = run(spark, table, threshold=0.95), brute(table, 0.95)
    sizes = sorted(r["count"] for r in seen[0].selectExpr("explode(leaves) AS leaf").groupBy("leaf").count().collect())
    assert len(sizes) > 60 and np.mean(np.array(sizes) <= 120) > 0.85 and sizes[-1] < 700
    assert sum(x[1] for x in want) > 20_000
    assert sum(a != b for a, b in zip(got, want, strict=True)) <= 0.01 * len(want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_forest_brings_linked_pairs_together():
    """Pairs just above the threshold share a leaf, with trees sized for the
    table and for one of 10 million rows."""
    rng = np.random.default_rng(8)
    x = rptrees.unit(rng.standard_normal((20_000, 64)))
    pairs = np.array([turned(rng, x[k], 0.951) for k in range(500)])
    for rows in (len(x), 10_000_000):
        forest = rptrees.Forest(x[:rptrees.SAMPLE], rows, 0.95)
        a, b = forest.route(x[:500]), forest.route(pairs)
        assert sum(bool(set(p) & set(q)) for p, q in zip(a, b, strict=True)) >= 498


def test_empty(spark):
    assert run(spark, []) == []


def test_leaves_stay_few_in_a_loose_cluster(monkeypatch):
    rng = np.random.default_rng(5)
    loose = rng.standard_normal(64) / 8 + rng.standard_normal((500, 64)) * 0.25 / 8  # mean cosine 0.94
    x = rptrees.unit(np.concatenate([loose, rng.standard_normal((1000, 64))]))
    monkeypatch.setattr(rptrees, "TREES", 2)
    forest = rptrees.Forest(x, 1e9, 0.95)
    led = forest.route(x)
    assert sum(map(len, led)) <= 2 * (rptrees.COPIES + 1) * len(x) and max(map(len, led)) < 100
    assert 20 < forest.leaves < 2 * len(x)  # the rest of the table is still split
    monkeypatch.setattr(rptrees, "FLOATS", 2 * 64 * 10)
    assert rptrees.Forest(x, 1e9, 0.95).leaves == 2 * 11
