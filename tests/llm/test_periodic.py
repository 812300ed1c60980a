"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ferret.llm import catalog, periodic
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare


def brute(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                out.setdefault((s, i + q), q)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rng):
    """Words with stretches of many periods, also nested and overlapping."""
    w, size, kinds = [], rng.choice([0, 5, 30, 200, 700]), rng.choice([1, 2, 3, 20, 1000])
    while len(w) < size:
        base = [rng.randrange(kinds) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40]))]
        w += [base[i % len(base)] for i in range(rng.randrange(1, 9 * len(base)))] if rng.random() < 0.5 else base
    return w


@pytest.mark.parametrize("seed", range(8))
def test_find_matches_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(periodic, "SLAB", 64)
    for _ in range(15):
        docs = [made(rng) for _ in range(rng.randrange(1, 6))]
        want, at = [], 0
        for d in docs:
            want += [(s + at, e + at, q) for s, e, q in brute(d)]
            at += len(d)
        got = periodic.find(np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs], np.int64))
        assert [tuple(x) for x in got.tolist()] == want


def test_transform_round_trip_and_mismatches():
    rng = np.random.default_rng(2)
    x = rng.integers(0, periodic.PRIME, (4, 64))
    assert (periodic.back(periodic.transform(x)) == x).all()
    block, window = rng.integers(0, 1000, (3, 16)), rng.integers(0, 1000, (3, 31))
    want = [[int(((b - w[t:t + 16]) ** 2).sum()) for t in range(16)] for b, w in zip(block, window, strict=True)]
    assert periodic.mismatches(block, window).tolist() == want


def test_long_stretches_and_no_run():
    one = periodic.find(np.zeros(200_000, np.int64), np.array([200_000]))
    assert one.tolist() == [[0, 200_000, 1]]
    many = np.tile(np.arange(20_000), 9)
    assert periodic.find(many, np.array([len(many)])).tolist() == [[0, len(many), 20_000]]
    assert len(periodic.find(np.tile(np.arange(20_000), 3), np.array([60_000]))) == 0


TEXTS = [None, "", " \n\t ", "a a a a a", "a a a a a a", "A a A a A a A a b", "x " * 50_000, "é é  é é  é é  é é ", "one two three", "same", "same",
         "go " * 9 + "stop " * 7 + "go on " * 6]


def test_edges(spark):
    columns = "doc_id long, text string, runs string, collapsed int, start int"
    df = spark.createDataFrame([(k or None, t, "r", 1, 2) for k, t in enumerate(TEXTS)], columns)
    got = periodic.periodic_runs(df, ["doc_id", "start"]).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id or 0: r for r in got}
    for k, t in enumerate(TEXTS):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        want = [(0, len(w), 1)] if k == 6 else brute(w)
        assert [(r.start, r.start + r.length, r.period) for r in by[k].runs] == want
        assert by[k].collapsed == collapsed(w, want) and by[k].start == 2
    assert periodic.periodic_runs(spark.createDataFrame([], columns), ["doc_id"]).count() == 0


def test_query_matches_oracle_and_plain_version(spark):
    s, d, *_ = compare(spark, catalog.QUERIES["op13_periodic_runs"], catalog.SQL["op13_periodic_runs"], SF_SMALL)
    assert s == d and s[0] > 0
    got = {r.doc_id: r for r in catalog.QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()}
    some = 0
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        w = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = brute(w)
        some += bool(runs)
        x = got[r.doc_id]
        assert x.n_runs == len(runs) and x.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        assert x.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest()
    assert some > 5
