"""b-bit MinHash groups against brute force over all pairs."""

import itertools
import random
import re

import numpy as np

from ferret.llm import minhash
from tests.conftest import SF_SMALL


def shingle_set(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    sets = [(d, shingle_set(t, size)) for d, t in rows]
    top = {d: d for d, _ in sets}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    where = {}
    for d, s in sets:
        for x in s:
            where.setdefault(x, []).append(d)
    by = dict(sets)
    for a, b in {p for ds in where.values() for p in itertools.combinations(sorted(set(ds)), 2)}:
        n = len(by[a] & by[b])
        if 100 * n >= percent * (len(by[a]) + len(by[b]) - n):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets}


def check(spark, rows, size, percent):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, sig string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, size, percent).collect()}
    want = brute(rows, size, percent)
    assert got == want, [(d, got.get(d), want[d]) for d in want if got.get(d) != want[d]][:10]


def test_sample_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(spark, rows, 3, 85)


def test_chains_and_edges(spark):
    """A drifting chain (neighbours link, ends do not), copies, short texts."""
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(4000)]
    words = [rng.choice(vocab) for _ in range(200)]
    rows, k = [(0, None), (1, ""), (2, " \n\t"), (3, "One two"), (4, "one TWO"), (5, "one"), (6, "two one"), (7, "É é"), (8, "é é")], 9
    for _ in range(60):
        rows.append((k, " ".join(words)))
        at = rng.randrange(len(words))
        words = [*words[:at], rng.choice(vocab), *words[at + 1:]]
        k += 1
    for _ in range(30):  # around one text, pairs near the threshold
        w = list(words)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(200)] = rng.choice(vocab)
        rows.append((k, "\n".join(w).upper()))
        k += 1
    rows += [(k + 1, rows[20][1]), (k + 2, rows[20][1]), (k + 3, "z " * 50_000)]
    rng.shuffle(rows)
    check(spark, rows, 3, 85)
    check(spark, rows, 5, 80)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 2, 1, False)], key=str)


def test_one_id_on_unlike_rows(spark):
    """Doc 5 has two texts; 7 is near one and 8 near the other."""
    rng = random.Random(9)
    a, b = ([f"{x}{rng.randrange(9999)}" for _ in range(300)] for x in "ab")
    rows = [(5, a), (5, b), (7, a[:-1]), (8, b[:-1]), (9, b[1:-1]), (3, ["lone"]), (None, b)]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df, 3, 85).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (7, 5, False), (8, 5, False), (9, 5, False), (3, 3, True), (None, None, True)], key=str)
    both = minhash.keep_one(df, 3, 85).collect()  # rows with one id are still documents of their own
    assert sorted(r.doc_id or 0 for r in both) == [0, 3, 5] or sorted(r.doc_id or 0 for r in both) == [0, 3, 5, 5]


def test_estimate_is_corrected():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 2000, np.uint64)
    other = np.concatenate([base[:1000], rng.integers(0, 2**63, 1000, np.uint64)])
    low = minhash.minima(base), minhash.minima(other)
    equal = np.mean((low[0] >> np.uint64(17)) % 16 == (low[1] >> np.uint64(17)) % 16)
    assert abs((equal - 1 / 16) / (15 / 16) - 1 / 3) < 0.2
