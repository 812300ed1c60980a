"""Repeated byte strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest

from ferret.llm import common, suffix
from tests.conftest import SF_SMALL


def brute(rows):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - suffix.WIDTH + 1):
            w = raw[k:k + suffix.WIDTH]
            if w in seen:
                gone[k:k + suffix.WIDTH] = True
            seen.add(w)
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "r") for d, t in rows], "doc_id long, text string, rid int, spans string").repartition(3)
    return sorted(map(tuple, suffix.digests(df).collect()), key=str)


def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé ☃") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(60), text(30)
    rows = [(k, text(rng.randrange(1, 200)) + (passage if k % 3 else "") + text(20) + other[:rng.randrange(30, 200)] + text(3)) for k in range(40)]
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, rows[3][1][5:-7]), (53, None), (54, ""), (55, "a" * 99), (56, "a" * 100), (57, "a" * 5000),
             (58, "ab" * 600 + "x" + "ab" * 300), (59, (passage[10:95] + "Q") * 9), (60, passage * 4)]
    return rows


def test_small_texts(spark):
    rows = texts()
    assert run(spark, rows) == brute(rows)


def test_pieces_buckets_and_hot_cores(spark, monkeypatch):
    """Pieces, flushes, buckets and the way of very common cores, forced by
    tiny limits (set on the functions the tasks get)."""
    rows = texts()
    monkeypatch.setattr(suffix, "GROUP", 5)
    monkeypatch.setattr(suffix, "BUCKET", 40)
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 0)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("piece", [1, 130, 1000])
def test_long_text_in_pieces(monkeypatch, piece):
    """Strings of a text in pieces are the strings of the text."""
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 101, 3000).astype(np.uint8)
    got = set()
    for a in range(0, len(raw), piece):
        part = raw[a:a + piece + suffix.WIDTH - 1]
        place, first, last, _, _ = suffix.sample(part, np.array([len(part)]))
        for p, f, e in zip(place, first, last, strict=True):
            assert 0 <= p - e and p - f < suffix.PLACES
            got |= {(a + s, a + p) for s in range(f, e + 1)}
    place, first, last, _, _ = suffix.sample(raw, np.array([len(raw)]))
    assert got == {(s, p) for p, f, e in zip(place, first, last, strict=True) for s in range(f, e + 1)}
    assert len({s for s, _ in got}) == len(raw) - suffix.WIDTH + 1


def test_one_core_in_a_third_of_all_rows(spark, monkeypatch):
    """A phrase in many texts of unlike surroundings, some of which repeat."""
    monkeypatch.setattr(suffix, "GROUP", 40)
    monkeypatch.setattr(suffix, "SHARE", 2)
    rng = random.Random(11)
    phrase = "the very same sixty bytes of text that stand in so many texts"
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    rows = [(k, f"{words(20)} {phrase} {words(20)}" if k % 3 == 0 else words(30)) for k in range(450)]
    rows += [(1000 + k, "x" + rows[3 * k][1] + "y") for k in range(0, 40, 3)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_repeated_ids_and_empty(spark):
    t = "0123456789" * 10 + "xyz"
    rows = [(1, t), (1, t), (None, t), (1, t + "more"), (2, "q" * 50)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_sample_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_cut_keeps_characters(spark):
    t = "é☃" * 60
    df = spark.createDataFrame([(1, t, 120, "a"), (2, "x" + t[3:] + "end", 0, "b"), (3, None, None, None)], "doc_id long, text string, n_chars long, __rid string")
    got = {r.doc_id: r for r in suffix.cut(df).collect()}
    assert suffix.cut(df).columns == df.columns and got[3].text is None
    assert got[2].text.startswith("x") and got[2].text.endswith("end") and got[2].n_chars == len(got[2].text) < 20
