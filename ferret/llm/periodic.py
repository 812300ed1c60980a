"""Periodic runs of words: stretches that repeat the same few words over.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) of at least ``LEAST`` words and ``TIMES`` periods that no
neighbouring word extends. Every run of a text is found, whatever its period:

At the dyadic scale B, for periods from B to 2B - 1, a text is cut into blocks
of B words. A run of such a period holds an aligned block within its first B
words, and the block occurs again one period later. The sums of squared
differences of the block's word numbers against the following window, an exact
integer number-theoretic transform of size 2B for all distances at once, are
zero exactly there (the sums are taken modulo a prime; a false zero does not
survive the next step). Zero distances are seeds, extended word by word in
both directions; a seed whose stretch is a run of a smaller period is that run.

Two kinds of blocks can hold no new seed and are not transformed: those with a
word that does not occur again within 2B - 1 words, and those that lie with
their window inside a run of a smaller period (all their distances are
multiples of it).

It is a map over rows: nothing is shuffled, tasks hold ``CHUNK_CHARS`` characters
of texts (a longer text stands alone) and transform ``SLAB`` numbers at a time.

Defined results: words are runs of bytes that are no ASCII white space; null
and empty texts have no words, no runs and an empty text left; overlapping
runs each count, and a word goes if any run repeats it; repeated rows are
judged each; columns that are not asked for are not read; an empty table stays
empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import chunks

LEAST, TIMES = 6, 4
PRIME, ROOT, TWOS = 15 * 2 ** 27 + 1, 31, 27  # transforms of up to 2 ** 27 numbers
SLAB = 1 << 21
NEAR = 64  # words of a seed's stretch that are compared for all seeds at once


@lru_cache(maxsize=64)
def _turns(size: int, back: bool) -> np.ndarray:
    """Powers of the root of unity of order ``size`` (its inverse): half a turn."""
    w = pow(ROOT, (PRIME - 1) // size, PRIME)
    w = pow(w, PRIME - 2, PRIME) if back else w
    out = np.ones(1, np.int64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * pow(w, len(out), PRIME) % PRIME])
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    rows, size = x.shape
    h = size // 2
    while h:
        x = x.reshape(rows, -1, 2, h)
        a, b = x[:, :, 0], x[:, :, 1]
        x = np.stack([(a + b) % PRIME, (a - b) % PRIME * _turns(2 * h, False) % PRIME], 2)
        h //= 2
    return x.reshape(rows, size)


def back(x: np.ndarray) -> np.ndarray:
    """Inverse of :func:`transform`."""
    rows, size = x.shape
    h = 1
    while h < size:
        x = x.reshape(rows, -1, 2, h)
        a, b = x[:, :, 0], x[:, :, 1] * _turns(2 * h, True) % PRIME
        x = np.stack([(a + b) % PRIME, (a - b) % PRIME], 2)
        h *= 2
    return x.reshape(rows, size) * pow(size, PRIME - 2, PRIME) % PRIME


def mismatches(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Per row, for t from 0 to B - 1, the sum of squared differences of the
    ``B`` numbers of ``block`` and those of ``window`` (2B - 1) from t on, modulo
    the prime."""
    rows, b = block.shape
    flipped = np.zeros((rows, 2 * b), np.int64)
    flipped[:, 0] = block[:, 0]
    flipped[:, b + 1:] = block[:, :0:-1]
    padded = np.zeros((rows, 2 * b), np.int64)
    padded[:, :2 * b - 1] = window
    cross = back(transform(flipped) * transform(padded) % PRIME)[:, :b]
    squares = np.zeros((rows, 2 * b), np.int64)
    np.cumsum(window * window % PRIME, 1, out=squares[:, 1:])
    own = (block * block % PRIME).sum(1)
    return (own[:, None] + squares[:, b:] - squares[:, :b] - 2 * cross) % PRIME


def _gaps(w: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words until the same word comes again in its text (else very many)."""
    order = np.lexsort((w, doc))
    again = (w[order[1:]] == w[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    out = np.full(len(w), np.iinfo(np.int64).max)
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def _to_right(w: np.ndarray, i: int, d: int, end: int) -> int:
    step = NEAR
    while i + d < end:
        m = min(step, end - d - i)
        off = w[i:i + m] != w[i + d:i + d + m]
        k = int(off.argmax())
        if off[k]:
            return i + k
        i, step = i + m, 2 * step
    return i


def _to_left(w: np.ndarray, i: int, d: int, start: int) -> int:
    step = NEAR
    while i > start:
        m = min(step, i - start)
        off = (w[i - m:i] != w[i - m + d:i + d])[::-1]
        k = int(off.argmax())
        if off[k]:
            return i - k
        i, step = i - m, 2 * step
    return i


def _seeds(w: np.ndarray, at: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (starts) and distances of zero mismatch."""
    starts, far = [], []
    step = max(1, SLAB // (2 * b))
    for a in range(0, len(at), step):
        s = at[a:a + step]
        zero = mismatches(w[s[:, None] + np.arange(b)], w[s[:, None] + b + np.arange(2 * b - 1)]) == 0
        row, t = np.nonzero(zero)
        starts.append(s[row])
        far.append(b + t)
    return np.concatenate(starts), np.concatenate(far)


def find(w: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs ``start, end, period`` (places in ``w``) of the texts of ``sizes``
    words that stand in ``w`` as word numbers, by start, then period."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    gaps = _gaps(w, np.repeat(np.arange(len(sizes)), sizes))
    found: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    b = 1
    while len(w) and TIMES * b <= sizes.max():
        long = np.flatnonzero(sizes >= TIMES * b)
        many = -(-sizes[long] // b)
        first = np.cumsum(many) - many
        at = np.repeat(begins[long] - first * b, many) + np.arange(int(many.sum())) * b
        end = np.repeat(ends[long], many)
        # a run from its first aligned block on is (TIMES - 1) * b words at least
        fits = at + (TIMES - 1) * b <= end
        nearest = np.maximum.reduceat(gaps, at) if b > 1 else gaps[at]
        fits &= nearest < 2 * b
        if found:
            held = np.array(sorted(found))
            reach = np.maximum.accumulate(held[:, 1])
            k = np.searchsorted(held[:, 0], at, "right") - 1
            fits &= ~((k >= 0) & (reach[np.maximum(k, 0)] >= at + 3 * b))
        at, end = at[fits], end[fits]
        if len(at):
            s, d = _seeds(w, at, b)
            end = end[np.searchsorted(at, s)]
            s, d, end = _likely(w, s, d, end, b)
            order = np.lexsort((s, d))
            s, d, end = s[order], d[order], end[order]
            k = 0
            while k < len(s):
                start, far, last = int(s[k]), int(d[k]), int(end[k])
                begin = int(begins[np.searchsorted(ends, start, "right")])
                lo, hi = _to_left(w, start, far, begin), _to_right(w, start, far, last)
                if hi + far - lo >= max(LEAST, TIMES * far) and (lo, hi + far) not in known:
                    known.add((lo, hi + far))
                    found.append((lo, hi + far, far))
                # the next seed of this distance beyond the stretch, or of the next distance
                same = int(np.searchsorted(d, far, "right"))
                k += max(1, int(np.searchsorted(s[k:same], hi)))
        b *= 2
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _likely(w, s, d, end, b):
    """Seeds whose first ``NEAR`` words of the stretch that a run has from its
    first aligned block on are equal."""
    fits = s + TIMES * d - b <= end
    s, d, end = s[fits], d[fits], end[fits]
    for a in range(0, NEAR, 8):
        i = a + np.arange(8)
        i = np.minimum(i, ((TIMES - 1) * d - b - 1)[:, None])
        fits = (w[s[:, None] + i] == w[(s + d)[:, None] + i]).all(1)
        s, d, end = s[fits], d[fits], end[fits]
    return s, d, end


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _judge(texts: list[str | None]) -> tuple[pa.Array, list[str]]:
    """Runs of each text and what is left of it."""
    words = [(t or "").encode().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    numbers = pa.array([x for t in words for x in t], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = find(numbers, sizes)
    begins = np.cumsum(sizes) - sizes
    # the text of a run; texts without words begin where the next one does
    of = np.searchsorted(np.cumsum(sizes), runs[:, 0], "right")
    many = np.bincount(of, minlength=len(words))
    kept = [b" ".join(t) for t in words]
    for k in np.flatnonzero(many).tolist():
        drop = np.zeros(len(words[k]) + 1, np.int64)
        for lo, hi, period in (runs[of == k] - [begins[k], begins[k], 0]).tolist():
            drop[lo + period] += 1
            drop[hi] -= 1
        gone = np.cumsum(drop)[:-1] > 0
        kept[k] = b" ".join(x for x, g in zip(words[k], gone.tolist(), strict=True) if not g)
    rows = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                      fields=list(RUNS.value_type))
    offsets = np.concatenate([[0], np.cumsum(many)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows, type=RUNS), [x.decode() for x in kept]


def periodic_runs(docs: DataFrame, id_cols: list[str], text_col: str = "text", out: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """``id_cols`` plus ``runs``, an array of ``start, length, period`` in words
    by start, then period, and ``collapsed``, the words that no run repeats (of a
    run its first period stays), joined by one space."""
    x = docs.select(*id_cols, F.col(text_col).cast("string").alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in chunks([t or "" for t in batch.column(len(id_cols)).to_pylist()]):
                runs, kept = _judge(texts)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], runs, pa.array(kept, pa.string())], names=[*id_cols, *out])

    fields = [f"`{c}` {t}" for c, t in x.dtypes[:-1]]
    return x.mapInArrow(work, ", ".join([*fields, f"`{out[0]}` array<struct<start:long,length:long,period:long>>", f"`{out[1]}` string"]))
