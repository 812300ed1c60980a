"""Clauses of a block of queries evaluated document by document.

What documents match comes as rows ``doc_id, keys, v``: ``keys`` are numbers of
probes (a distinct term, phrase or multi-term clause of the block; a term that
many queries ask for is one probe) or, below zero, of slots of the dictionary
(:class:`dictionary.Matcher`); ``v`` is the document's part of the score. The rows
are exchanged once, by document; each task then has whole documents and works
out every query on them, some thousand documents at a time. Rows exchanged grow
with the distinct terms asked for, not with queries times terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scan_parallelism

CELLS = 2_000_000  # documents times leaves that are worked on at a time
ROWS = 100_000  # matched rows that are gathered before that


def numbered(*columns) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of distinct rows of the columns, and a row of each number."""
    seen: dict = {}
    at = np.array([seen.setdefault(row, len(seen)) for row in zip(*columns)], dtype=np.int64)
    first = np.full(len(seen), -1, dtype=np.int64)
    first[at[::-1]] = np.arange(len(at))[::-1]
    return at, first


def csr(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by owner: ``rows[start[o]:start[o + 1]]`` are those of owner ``o``."""
    return np.argsort(owner, kind="stable"), np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval its number and its members, as two columns."""
    n = np.maximum(end - start, 0)
    own = np.repeat(np.arange(len(n)), n)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def grouped(key: np.ndarray, size: int, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys (below ``size``), their counts and sums of weights."""
    if len(key) * 16 >= size:
        n = np.bincount(key, minlength=size)
        at = np.flatnonzero(n)
        return at, n[at], *(np.bincount(key, w, size)[at] for w in weights)
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][: len(k)])
    n = np.diff(np.r_[first, len(k)])
    return k[first], n, *(np.add.reduceat(w[order].astype(float), first) if len(first) else w[:0] for w in weights)


def micro(score: np.ndarray) -> np.ndarray:
    """Scores in millionths, rounded like SQL's ``round(score, 6)``."""
    x = score * 1e6
    out = np.floor(x + 0.5)
    for i in np.flatnonzero(np.abs(x - np.floor(x) - 0.5) < 1e-3):  # near a half: by its decimal digits
        out[i] = float(Decimal(repr(float(score[i]))).scaleb(6).quantize(Decimal(1), ROUND_HALF_UP))
    return out


class Slots:
    """Ranges ``probe``, from slot ``a`` to before slot ``b``."""

    def __init__(self, probe: np.ndarray, a: np.ndarray, b: np.ndarray, size: int):
        order = np.argsort(a, kind="stable")
        self.probe, self.a, self.b, self.size = probe[order], a[order], b[order], size
        self.until = np.searchsorted(self.a, np.arange(-1, size), side="right")  # ranges that begin at or before slot i - 1

    def hit(self, d: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and slots they hold as documents and ranges, each pair
        once: a range is hit at the first slot at or after its start, or never."""
        key = np.unique(d * self.size + slot)
        d, s = key // self.size, key % self.size
        before = np.where(np.r_[True, d[1:] != d[:-1]][: len(d)], -1, np.r_[-1, s[:-1]][: len(s)])
        own, r = spread(self.until[before + 1], self.until[s + 1])
        ok = self.b[r] > s[own]
        return d[own[ok]], self.probe[r[ok]]


class Clauses:
    """Clause leaves of a block of queries as columns, and what they give on
    some documents. ``leaves``: ``qid, ga, must, b, b_all, n_a, n_must, n_b, n_c,
    qnorm, weight, const, no`` and ``probe``, a row per leaf."""

    def __init__(self, leaves: dict[str, list], slots: Slots | None):
        col = {k: np.asarray(v) for k, v in leaves.items() if k not in ("qid", "ga", "b")}
        q, q_row = numbered(leaves["qid"])
        ga, ga_row = numbered(q.tolist(), leaves["ga"])
        gb, gb_row = numbered(ga.tolist(), leaves["b"])
        self.q_row, self.n_q, self.n_ga, self.n_gb = q_row, len(q_row), len(ga_row), len(gb_row)
        probes = int(col["probe"].max()) + 1 if len(q) else 0
        self.rows, self.start = csr(col["probe"].astype(np.int64), probes)
        self.leaf_gb, self.weight = gb, col["weight"].astype(float)
        self.gb_ga, self.ga_q = ga[gb_row], q[ga_row]
        at = lambda name, row, kind=float: col[name][row].astype(kind)
        self.const, self.no, self.boost, self.n_c = at("const", gb_row, bool), at("no", gb_row, bool), self.weight[gb_row], at("n_c", gb_row)
        self.n_b, self.b_all, self.must = at("n_b", ga_row), at("b_all", ga_row, bool), at("must", ga_row)
        self.n_a, self.n_must, self.qnorm = at("n_a", q_row), at("n_must", q_row), at("qnorm", q_row)
        self.slots, self.width = slots, len(gb)

    def pairs(self, d: np.ndarray, key: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matched rows as documents, leaves and values."""
        if self.slots is not None:
            low = key < 0
            sd, probe = self.slots.hit(d[low], -1 - key[low])
            d, key, v = np.r_[d[~low], sd], np.r_[key[~low], probe], np.r_[v[~low], np.zeros(len(sd))]
        own, i = spread(self.start[key], self.start[key + 1])
        return d[own], self.rows[i], v[own]

    def score(self, n: int, d: np.ndarray, leaf: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinated sums over the three clause levels of ``n`` documents:
        documents, queries and scores."""
        at, k, s = grouped(d * self.n_gb + self.leaf_gb[leaf], n * self.n_gb, v * self.weight[leaf])
        g, d = at % self.n_gb, at // self.n_gb
        # a constant clause stands alone in its b and counts once
        const = self.const[g]
        s, k, no = np.where(const, self.boost[g], s), np.where(const, 1, k), self.no[g]
        s = np.where(no, 0.0, s * k / self.n_c[g])
        at, k, s, bad = grouped(d * self.n_ga + self.gb_ga[g], n * self.n_ga, s, no)
        k = k - bad
        # a group with a prohibited match goes, as does one with nothing else
        g = at % self.n_ga
        ok = (bad == 0) & (k > 0) & (~self.b_all[g] | (k == self.n_b[g]))
        at, k, s, g = at[ok], k[ok], s[ok], g[ok]
        at, k, s, must = grouped(at // self.n_ga * self.n_q + self.ga_q[g], n * self.n_q, s * k / self.n_b[g], self.must[g])
        q, d = at % self.n_q, at // self.n_q
        ok = must == self.n_must[q]
        return d[ok], q[ok], (s * k / self.n_a[q] * self.qnorm[q])[ok]

    def any(self, n: int, d: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and the queries of which they match some leaf."""
        at = grouped(d * self.n_q + self.ga_q[self.gb_ga[self.leaf_gb[leaf]]], n * self.n_q)[0]
        return at // self.n_q, at % self.n_q


class _Best:
    """The best ``n`` documents of each query so far; documents come in order,
    so of equal scores the earlier one stays."""

    def __init__(self, n: int, n_q: int):
        self.n, self.least, self.kept = n, np.full(n_q, -np.inf), None

    def add(self, q: np.ndarray, docs: pa.Array, score: np.ndarray) -> None:
        m = micro(score)
        new = np.flatnonzero(m > self.least[q])
        if not len(new):
            return
        q, docs, score, m = q[new], docs.take(pa.array(new)), score[new], m[new]
        if self.kept:
            q, docs, score, m = np.r_[self.kept[0], q], pa.concat_arrays([self.kept[1], docs]), np.r_[self.kept[2], score], np.r_[self.kept[3], m]
        order = np.lexsort((-m, q))
        so = q[order]
        first = np.flatnonzero(np.r_[True, so[1:] != so[:-1]])
        place = np.arange(len(so)) - np.repeat(first, np.diff(np.r_[first, len(so)]))
        full = place == self.n - 1
        self.least[so[full]] = m[order][full]
        keep = order[place < self.n]
        self.kept = q[keep], docs.take(pa.array(keep)), score[keep], m[keep]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches in document order as tables of whole documents."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < ROWS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        code = t["doc_id"].combine_chunks().dictionary_encode().indices.to_numpy()
        cut = int(np.searchsorted(code, code[-1])) if len(code) else 0
        if cut:
            yield t.slice(0, cut)
        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Matched rows as documents, document numbers, keys and values."""
    step = max(1, CELLS // max(1, width))
    for t in _chunks(batches):
        code = t["doc_id"].combine_chunks().dictionary_encode()
        docs, keys = code.dictionary, t["keys"].combine_chunks()
        n = keys.value_lengths().to_numpy(zero_copy_only=False)
        d = np.repeat(code.indices.to_numpy().astype(np.int64), n)
        v = np.repeat(t["v"].combine_chunks().to_numpy(zero_copy_only=False), n)
        key = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        for lo in range(0, len(docs), step):
            i, k = np.searchsorted(d, [lo, lo + step])
            yield docs.slice(lo, step), d[i:k] - lo, key[i:k], v[i:k]


def _by_document(matches: DataFrame) -> DataFrame:
    return matches.repartition(scan_parallelism(matches), "doc_id").sortWithinPartitions("doc_id").select("doc_id", "keys", "v")


def scored(matches: DataFrame, clauses: Clauses, qids: pa.Array, qid_type: str, limit: int = 0) -> DataFrame:
    """``qid, doc_id, score`` of every matching document, or of as many per task
    and query as may be among the ``limit`` best (by the score's six digits, then
    ``doc_id``)."""
    kind = matches.schema["doc_id"].dataType.simpleString()

    def run(batches):
        best = _Best(limit, clauses.n_q)
        out = lambda q, docs, s: pa.RecordBatch.from_arrays([qids.take(pa.array(q)), docs, pa.array(s)], ["qid", "doc_id", "score"])
        for docs, d, key, v in _slices(batches, clauses.width):
            d, q, s = clauses.score(len(docs), *clauses.pairs(d, key, v))
            if limit:
                best.add(q, docs.take(pa.array(d)), s)
            elif len(q):
                yield out(q, docs.take(pa.array(d)), s)
        if best.kept:
            yield out(*best.kept[:3])

    return _by_document(matches).mapInArrow(run, f"qid {qid_type}, doc_id {kind}, score double")


def counted(matches: DataFrame, clauses: Clauses) -> DataFrame:
    """``q, n_docs``: documents that match some clause of query number ``q``."""
    def run(batches):
        n = np.zeros(clauses.n_q, dtype=np.int64)
        for docs, d, key, v in _slices(batches, clauses.width):
            n += np.bincount(clauses.any(len(docs), *clauses.pairs(d, key, v)[:2])[1], minlength=clauses.n_q)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(clauses.n_q)), pa.array(n)], ["q", "n_docs"])

    return _by_document(matches).mapInArrow(run, "q long, n_docs long").groupBy("q").agg(F.sum("n_docs").alias("n_docs"))

