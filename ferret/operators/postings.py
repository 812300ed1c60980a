"""Words of documents grouped into postings, in the documents' own tasks.

Documents come with their words as arrays, rows of one document side by side.
Some whole documents at a time are grouped by numpy on word numbers: no row per
word, no exchange, and what a task holds does not grow with its documents.

A chain that stems or filters is worked out on rows, so a word is given to it
once per group of documents, not as often as it stands there (:func:`words`),
and the terms are grouped again (:func:`of_terms`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

WORDS_AT_ONCE = 1_000_000  # words of documents that are grouped at a time
ROW = ["field", "term", "doc_id", "tf", "flen", "positions"]


def _numbers(x) -> np.ndarray:
    return x.to_numpy(zero_copy_only=False).astype(np.int64)


def _sizes(arrays: pa.Array) -> np.ndarray:
    return _numbers(pc.fill_null(arrays.value_lengths(), 0))


def _one(x: pa.ChunkedArray) -> pa.Array:
    x = x.combine_chunks()
    return x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches as tables of whole documents."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        doc, cut = t["doc_id"], t.num_rows - 1
        while cut > 0 and doc[cut - 1].as_py() == doc[cut].as_py():
            cut -= 1
        if cut > 0:
            yield t.slice(0, cut)
        held = t.slice(max(cut, 0))
    if held is not None and held.num_rows:
        yield held


def _documents(batches: Iterable[pa.RecordBatch], fields: Sequence[str]) -> Iterator[tuple[pa.Array, np.ndarray, pa.Table]]:
    """Some whole documents at a time: their ids, the number of each row's, the rows."""
    for t in _whole(batches):
        code = _one(t["doc_id"]).dictionary_encode(null_encoding="encode")
        d = _numbers(code.indices)
        upto = np.cumsum(sum(_sizes(_one(t[f])) for f in fields))
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        group = upto[np.r_[first[1:], len(d)] - 1] // WORDS_AT_ONCE
        cuts = np.r_[first[np.flatnonzero(np.r_[True, group[1:] != group[:-1]])], len(d)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield code.dictionary.slice(d[lo], d[hi - 1] - d[lo] + 1), d[lo:hi] - d[lo], t.slice(lo, hi - lo)


def _lists(values: pa.Array, first: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[first, n].astype(np.int32)), values)


def _rows(field: str, docs: pa.Array, terms: pa.Array, d: np.ndarray, term: np.ndarray, pos: np.ndarray, in_order: bool) -> pa.RecordBatch:
    """Postings of words: their documents, terms (numbers) and positions."""
    flen = np.bincount(d, minlength=len(docs))
    by_name = pc.sort_indices(terms.cast(pa.string()).cast(pa.binary()))
    place = np.empty(len(terms), dtype=np.int64)
    place[by_name.to_numpy()] = np.arange(len(terms))
    key = place[term] * len(docs) + d  # in the order of the terms: the sort that follows finds it half done
    order = np.argsort(key, kind="stable") if in_order else np.lexsort((pos, key))
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    d, term = d[order][first], term[order][first]
    return pa.RecordBatch.from_arrays(
        [pa.array([field]).take(pa.array(np.zeros(len(first), dtype=np.int64))), terms.take(pa.array(term)).cast(pa.string()), docs.take(pa.array(d)),
         pa.array(np.diff(np.r_[first, len(key)]).astype(np.int32)), pa.array(flen[d].astype(np.int32)),
         _lists(pa.array(pos[order].astype(np.int32)), first, len(key))], ROW)


def _spread(t: pa.Table, field: str, d: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Documents, words and positions of the rows' arrays."""
    arrays = _one(t[field])
    n = _sizes(arrays)
    return np.repeat(d, n), arrays.flatten(), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def of_arrays(docs: DataFrame, stops: Mapping[str, Sequence[str]]) -> DataFrame:
    """Postings of the arrays of terms in the columns ``stops``, less the stop
    words named there (which keep their positions)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for ids, row_d, t in _documents(batches, list(stops)):
            for f, stop in stops.items():
                d, words, pos = _spread(t, f, row_d)
                if not len(words):
                    continue
                code = words.dictionary_encode()
                term = _numbers(pc.fill_null(code.indices, -1))
                gone = np.r_[pc.is_in(code.dictionary, pa.array(stop, code.dictionary.type)).to_numpy(zero_copy_only=False), True]
                at = np.flatnonzero(~gone[term])
                if len(at):
                    yield _rows(f, ids, code.dictionary, d[at], term[at], pos[at], len(ids) == len(row_d))

    return docs.mapInArrow(run, f"field string, term string, doc_id {kind}, tf int, flen int, positions array<int>")


def words(docs: DataFrame, field: str) -> DataFrame:
    """``part, tok, docs, pos``: the different words of some documents (a part
    of the task) with where they stand."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, (ids, row_d, t) in enumerate(_documents(batches, [field])):
            d, tok, pos = _spread(t, field, row_d)
            if not len(tok):
                continue
            code = tok.dictionary_encode()
            word = _numbers(pc.fill_null(code.indices, -1))
            order = np.argsort(word, kind="stable")
            order = order[np.searchsorted(word[order], 0):]
            n = np.bincount(word[order], minlength=len(code.dictionary))
            first = np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, dtype=np.int32)), code.dictionary.cast(pa.string()), _lists(ids.take(pa.array(d[order])), first, len(order)),
                 _lists(pa.array(pos[order].astype(np.int32)), first, len(order))], ["part", "tok", "docs", "pos"])

    return docs.mapInArrow(run, f"part int, tok string, docs array<{kind}>, pos array<int>")


def of_terms(terms: DataFrame, field: str) -> DataFrame:
    """Postings of ``part, term, docs, pos``, as :func:`words` gives them."""
    kind = terms.schema["docs"].dataType.elementType.simpleString()

    def parts(batches):
        held = []
        for b in batches:
            at = _numbers(b.column("part"))
            cuts = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)]), len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and held[-1].column("part")[0].as_py() != at[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(lo, hi - lo))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        for t in parts(batches):
            docs = _one(t["docs"])
            n = _sizes(docs)
            code, ids = _one(t["term"]).dictionary_encode(), docs.flatten().dictionary_encode(null_encoding="encode")
            yield _rows(field, ids.dictionary, code.dictionary, _numbers(ids.indices), np.repeat(_numbers(code.indices), n), _numbers(_one(t["pos"]).flatten()), False)

    return terms.select("part", "term", "docs", "pos").mapInArrow(run, f"field string, term string, doc_id {kind}, tf int, flen int, positions array<int>")
