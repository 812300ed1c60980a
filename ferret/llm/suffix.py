"""Exact removal of repeated byte strings by external induced sorting.

Every string of ``WIDTH`` bytes that also starts earlier (in document order,
then by place) is covered; the union of such strings is removed. Sorting all
suffixes is not needed for that, and sorting is done in three levels, each
carrying tuples through Spark's external sort, whose sorted runs spill to disk
(the disk-backed priority queue of this operator) so that a partition may be
far larger than a task's memory:

1. *Sample.* A string's sample suffix starts at its smallest ``CORE``-byte
   hash, leftmost among equals; equal strings have it at the same offset. All
   strings with one sample suffix form one tuple ``(core, whole, document,
   place and offsets)``, ``core`` naming the first bytes of the suffix and
   ``whole`` all bytes its strings cover. About one suffix in 39 is sampled.
2. *Names.* Tuples are sorted by name. Equal ``(core, whole)`` names agree in
   all their strings, so all but the first tuple are repeats as a whole. A core
   with one ``whole`` name is done. This settles nearly everything.
3. *Induction.* Tuples with equal cores and different ``whole`` names fetch
   their bytes. Their sample suffixes are sorted, with the common prefix of
   neighbours; then the suffixes one byte further left are induced, order by
   (byte, order before), common prefix one more where the bytes agree and else
   none, and so on leftwards. Neighbours with ``WIDTH`` common bytes are equal
   strings, of which the first in document order stays.

A task drops repeats among its own tuples before the shuffle, so a passage or
text with a third of all copies leaves one tuple per task and name. Cores
with more than ``GROUP`` different surroundings are not induced in one task:
their strings are grouped by a 128-bit hash with partial aggregation instead,
with the same result. Names are 64-bit hashes; a removal rests on equal (core,
whole) pairs, which for strings around one core are the 64 bits of ``whole``.

Defined results: null and empty texts have 0 bytes; texts shorter than
``WIDTH`` keep all; null doc_ids come first; rows with equal doc_ids are
documents of their own in the order of their texts; other columns are kept by
:func:`cut` and not read by :func:`spans`; texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, matched, numbered, small, stored, text_or_empty
from .minhash import _power, _raw, mix

WIDTH, CORE = 100, 24
PLACES = WIDTH - CORE + 1  # places of a core within a string
PIECE = 1 << 18
FLUSH = 400_000  # tuples that a task holds
GROUP = 20_000
SHARE = 16  # of the texts, one in so many tells cores of more than GROUP surroundings
BUCKET = 40_000  # tuples that are induced in one task
_INDEX = np.uint64((1 << 24) - 1)


def _sums(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("up", len(raw)), out=out[1:])
    return out


def sample(raw: np.ndarray, ends: np.ndarray):
    """Tuples of a run of texts that lie one after the other, text k ending at
    ``ends[k]``: place of the sample suffix, first and last string start, core
    name, whole name."""
    n = len(raw)
    if n < WIDTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums, down = _sums(raw), _power("down", n)
    core = mix((sums[CORE:] - sums[:-CORE]) * down[:n - CORE + 1])
    low = (core & ~_INDEX) | np.arange(len(core), dtype=np.uint64)
    have = 1
    while 2 * have <= PLACES:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:len(low) - (PLACES - have)], low[PLACES - have:])
    place = (low & _INDEX).astype(np.int64)
    fits = np.ones(len(place), bool)  # a string does not cross the end of its text
    for e in ends[ends < n]:
        fits[max(0, e - WIDTH + 1):e] = False
    at = np.flatnonzero(fits)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    place = place[at]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(at) != 1)]))
    first, last, place = at[new], at[np.concatenate([new[1:], [len(at)]]) - 1], place[new]
    whole = mix((sums[last + WIDTH] - sums[first]) * down[first])
    whole = mix(whole + ((place - first) * 128 + (place - last)).astype(np.uint64))
    return place, first, last, core[place], whole


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled tuples of (rid, text) rows; repeats within a flush come marked."""
    held, size = [], 0
    for batch in batches:
        rids = batch.column(0).to_numpy(zero_copy_only=False)
        run, total = [], 0
        for rid, raw in zip(rids, _raw(batch), strict=True):
            for a in range(0, max(1, len(raw)), PIECE):
                run.append((rid, a, raw[a:a + PIECE + WIDTH - 1]))
                total += len(run[-1][2])
                if total >= PIECE:
                    held.append(_sampled(run))
                    size += len(held[-1][0])
                    run, total = [], 0
            if size >= FLUSH:
                yield from _flush(held)
                held, size = [], 0
        if run:
            held.append(_sampled(run))
            size += len(held[-1][0])
    if held:
        yield from _flush(held)


def _sampled(run: list):
    ends = np.cumsum([len(r[2]) for r in run])
    place, first, last, core, whole = sample(np.concatenate([r[2] for r in run]), ends)
    k = np.searchsorted(ends, first, "right")
    begin = (ends - np.array([len(r[2]) for r in run]))[k]
    at = place - begin + np.array([r[1] for r in run], np.int64)[k]
    pack = at << 14 | (place - last) << 7 | (place - first)
    return np.array([r[0] for r in run], np.int64)[k], pack, core.view(np.int64), whole.view(np.int64)


def _flush(held: list) -> Iterator[pa.RecordBatch]:
    rid, pack, core, whole = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((pack, rid, whole, core))
    rid, pack, core, whole = rid[order], pack[order], core[order], whole[order]
    again = np.zeros(len(rid), bool)
    again[1:] = (core[1:] == core[:-1]) & (whole[1:] == whole[:-1])
    for a in range(0, len(rid), 50_000):
        cut = slice(a, a + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (again, core, whole, rid, pack)], names=["again", "core", "whole", "rid", "pack"])


def induce(group: np.ndarray, left: np.ndarray, right: np.ndarray, lo: np.ndarray, hi: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Repeated strings of tuples by leftward induction.

    ``left[k]`` holds the bytes before tuple k's sample suffix, nearest first,
    ``right[k]`` those from it on; its strings start ``lo[k]`` to ``hi[k]``
    bytes before it. ``order`` ranks tuples in document order. Returns flags
    ``[tuple, offset]`` of strings that a tuple before has too."""
    n = len(group)
    out = np.zeros((n, PLACES), bool)
    keys = np.concatenate([group.astype(">i8").view(np.uint8).reshape(n, 8), right], axis=1)
    now = np.argsort(np.ascontiguousarray(keys).view(f"V{keys.shape[1]}").ravel(), kind="stable")
    differ = right[now[1:]] != right[now[:-1]]
    common = np.zeros(n, np.int64)  # common prefix with the one before
    common[1:] = np.where(differ.any(1), differ.argmax(1), WIDTH)
    common[1:][group[now[1:]] != group[now[:-1]]] = 0
    for r in range(PLACES):
        if r:
            byte = left[now, r - 1].astype(np.int64)
            perm = np.argsort(group[now] * 256 + byte, kind="stable")
            joined = np.zeros(n, bool)
            joined[1:] = (byte[perm[1:]] == byte[perm[:-1]]) & (group[now[perm[1:]]] == group[now[perm[:-1]]])
            common = np.where(joined, np.minimum(_least_between(common, perm) + 1, WIDTH), 0)
            now = now[perm]
        own = np.cumsum(common < WIDTH) - 1
        has = (lo[now] <= r) & (r <= hi[now])
        best = np.full(own[-1] + 1, n, np.int64)
        np.minimum.at(best, own[has], order[now[has]])
        out[now[has], r] = order[now[has]] > best[own[has]]
    return out


def _least_between(values: np.ndarray, perm: np.ndarray) -> np.ndarray:
    """For each place k of ``perm`` the least of ``values`` over the places
    after ``perm[k - 1]`` up to ``perm[k]`` (for ascending neighbours)."""
    levels = [values]
    while 2 ** len(levels) <= len(values):
        v, step = levels[-1], 2 ** (len(levels) - 1)
        levels.append(np.minimum(v[:-step], v[step:]))
    out = np.zeros(len(values), np.int64)
    a, b = perm[:-1] + 1, perm[1:] + 1
    ok = np.flatnonzero(b > a)
    a, b = a[ok], b[ok]
    level = np.floor(np.log2(b - a)).astype(np.int64) if len(a) else a
    for k in range(len(levels)):
        at = level == k
        out[ok[at] + 1] = np.minimum(levels[k][a[at]], levels[k][b[at] - 2**k])
    return out


def _unpack(pack):
    return pack >> 14, pack >> 7 & 127, pack & 127  # place, least and most bytes before it


def _induced(rows: pd.DataFrame) -> pd.DataFrame:
    place, lo, hi = _unpack(rows["pack"].to_numpy())
    n, rid = len(rows), rows["rid"].to_numpy()
    left, right = np.zeros((n, PLACES), np.uint8), np.zeros((n, WIDTH), np.uint8)
    for k, (bytes_, h) in enumerate(zip(rows["bytes"], hi.tolist(), strict=True)):
        raw = np.frombuffer(bytes_, np.uint8)
        left[k, :h] = raw[:h][::-1]
        tail = raw[h:h + WIDTH]
        right[k, :len(tail)] = tail
    _, group = np.unique(rows["core"].to_numpy(), return_inverse=True)
    order = np.empty(n, np.int64)
    order[np.lexsort((place, rid))] = np.arange(n)
    found = induce(group, left, right, lo, hi, order)
    edge = np.diff(found, axis=1, prepend=False, append=False)
    who, at = np.nonzero(edge)
    who, first, last = who[::2], at[::2], at[1::2] - 1  # runs of offsets
    return pd.DataFrame({"rid": rid[who], "a": place[who] - last, "b": place[who] - first + WIDTH})


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that a tuple's strings cover."""
    for batch in batches:
        rid, core, pack, got = [], [], [], []
        for r, raw, tuples in zip(batch.column(0).to_pylist(), _raw(batch), batch.column(2).to_pylist(), strict=True):
            for t in tuples:
                place, lo, hi = _unpack(t["pack"])
                rid.append(r), core.append(t["core"]), pack.append(t["pack"])
                got.append(raw[place - hi:place - lo + WIDTH].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(core, pa.int64()), pa.array(rid, pa.int64()), pa.array(pack, pa.int64()), pa.array(got, pa.binary())],
                                         names=["core", "rid", "pack", "bytes"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a tuple under a 128-bit name."""
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            names, rid, at = [], [], []
            for r, pack, raw in zip(*(batch.column(c).slice(a, 2000).to_pylist() for c in ("rid", "pack", "bytes")), strict=True):
                place, lo, hi = _unpack(pack)
                for k in range(hi - lo + 1):
                    names.append(hashlib.blake2b(raw[k:k + WIDTH], digest_size=16).digest())
                    rid.append(r), at.append(place - hi + k)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(rid, pa.int64()), pa.array(at, pa.int64())], names=["name", "rid", "at"])


def spans(texts: DataFrame) -> DataFrame:
    """``rid, spans`` (maximal removed ``a`` to ``b``, ascending) of the rows
    ``rid, text`` that lose bytes."""
    kind = "again boolean, core long, whole long, rid long, pack long"
    t = texts.mapInArrow(_tuples, kind)
    # a core with very many surroundings is no one task: its names are dealt by
    # themselves, and it counts as mixed. Which cores those are a share of the
    # texts tells; one that it misses is slower, with the same result.
    some = texts.filter(F.pmod(F.xxhash64("rid"), F.lit(SHARE)) == 0).mapInArrow(_tuples, kind).filter("NOT again")
    wide = some.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP // SHARE).select("core")
    wide = stored(wide, "sa-wide")
    key, same, order = F.col("core"), F.lag("whole"), ["whole", "rid", "pack"]
    found, name = bool(wide.head(1)), F.col("whole")
    if found:
        t = t.join(small(wide.withColumn("wide", F.lit(True))), "core", "left")
        key, name, order = F.when(F.col("wide"), F.xxhash64("core", "whole")).otherwise(key), F.struct("core", "whole"), ["core", *order]
        same = F.lag(name)
    t = t.withColumn("key", F.when(F.col("again"), F.col("rid")).otherwise(key))
    by = Window.partitionBy("again", "key")
    first = by.orderBy(*order)
    over = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mixed = F.first("whole").over(over) != F.last("whole").over(over)
    t = t.select("again", "core", "rid", "pack", (same.over(first) == name).alias("same"),
                 (F.coalesce("wide", F.lit(False)) | mixed if found else mixed).alias("mixed"))
    repeat = F.col("again") | F.coalesce("same", F.lit(False))
    t = stored(t.select("core", "rid", "pack", repeat.alias("repeat"), "mixed").filter("repeat OR mixed"), "sa-names")
    place, lo, hi = F.shiftright("pack", 14), F.shiftright("pack", 7).bitwiseAND(127), F.col("pack").bitwiseAND(127)
    parts = t.filter("repeat").select("rid", (place - hi).alias("a"), (place - lo + WIDTH).alias("b"))
    open_ = t.filter("NOT repeat")
    mine = open_.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pack", "core"))).alias("tuples"))  # of one document
    mine = stored(mine, "sa-open")
    got = matched(texts, mine, ["rid"], "size(tuples)", "inner").select("rid", "text", "tuples").mapInArrow(_fetch, "core long, rid long, pack long, bytes binary")
    sizes = open_.groupBy("core").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(sizes.filter(F.col("n") > GROUP).select("core"), "sa-hot")
    total = open_.count()
    got = stored(got, "sa-bytes")
    some = bool(hot.head(1))
    calm = got.join(hot, "core", "left_anti") if some else got
    bucket = F.pmod(F.xxhash64("core"), F.lit(max(1, -(-total // BUCKET))))
    parts = parts.union(calm.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_induced, "rid long, a long, b long"))
    if some:
        w = stored(got.join(hot, "core", "left_semi").mapInArrow(_windows, "name binary, rid long, at long"), "sa-windows")
        least = w.groupBy("name").agg(F.min(F.struct("rid", "at")).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        w = w.join(least, "name").filter("rid <> m.rid OR at <> m.at")
        parts = parts.union(w.select("rid", F.col("at").alias("a"), (F.col("at") + WIDTH).alias("b")))
    # overlapping and touching parts become maximal spans
    before = Window.partitionBy("rid").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    x = parts.withColumn("new", F.coalesce((F.col("a") > F.max("b").over(before)).cast("int"), F.lit(1)))
    x = x.withColumn("no", F.sum("new").over(Window.partitionBy("rid").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0)))
    x = x.groupBy("rid", "no").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return stored(x.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")), "sa-spans")


def _joined(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` plus its row number and its spans (null: none)."""
    rid = fresh(docs, "__rid")
    x = numbered(docs, rid, id_col, text_col)
    found = spans(x.select(F.col(rid).alias("rid"), text_or_empty(text_col).alias("text")))
    cut_ = fresh(x, "__spans")
    return matched(x, found.withColumnRenamed("rid", rid).withColumnRenamed("spans", cut_), [rid], f"size({cut_})"), rid, cut_


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    x, _, cut_ = _joined(docs.select(id_col, text_col), id_col, text_col)
    x = x.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(cut_).alias("spans"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, many, sha = [], [], [], []
            for raw, cuts in zip(_raw(batch), batch.column(2).to_pylist(), strict=True):
                kept, at = hashlib.sha256(), 0
                for s in cuts or ():
                    kept.update(raw[at:s["a"]])
                    at = s["b"]
                kept.update(raw[at:])
                n.append(len(raw)), many.append(len(cuts or ())), gone.append(sum(s["b"] - s["a"] for s in cuts or ()))
                sha.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.int64()) for v in (n, gone, many)), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return x.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs``, columns unchanged, without the removed bytes. Spans shrink to
    whole characters, so texts stay valid; ``chars_col`` is counted anew."""
    x, rid, cut_ = _joined(docs, id_col, text_col)

    @F.pandas_udf("string")
    def keep(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([_without(t, c) for t, c in zip(texts, cuts, strict=True)], dtype=object)

    changed = F.when(F.col(cut_).isNotNull(), keep(F.col(text_col), F.to_json(F.col(cut_)))).otherwise(F.col(text_col))
    x = x.withColumn(text_col, changed)
    if chars_col in docs.columns:
        x = x.withColumn(chars_col, F.when(F.col(cut_).isNull(), F.col(chars_col)).otherwise(F.length(text_col)).cast(docs.schema[chars_col].dataType))
    return x.select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(text: str | None, cuts: str | None) -> str | None:
    if text is None or not cuts:
        return text
    raw, out, at = text.encode(), [], 0
    inner = lambda k: k < len(raw) and raw[k] & 0xC0 == 0x80
    for s in json.loads(cuts):
        a, b = s["a"], s["b"]
        while inner(a):
            a += 1
        while inner(b):
            b -= 1
        if a < b:
            out.append(raw[at:a])
            at = b
    return b"".join([*out, raw[at:]]).decode()
