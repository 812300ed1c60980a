"""Near-duplicates by b-bit MinHash.

A text's set is its distinct shingles of words, as 64-bit hashes. From
``BANDS * ROWS`` minima come the band keys, and the low ``BITS`` bits of each
minimum are kept, packed into words. Texts that share a band key are
candidates; the equal groups of bits, corrected for accidental equality,
estimate their similarity, and pairs far below the threshold go. The rest is
confirmed on the full sets.

No group is expanded into all its pairs and no link between components is
lost:

1. texts with equal sets become one row (a partial aggregation);
2. every row of a bucket is compared to the bucket's smallest doc_id, the
   confirmed links give components;
3. buckets that still hold several components are looked at again: rows of
   different components are compared in blocks, a task for each pair of small
   chunks, which give back links only.

Sets travel only for rows in a shared bucket.

Defined results: texts without words (null, empty) have an empty set, link
with nothing and are kept; fewer words than a shingle make one shingle of the
whole; rows with a null doc_id link with nothing; rows with equal doc_ids have
the same component only through their sets; other columns are not read. Texts
of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, numbered, odd_ids, small, stored, text_or_empty
from .components import components

BANDS, ROWS, BITS = 20, 4, 4
HASHES = BANDS * ROWS
WORDS64 = HASHES * BITS // 64
CHUNK = 400  # rows of a cluster that are compared in one task with as many others
SIGMAS = 6  # the estimate may be this far below the threshold
_rng = np.random.Generator(np.random.PCG64(20240607))
_A = _rng.integers(1, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_LUT = np.arange(256, dtype=np.uint64) + np.uint64(1)  # byte values from 1, A-Z lower-cased
_LUT[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(way: str, n: int) -> np.ndarray:
    """Powers of the base (``up``) or of its inverse modulo 2**64 (``down``)."""
    if len(_powers[way]) < n:
        base = np.uint64(_BASE if way == "up" else pow(_BASE, -1, 2**64))
        full = np.full(max(n, 1 << 16), base, np.uint64)
        full[0] = 1
        _powers[way] = np.cumprod(full)
    return _powers[way][:n]


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word of a text given as UTF-8 bytes."""
    word = ~_SPACE[raw]
    edge = np.diff(word, prepend=False, append=False)
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LUT[raw] * _power("up", len(raw)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power("down", len(raw))[start] + (end - start).astype(np.uint64))


def shingles(raw: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size``-word shingles, ascending."""
    h = word_hashes(raw)
    n = min(size, len(h))
    if not n:
        return h
    s = np.full(len(h) - n + 1, n if n < size else 0, np.uint64)
    for k in range(n):
        s = mix(s + h[k:len(h) - n + 1 + k])
    return np.unique(s)


def minima(s: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 2**64 - 1, np.uint64)
    for a in range(0, len(s), 2048):
        np.minimum(low, (s[a:a + 2048, None] * _A + _B).min(0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for x in low.reshape(BANDS, ROWS).T:
        key = mix(key + x)
    return key.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    bits = ((low >> np.uint64(17)) & np.uint64(2**BITS - 1)).reshape(WORDS64, -1)
    return (bits << (np.arange(bits.shape[1], dtype=np.uint64) * np.uint64(BITS))).sum(1, dtype=np.uint64).view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def _raw(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text, without copies."""
    col = batch.column(1)
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1] if offsets else np.zeros(len(col) + 1, int)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[a:b]


def sign(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, set_id`` (digest of the set), ``sig`` and ``keys`` per row;
    the last three are null for an empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                n, ids, sigs, keys = [], [], [], []
                for raw in _raw(batch):
                    s = shingles(raw, size)
                    n.append(len(s))
                    if len(s):
                        low = minima(s)
                        ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                        sigs.append(packed(low))
                        keys.append(band_keys(low))
                    else:
                        ids.append(None), sigs.append(None), keys.append(None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, longs), pa.array(keys, longs)],
                                                 names=["doc_id", "n", "set_id", "sig", "keys"])

    return _texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, n long, set_id binary, sig array<long>, keys array<long>")


def sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, shingles`` (sorted array<long>) per row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 200):
                batch = whole.slice(a, 200)
                got = [shingles(raw, size).view(np.int64) for raw in _raw(batch)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return _texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, shingles array<long>")


def _estimate(a: str, b: str):
    """Similarity by equal groups of bits, less what is equal by accident."""
    ones = int("1" * (64 // BITS), 2**BITS)
    differ = F.lit(0)
    for k in range(WORDS64):
        x = F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))
        step = 1
        while step < BITS:
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step *= 2
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(ones).cast("long")))
    chance = 2.0**-BITS
    return ((HASHES - differ) / F.lit(float(HASHES)) - chance) / (1 - chance)


def _block_links(percent: int, floor: float):
    """Links between different labels in one pair of chunks. Likely pairs come
    first, and pairs whose labels a link has joined already are passed over."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["own"].to_numpy()
        left = np.flatnonzero(own == rows["i"].to_numpy())
        same = rows["i"].iloc[0] == rows["j"].iloc[0]
        right = left if same else np.flatnonzero(own == rows["j"].to_numpy())
        label, n, sets_ = rows["label"].to_numpy(), rows["n"].to_numpy(), rows["shingles"].to_numpy()
        sig = np.stack(rows["sig"].to_numpy()).view(np.uint64)
        ones = np.uint64(int("1" * (64 // BITS), 2**BITS))
        found: list[tuple[float, int, int]] = []
        for x in left:
            y = right[(label[right] != label[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            y = y[y > x] if same else y
            bits = sig[y] ^ sig[x]
            step = 1
            while step < BITS:
                bits |= bits >> np.uint64(step)
                step *= 2
            equal = 1 - np.bitwise_count(bits & ones).sum(1) / HASHES
            est = (equal - 2.0**-BITS) / (1 - 2.0**-BITS)
            found += [(e, int(x), int(k)) for e, k in zip(est.tolist(), y.tolist(), strict=True) if e >= floor]
        top: dict[int, int] = {}

        def find(v: int) -> int:
            while (u := top.get(v, v)) != v:
                top[v] = v = top.get(u, u)
            return v

        links = []
        for _, x, y in sorted(found, reverse=True):
            u, v = find(label[x]), find(label[y])
            if u != v:
                both = len(np.intersect1d(sets_[x], sets_[y], assume_unique=True))
                if 100 * both >= percent * (n[x] + n[y] - both):
                    top[max(u, v)] = min(u, v)
                    links.append((label[x], label[y]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return work


def _across(rows: DataFrame, full: DataFrame, percent: int, floor: float) -> DataFrame:
    """Confirmed links ``a, b`` between labels that still share a bucket.

    Labels connected by shared buckets form a cluster; its rows are dealt into
    chunks of about ``CHUNK`` and each pair of chunks is a task of its own, so
    a cluster of any size is many small tasks that give links and no pairs."""
    per = rows.select("band", "key", "label").distinct().groupBy("band", "key").agg(F.min("label").alias("low"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    shared = rows.join(per, ["band", "key"]).select("doc", "n", "sig", "label", "low").distinct()
    shared = stored(shared, "mh-shared")
    cluster = components(shared.select(F.col("low").alias("a"), F.col("label").alias("b"))).select(F.col("node").alias("label"), F.col("component").alias("cluster"))
    x = stored(shared.select("doc", "n", "sig", "label").distinct().join(cluster, "label"), "mh-clusters")
    sizes = x.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    x = x.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))
    x = x.join(full.select(F.col("doc_id").alias("doc"), "shingles"), "doc")
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    x = x.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    x = x.select("cluster", "i", "j", "own", "label", "n", "sig", "shingles")
    links = x.groupBy("cluster", "i", "j").applyInPandas(_block_links(percent, floor), "a long, b long")
    return stored(links, "mh-across")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``; links are pairs with
    100 * intersection >= percent * union of their sets."""
    if not odd_ids(docs, id_col):
        return _groups(docs, size, percent, id_col, text_col)
    # rows are numbered in the order of their ids, so the smallest number of a
    # component stands for its smallest id
    x = numbered(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "rid", "id")
    named = F.when(F.col("id").isNotNull(), F.col("rid"))
    found = _groups(x.select(named.alias("rid"), "text"), size, percent, "rid", "text")
    names = x.select(F.col("rid").alias("row"), "id")
    found = found.join(names.select("row", F.col("id").alias("own")), F.col("doc_id") == F.col("row"), "left").drop("row")
    found = found.join(names.select("row", F.col("id").alias("top")), F.col("component_id") == F.col("row"), "left")
    return found.select(F.col("own").alias("doc_id"), "n_shingles", F.col("top").alias("component_id"),
                        F.coalesce(F.col("own") == F.col("top"), F.lit(True)).alias("kept"))


def _groups(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """:func:`near_duplicates` of rows whose ids are unique where not null."""
    signed = stored(sign(docs, size, id_col, text_col), "mh-signed")
    reps = signed.filter("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    reps = stored(reps, "mh-reps")
    rows = reps.select("doc", "n", "sig", F.posexplode("keys").alias("band", "key"))
    tops = rows.groupBy("band", "key").agg(F.min(F.struct("doc", "n", "sig")).alias("c"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    rows = stored(rows.join(tops, ["band", "key"]), "mh-buckets")
    j, least = percent / 100, F.lit(percent)
    floor = j - SIGMAS * (j * (1 - j) / HASHES) ** 0.5
    near = lambda n1, n2, s1, s2: (100 * F.least(n1, n2) >= least * F.greatest(n1, n2)) & (_estimate(s1, s2) >= floor)
    star = rows.filter("doc <> c.doc").select("doc", "n", "sig", F.col("c.doc").alias("cdoc"), F.col("c.n").alias("cn"), F.col("c.sig").alias("csig"))
    star = star.filter(near("n", "cn", "sig", "csig")).select(F.col("cdoc").alias("a"), F.col("doc").alias("b")).distinct()
    star = stored(star, "mh-star")
    wanted = rows.select(F.col("doc").alias("doc_id")).distinct()
    one = docs.withColumn(id_col, F.col(id_col).cast("long"))
    if id_col != "doc_id":
        wanted = wanted.withColumnRenamed("doc_id", id_col)
    full = stored(sets(one.select(id_col, text_col).join(wanted, id_col, "left_semi"), size, id_col, text_col), "mh-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = pairs.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
        x = x.join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        x = x.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))
        return stored(x.filter(100 * F.col("both") >= least * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "mh-links")

    label = components(confirmed(star))
    rows = rows.select("doc", "n", "sig", "band", "key").join(label, F.col("doc") == F.col("node"), "left").withColumn(
        "label", F.coalesce("component", "doc")).drop("node", "component")
    rows = stored(rows, "mh-labelled")
    joined = components(_across(rows, full, percent, floor)).select(F.col("node").alias("l"), F.col("component").alias("top"))
    reps = reps.select("set_id", "doc").join(label, F.col("doc") == F.col("node"), "left").withColumn("l", F.coalesce("component", "doc")).drop("component")
    reps = reps.join(joined, "l", "left").select("set_id", F.coalesce("top", "l").alias("component"))
    out = signed.select("doc_id", "n", "set_id").join(reps, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, one of each group of
    near-duplicates: that with the smallest ``id_col``."""
    rid = fresh(docs, "__rid")
    x = numbered(docs, rid, id_col, text_col)
    found = _groups(x.select(F.col(rid), F.col(text_col)), size, percent, rid, text_col)
    gone = stored(found.filter("NOT kept").select(F.col("doc_id").alias(rid)), "mh-gone")
    return x.join(small(gone), rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
