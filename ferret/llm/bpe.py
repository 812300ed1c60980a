"""Byte-level BPE encoding and decoding by two-tier lookup.

A text is cut by the tokenizer's pattern. Tier one is a minimal perfect hash
over the vocabulary: as many slots as tokens, one displacement per bucket, and
the stored token decides, so a pre-token that is a token resolves in one
probe. Tier two merges the rest: bytes are a linked list, candidate pairs wait
in a heap by rank, and stale entries are skipped when they come out.

Encoding is a map over rows: no shuffle, so skewed keys do not matter, and a
lost executor only repeats its splits. The vocabulary file is a parameter; its
tables (a few MB, bounded by the vocabulary) go to the tasks with the closure's
broadcast. Defined results: null and empty texts have no ids and decode to no
bytes; repeated rows are encoded each; other columns are kept and never clash
(ids and bytes go under the names given, which must be new).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import PiecePool, chunks

ROWS_AT_ONCE = 500  # of results that a task holds
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in rows}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [tokens[k] for k in range(len(tokens))]


class PerfectHash:
    """Hash and displace: key -> slot in 0..n-1, no two keys of the set alike.
    Buckets are placed largest first; a bucket of one key stores its slot."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 3)
        self.displace = np.zeros(self.buckets, np.int64)
        self.key_at = np.zeros(n, np.int64)
        hashes = self.digest(keys)
        if len(np.unique(hashes)) != n:
            raise ValueError("two tokens have the same digest")
        bucket = hashes % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if n else []
        taken = np.zeros(n, bool)
        groups.sort(key=lambda g: -len(g))
        single = [int(g[0]) for g in groups if len(g) == 1]
        for g in groups:
            if len(g) == 1:
                continue
            d, step = 0, 16
            while True:  # a run of displacements at a time
                tried = self._slot(hashes[g], np.arange(d, d + step, dtype=np.uint64)[:, None])
                apart = np.diff(np.sort(tried, 1), axis=1).all(1)
                fits = np.flatnonzero(apart & ~taken[tried].any(1))
                if len(fits):
                    d, slots = d + int(fits[0]), tried[fits[0]]
                    break
                d, step = d + step, min(4096, step * 4)
            taken[slots] = True
            self.key_at[slots] = g
            self.displace[int(bucket[g[0]])] = d
        for k, slot in zip(single, np.flatnonzero(~taken).tolist(), strict=True):
            self.key_at[slot] = k
            self.displace[int(bucket[k])] = -1 - slot

    @staticmethod
    def digest(keys: list[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))

    def _slot(self, hashes: np.ndarray, d) -> np.ndarray:
        x = (hashes >> np.uint64(17)) ^ (d * _MIX + d)
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The only key of the set that each given key can equal, by number."""
        if not self.n or not keys:
            return np.full(len(keys), -1, np.int64)
        hashes = self.digest(keys)
        d = self.displace[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        with np.errstate(over="ignore"):
            slot = np.where(d < 0, -1 - d, self._slot(hashes, np.maximum(d, 0).astype(np.uint64)))
        return self.key_at[slot]


class ByteBPE:
    """Encoder and decoder over a rank list."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        with np.errstate(over="ignore"):
            self.whole = PerfectHash(tokens)
        self.ranks = {t: k for k, t in enumerate(tokens)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for each byte")
        self.ready()

    def ready(self) -> None:
        self.cut = regex.compile(self.pattern).findall
        self.pool = PiecePool(self.resolve)

    def __getstate__(self):
        return {"tokens": self.tokens, "pattern": self.pattern, "whole": self.whole}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.ranks = {t: k for k, t in enumerate(self.tokens)}
        self.ready()

    def resolve(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        out = []
        for piece, k in zip(raw, self.whole.find(raw).tolist(), strict=True):
            out.append([k] if self.tokens[k] == piece else self.merge(piece))
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals."""
        n, rank = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # a node's end is the next node's start
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not i < j < n or end[j] != stop:
                continue  # one of the two nodes has grown or gone since
            end[i], end[j] = stop, -1
            if stop < n:
                prev[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for run in chunks(texts):
            out += self.pool.encode([self.cut(t) for t in run])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def load(spark: SparkSession, path: str, pattern: str):
    """The tables of a vocabulary, broadcast (bounded by the vocabulary)."""
    return spark.sparkContext.broadcast(ByteBPE(read_ranks(path), pattern))


def _with_binary(df: DataFrame, source: str, out: str, work) -> DataFrame:
    """``df`` plus binary column ``out``, made from ``source`` batch by batch."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {out}")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType(), True)])
    place = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                col = pa.array(work(batch.column(place)), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, col], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, tables, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus binary ``out``: the ids as little-endian unsigned 32-bit integers."""

    def work(col: pa.Array) -> list[bytes]:
        return [x.astype("<u4").tobytes() for x in tables.value.encode(pc.fill_null(col, "").to_pylist())]

    return _with_binary(docs.withColumn(text_col, F.col(text_col).cast("string")), text_col, out, work)


def decode(encoded: DataFrame, tables, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """``encoded`` plus binary ``out``: the bytes that the ids stand for."""

    def work(col: pa.Array) -> list[bytes]:
        return [tables.value.decode(np.frombuffer(x or b"", "<u4")) for x in col.to_pylist()]

    return _with_binary(encoded, ids_col, out, work)


def digests(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``n_tokens, ids_sha256, decoded_sha256``."""
    tables = load(docs.sparkSession, path, pattern)
    x = encode(docs, tables, text_col, "__ids").drop(text_col)
    x = decode(x, tables, "__ids", "__bytes")
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_tokens", "ids_sha256", "decoded_sha256")]
    return x.select(*keep, (F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("__ids", 256).alias("ids_sha256"), F.sha2("__bytes", 256).alias("decoded_sha256"))
