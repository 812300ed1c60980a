"""URL filter over a sorted digest array.

Rules are ``(rule, verdict)`` pairs, a rule being host + path prefix. The
index is one binary file: the 64-bit xxhash of every rule in ascending order,
its string and its verdict. Tasks memory-map the file, probe all candidate
keys of a batch with one vectorised binary search, and compare the stored
string, so a digest collision cannot decide. The longest fitting rule wins.

The file goes to every executor, so its size is checked first
(``MAX_INDEX_BYTES``); a larger rule table is matched by an equi-join on the
key instead (:func:`judge_by_join`), with the same result.

Defined results: a null URL or one without ``://`` has empty host and path and
no rule; an empty rule table allows everything; rules given twice count once
(``block`` wins over ``allow`` for the same rule); repeated rows are judged
each; other columns of the pages are not carried, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

MAGIC = b"URLDIG01"
MAX_INDEX_BYTES = 256 << 20
VERDICTS = ("allow", "block")
DEFAULT_VERDICT = "allow"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def split_rule(rule: str) -> tuple[str, str]:
    slash = rule.find("/")
    return (rule, "") if slash < 0 else (rule[:slash], rule[slash:])


def pack(rules: list[tuple[str, str]]) -> bytes:
    """The index file: magic, counts, digests, offsets, shapes, verdicts, strings."""
    by: dict[str, str] = {}
    for rule, verdict in rules:
        if rule and verdict in VERDICTS:
            by[rule] = max(by.get(rule, verdict), verdict)
    rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), VERDICTS.index(v)) for r, v in by.items())
    shapes = sorted({tuple(map(len, split_rule(r))) for r in by})
    offsets = np.cumsum([0, *(len(r[1]) for r in rows)], dtype=np.int64)
    return b"".join([
        MAGIC, np.array([len(rows), len(shapes)], np.int64).tobytes(), np.array([r[0] for r in rows], np.uint64).tobytes(),
        offsets.tobytes(), np.array(shapes, np.int64).reshape(-1, 2).tobytes(), np.array([r[2] for r in rows], np.uint8).tobytes(),
        *(r[1] for r in rows)])


class DigestArray:
    """A memory-mapped index file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no digest array")
        n, shapes = np.frombuffer(raw[8:24], np.int64)
        at = 24
        self.digests = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.offsets = raw[at:at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        self.shapes = [tuple(map(int, x)) for x in raw[at:at + 16 * shapes].view(np.int64).reshape(-1, 2)]
        at += 16 * shapes
        self.verdicts = raw[at:at + n]
        self.strings = raw[at + n:]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Place of each key, -1 where it is no rule."""
        digests = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digests, "left")
        end = np.searchsorted(self.digests, digests, "right")
        out = np.full(len(keys), -1, np.int64)
        for k in np.flatnonzero(at < end):
            for p in range(at[k], end[k]):
                if self.strings[self.offsets[p]:self.offsets[p + 1]].tobytes() == keys[k]:
                    out[k] = p
        return out


def candidates(host: str, path: str, shapes: list[tuple[int, int]]) -> list[str]:
    """The keys a URL can match: host suffixes at label borders with path
    prefixes, only in the lengths that some rule has."""
    out = []
    for h, p in shapes:
        if 0 < h <= len(host) and p <= len(path) and (h == len(host) or host[-h - 1] == "."):
            out.append(host[len(host) - h:] + path[:p])
    return out


OUT = "page_id long, host string, path string, rule string, verdict string"


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    spark, blob = pages.sparkSession, pack(rules)
    if len(blob) > MAX_INDEX_BYTES:
        return judge_by_join(pages, spark.createDataFrame(rules, "rule string, verdict string"), id_col, url_col)
    name = ship(spark, blob)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(SparkFiles.get(name))
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            keys, row = [], []
            for k, (host, path) in enumerate(parts):
                got = candidates(host, path, index.shapes)
                keys += got
                row += [k] * len(got)
            found = index.find([x.encode() for x in keys])
            best: list[tuple[str, int] | None] = [None] * len(parts)
            for c in np.flatnonzero(found >= 0):
                if best[row[c]] is None or len(keys[c]) > len(best[row[c]][0]):
                    best[row[c]] = (keys[c], int(index.verdicts[found[c]]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x[0] for x in parts], pa.string()), pa.array([x[1] for x in parts], pa.string()),
                pa.array([b and b[0] for b in best], pa.string()),
                pa.array([VERDICTS[b[1]] if b else DEFAULT_VERDICT for b in best], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).mapInArrow(probe, OUT)


def ship(spark: SparkSession, blob: bytes) -> str:
    """Write the index to the shared folder and have every executor fetch it
    once; returns its file name."""
    name = f"urls-{hashlib.sha1(blob).hexdigest()[:20]}.idx"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{name}")
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(blob))
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def judge_by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same result from a rule table of any size: candidate keys by
    DataFrame functions, joined on the key; the longest match per URL row."""
    rules = (rules.filter("rule <> '' AND verdict IN ('allow', 'block')").groupBy("rule").agg(F.max("verdict").alias("verdict")))
    cut = F.regexp_extract(F.col(url_col).cast("string"), r"(?s)^.*?://([^?#]*)", 1)
    x = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(cut, F.lit("")).alias("rest"), F.monotonically_increasing_id().alias("k"))
    x = x.select("page_id", "k", F.translate(F.regexp_extract("rest", r"(?s)^([^/]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
                 F.regexp_extract("rest", r"(?s)^[^/]*(.*)$", 1).alias("path"))
    slash = F.instr("rule", "/")
    shape = F.struct(F.when(slash > 0, slash - 1).otherwise(F.length("rule")).alias("h"), F.when(slash > 0, F.length("rule") - slash + 1).otherwise(0).alias("p"))
    shapes = rules.select(shape.alias("s")).distinct().agg(F.collect_list("s").alias("shapes"))  # pairs of lengths, not rules
    fits = lambda s: (s["h"] > 0) & (s["h"] <= F.length("host")) & (s["p"] <= F.length("path")) & (
        (s["h"] == F.length("host")) | (F.substring("host", F.length("host") - s["h"], F.lit(1)) == "."))
    keys = F.transform(F.filter(F.coalesce("shapes", F.array()), fits), lambda s: F.concat(
        F.substring("host", F.length("host") - s["h"] + 1, s["h"]), F.substring("path", F.lit(1), s["p"])))
    hits = x.join(F.broadcast(shapes)).select("k", F.explode(keys).alias("rule")).join(rules, "rule")
    best = hits.groupBy("k").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("b"))
    return x.join(best, "k", "left").select("page_id", "host", "path", F.col("b.rule").alias("rule"),
                                            F.coalesce("b.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))
