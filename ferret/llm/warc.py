"""WARC archives: writing with revisit records, and reading by boundary-chain
verification.

Writing. A record is one string; Spark's text writer puts it into the archive
with the record end (two line ends) as its separator, so files are made by
Spark's own commit protocol on any file system. Payloads that occur more than
once are found by digest (partial aggregation, then a join that Spark splits
where one payload has a large share of the pages). Revisits are broadcast where
they are few; beyond that only pages that may be among them are shuffled.

Reading. The scan cuts archives at every occurrence of the magic, in any
number of splits; each cut is a candidate record with a successor offset (its
own start, header and Content-Length). Offsets are running sums of row
lengths, per split and then over splits. Within a split pointer jumping leads
each candidate to the offset where its chain leaves the split; over splits
pointer doubling from the start of the file finds the entries that the true
chain uses. Only candidates on that chain are records: a magic inside a
payload is reachable from nothing. Payloads cut by such a magic are put
together again and their digest is verified.

A split's slim rows (offsets and header fields, no payloads) are the largest
group any task holds. Defined results: null HTML is an empty payload; null
URLs have no target field; line ends in URLs become %0D and %0A; rows with
the same page_id and payload are responses each; an empty table writes
archives without records and reads none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cores, matched, stored, text_or_empty

VERSION = "WARC/1.1"
EOL = "\r\n"
MAGIC = VERSION + EOL
END = EOL + EOL
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32(hex_digest: Column) -> Column:
    """A 40-digit hex digest in base32: eight groups of 20 bits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), *_BASE32)


def write(pages: DataFrame, path: str, min_payload: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row below ``path``. Of equal payloads of at least
    ``min_payload`` bytes the smallest page_id is the response, others revisit it."""
    x = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     text_or_empty(html_col).alias("payload"))
    x = x.withColumn("sha", F.sha1("payload"))
    slim = x.select("page_id", "sha").filter(F.octet_length("payload") >= min_payload) if min_payload else x.select("page_id", "sha")
    first = slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
    again = slim.join(first, "sha").filter("page_id <> first").select("page_id", "sha", "first").distinct()
    x = matched(x, stored(again, "warc-revisits"), ["page_id", "sha"])  # pages that revisit nothing are not shuffled
    size, name = F.octet_length("payload"), lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    field = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(EOL))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(MAGIC), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", name(F.col("page_id"))), field("WARC-Date", F.lit(DATE)),
        F.coalesce(field("WARC-Target-URI", uri), F.lit("")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha")))),
        F.when(revisit, F.concat(field("WARC-Refers-To", name(F.col("first"))), field("X-Payload-Length", size.cast("string")))).otherwise(""),
        field("Content-Type", F.lit("text/html; charset=utf-8")), field("Content-Length", F.when(revisit, "0").otherwise(size.cast("string"))),
        F.lit(EOL), F.when(revisit, "").otherwise(F.col("payload")))
    x.select(record.alias("value")).write.option("lineSep", END).text(path)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic: ``file, block`` (offset of the split),
    ``seq`` (order) and ``value`` (what follows the magic)."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("seq"), "value")


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Scans within cut files alike: Spark sizes splits by the cores it has at
    the time, which change when an executor is lost between two scans."""
    key = "spark.sql.files.minPartitionNum"
    had = spark.conf.get(key, None)
    spark.conf.set(key, had or str(cores(spark)))
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(key)


def _field(name: str, value: str = r"([^\r\n]*)") -> Column:
    return F.regexp_extract("head", rf"(?imd)^{name}:[ \t]*{value}[ \t]*\r?$", 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per cut: place, parsed header, and the digest of the payload where
    all of it lies before the next cut."""
    x = _scan(spark, path).withColumn("head", F.substring_index("value", END, 1))
    x = x.withColumn("head_len", F.octet_length("head") + len(END)).withColumn("row_len", F.octet_length("value"))
    size = F.when(F.col("head_len") <= F.col("row_len"), F.expr("try_cast(size AS BIGINT)"))
    x = x.withColumn("size", _field("Content-Length", r"(\d{1,18})")).withColumn("size", size)
    whole = F.col("head_len") + F.col("size") <= F.col("row_len")
    payload = F.substring(F.col("value").cast("binary"), F.col("head_len") + 1, F.col("size").cast("int"))
    return x.select(
        "file", "block", "seq", F.col("row_len").cast("long").alias("row_len"), F.col("head_len").cast("long").alias("head_len"), "size",
        F.lower(_field("WARC-Type")).alias("type"), F.expr(r"try_cast(regexp_extract(head, '(?imd)^WARC-Record-ID:[ \t]*<urn:page:(-?\\d+)>', 1) AS BIGINT)").alias("page_id"),
        F.expr(r"try_cast(regexp_extract(head, '(?imd)^WARC-Refers-To:[ \t]*<urn:page:(-?\\d+)>', 1) AS BIGINT)").alias("refers_to"),
        F.upper(_field("WARC-Payload-Digest", r"sha1:([A-Za-z2-7]{32})")).alias("said"), _field("X-Payload-Length", r"(\d{1,18})").alias("full"),
        F.when(whole, base32(F.sha1(payload))).alias("digest"))


_PLACED = "file string, block long, start long, succ long, seq long"


def _leave(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Pointer jumping in one split: where each candidate's chain leaves it."""
    start, to = rows["start"].to_numpy(), rows["succ"].to_numpy().copy()
    order = np.argsort(start, kind="stable")
    start, to = start[order], to[order]
    while True:
        at = np.minimum(np.searchsorted(start, to), len(start) - 1)
        inside = (start[at] == to) & (to[at] > to)
        if not inside.any():
            break
        to = np.where(inside, to[at], to)  # all at once: the hops double
    return pd.DataFrame({"file": key[0], "block": key[1], "start": start, "exit": to})


def _walk(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of one split on the true chain, and for the others the record
    before them (none: -1, it began in an earlier split)."""
    rows = rows.sort_values("start", kind="stable")
    start, succ = rows["start"].to_numpy(), rows["succ"].to_numpy()
    on = start == rows["entry"].to_numpy()
    at = np.searchsorted(start, succ)
    at = np.where((at < len(start)) & (start[np.minimum(at, len(start) - 1)] == succ) & (succ > start), at, -1)
    hop = at
    while (hop >= 0).any():  # doubling: what is reached within 2^k hops
        on[hop[on & (hop >= 0)]] = True
        hop = np.where(hop >= 0, hop[np.maximum(hop, 0)], -1)
    owner = np.maximum.accumulate(np.where(on, start, -1))
    return rows[["file", "block", "start", "succ", "seq"]].assign(real=on, owner=owner)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``. Raises (when run) where a payload and its digest differ."""
    with _same_splits(spark):
        return _records(spark, path)


def _records(spark: SparkSession, path: str) -> DataFrame:
    cand = stored(candidates(spark, path), "warc-candidates")
    step = len(MAGIC)
    blocks = cand.groupBy("file", "block").agg(F.sum(F.col("row_len") + step).alias("n"))
    prior = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rel = F.coalesce(F.sum(F.col("row_len") + step).over(inside), F.lit(0))
    x = cand.withColumn("rel", rel).join(blocks, ["file", "block"])
    x = x.withColumn("start", F.col("base") + F.col("rel") - step)
    succ = F.col("start") + step + F.col("head_len") + F.col("size") + len(END)
    x = stored(x.select(*cand.columns, "start", F.coalesce(succ, F.lit(-1)).alias("succ")), "warc-placed")
    places = x.select("file", "block", "start", "succ", "seq")
    jump = places.filter("start >= 0 AND succ >= 0").groupBy("file", "block").applyInPandas(_leave, "file string, block long, start long, exit long")
    jump = stored(jump, "warc-jumps")
    most = jump.groupBy("file").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    entries = jump.filter("start = 0").select("file", "start")
    hops = jump.join(jump.select("file", F.col("exit").alias("start")).union(entries).distinct(), ["file", "start"], "left_semi").select("file", "start", "exit")
    reach = 1
    while reach < most:  # entries within ``reach`` splits of the file's start
        entries = stored(entries.union(entries.join(hops, ["file", "start"]).select("file", F.col("exit").alias("start"))).distinct(), "warc-entries")
        reach *= 2
        if reach < most:
            after = hops.select("file", F.col("start").alias("exit"), F.col("exit").alias("far"))
            hops = stored(hops.join(after, ["file", "exit"], "left").select("file", "start", F.coalesce("far", "exit").alias("exit")), "warc-hops")
    entry = entries.join(jump.select("file", "block", "start"), ["file", "start"]).groupBy("file", "block").agg(F.min("start").alias("entry"))
    walked = places.join(entry, ["file", "block"], "left").fillna(-2, ["entry"]).groupBy("file", "block").applyInPandas(
        _walk, f"{_PLACED}, real boolean, owner long")
    walked = stored(walked.select("file", "block", "start", "real", "owner", "seq"), "warc-walked")
    real = x.join(walked.filter("real").select("file", "start"), ["file", "start"])
    cut = real.filter("digest IS NULL").select("file", "start", "succ", "head_len", "size")
    if cut.head(1):
        mended = stored(_mend(spark, path, walked, stored(cut, "warc-cut")), "warc-mended")
        real = real.join(mended, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "mended"))
    full = F.coalesce(F.expr("try_cast(nullif(full, '') AS BIGINT)"), F.col("size"))
    revisit = F.col("type") == "revisit"
    fits = F.when(revisit | (F.col("digest") == F.col("said")), F.col("said"))
    return real.select("page_id", F.when(revisit, full).otherwise(F.col("size")).alias("payload_bytes"),
                       F.coalesce(fits, F.raise_error(F.concat(F.lit("payload digest differs in "), "file", F.lit(" at "), F.col("start").cast("string")))).cast("string").alias("payload_digest"),
                       F.col("type").alias("record_type"), F.col("refers_to"))


def _mend(spark: SparkSession, path: str, walked: DataFrame, cut: DataFrame) -> DataFrame:
    """Digests of payloads that contain the magic: the rows of a record, in
    order, with the magic between them."""
    own = walked.join(cut.select("file", F.col("start").alias("owner")), ["file", "owner"]).select("file", "owner", "start", "seq")
    # rows before a split's first record belong to one that began earlier
    open_ = walked.filter("owner < 0 AND start >= 0").select("file", "start", "seq")
    c = cut.select("file", F.col("start").alias("owner"), "succ")
    own = own.union(open_.join(c, "file").filter("start > owner AND start < succ").select("file", "owner", "start", "seq"))
    text = _scan(spark, path).select("seq", F.col("value").cast("binary").alias("value")).join(own, "seq")
    parts = F.array_sort(F.collect_list(F.struct("start", "value")))  # the rows of one record
    whole = text.groupBy("file", "owner").agg(parts.alias("p"))
    glued = F.aggregate("p", F.lit(b""), lambda acc, y: F.concat(acc, F.when(F.length(acc) > 0, F.lit(MAGIC.encode())).otherwise(F.lit(b"")), y["value"]))
    whole = whole.select("file", F.col("owner").alias("start"), glued.alias("bytes")).join(cut, ["file", "start"])
    payload = F.substring("bytes", F.col("head_len").cast("int") + 1, F.col("size").cast("int"))
    return whole.select("file", "start", base32(F.sha1(payload)).alias("mended"))
