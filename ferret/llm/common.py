"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

MAX_BROADCAST_ROWS = 400_000
SIEVE_BITS = 1 << 28  # 32 MB, in rows of 4 KB
# Words of the contracts: runs of bytes that are no ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in have:
        k += 1
        name = f"{base}_{k}"
    return name


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the session."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and
    survives the loss of any executor."""
    spark, path = df.sparkSession, run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders made by :func:`run_dir` (Hadoop file system aware)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of an explicit repartition, one per core at least."""
    return max(cores(spark), int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def odd_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether an id is null or occurs twice."""
    ids = docs.select(F.col(id_col).cast("long").alias("i"))
    return bool(ids.groupBy("i").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR i IS NULL").head(1))


def numbered(docs: DataFrame, rid: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus a number per row in document order: the id itself where
    ids are unique and not null, else the place in a sorted copy."""
    if not odd_ids(docs, id_col):
        return docs.withColumn(rid, F.col(id_col).cast("long"))
    x = docs.repartitionByRange(partitions(docs.sparkSession), id_col, text_col).sortWithinPartitions(id_col, text_col)
    return stored(x.withColumn(rid, F.monotonically_increasing_id()), "sa-numbered")


def _few(x: DataFrame, parts: str) -> bool:
    n = x.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(parts)).alias("parts")).first()
    return n["rows"] <= MAX_BROADCAST_ROWS and (n["parts"] or 0) <= 10 * MAX_BROADCAST_ROWS


def small(x: DataFrame, parts: str = "1") -> DataFrame:
    """``x`` to be broadcast if it has at most ``MAX_BROADCAST_ROWS`` rows and
    ten times as many ``parts`` (an expression, summed over the rows)."""
    return F.broadcast(x) if _few(x, parts) else x


def matched(x: DataFrame, stored_keys: DataFrame, on: list[str], parts: str = "1", how: str = "left") -> DataFrame:
    """Wide rows ``x`` joined (``left`` or ``inner``) to ``stored_keys`` on
    equal ``on`` columns of equal types, so that wide rows without a partner
    are not shuffled. A small table is broadcast, see :func:`small`. A larger one
    is hashed into a bitmap of ``SIEVE_BITS`` bits, which is broadcast instead:
    rows whose bit is not set have no partner and pass by, the others take part
    in a shuffled join, which settles false hits. With n keys a share of
    1 - exp(-n / SIEVE_BITS) of the rows without a partner goes along. ``x`` is
    read twice then. Null keys have no partner; columns: ``x``'s, then the rest
    of ``stored_keys``."""
    rest = [c for c in stored_keys.columns if c not in on]
    cols = [F.col(f"`{c}`") for c in (*x.columns, *rest)]
    if _few(stored_keys, parts):
        return x.join(F.broadcast(stored_keys), on, how).select(*cols)
    bucket, bits = fresh(x, "__bucket"), fresh(x, "__bits")
    h = F.pmod(F.xxhash64(*on), F.lit(SIEVE_BITS))
    sieve = stored_keys.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias(bits))
    at = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    y = x.withColumn(bucket, F.bitmap_bucket_number(h)).join(F.broadcast(sieve), bucket, "left").withColumn(bits, may)
    out = y.filter(bits).join(stored_keys, on, how).select(*cols)
    if how == "inner":
        return out
    none = [F.lit(None).cast(stored_keys.schema[c].dataType).alias(c) for c in rest]
    return out.union(y.filter(~F.col(bits)).select(*cols[:len(x.columns)], *none))
