"""Places in sorted order, and the last mark at or before a key, without a
window over the whole table: rows are range-partitioned and sorted, each piece
counts by itself, and the counts of the pieces before it are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, parallelism, small

_BEFORE = (Window.unboundedPreceding, -1)


def _pieces(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with ``_at``, ascending in sorted order, and ``_piece``."""
    n = parallelism(rows.sparkSession)
    x = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    x, _ = materialize(x.withColumn("__at", F.monotonically_increasing_id()))
    return x.withColumn("__piece", F.shiftright("__at", 33))


def placed(rows: DataFrame, order: list[str], group: str | None = None, out: str = "ord") -> DataFrame:
    """``rows`` plus their place (from 0) in the order of ``order``, within
    equal values of ``group`` (not null) if one is given."""
    cols, key = rows.columns, [group] if group else []
    x = _pieces(rows, key + order)
    by = [*key, "__piece"]
    sizes = x.groupBy(*by).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*(key or [F.lit(0)])).orderBy("__piece").rowsBetween(*_BEFORE)  # a row per piece
    sizes, _ = materialize(sizes.select(*by, "__first", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__base")))
    x = x.join(small(sizes), by)
    return x.select(*cols, (F.col("__at") - F.col("__first") + F.col("__base")).alias(out))


def last_mark(probes: DataFrame, marks: DataFrame, group: str, key: str, mark: str) -> DataFrame:
    """``probes`` plus the ``mark`` (a number that ascends with ``key``) of the
    last row of ``marks`` whose key is not above the probe's, within equal
    ``group``; null where there is none."""
    cols = probes.columns
    own = F.struct(*cols)
    kind = probes.select(own.alias("p")).schema["p"].dataType
    u = marks.select(group, key, F.lit(0).alias("__side"), F.col(mark).cast("long").alias("__mark"), F.lit(None).cast(kind).alias("__p")).unionByName(
        probes.select(group, key, F.lit(1).alias("__side"), F.lit(None).cast("long").alias("__mark"), own.alias("__p")))
    x = _pieces(u, [group, key, "__side"])
    w = Window.partitionBy(group, "__piece")
    here = F.max("__mark").over(w.orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    tops = x.groupBy(group, "__piece").agg(F.max("__mark").alias("__m"))
    before = Window.partitionBy(group).orderBy("__piece").rowsBetween(*_BEFORE)
    tops, _ = materialize(tops.select(group, "__piece", F.max("__m").over(before).alias("__before")))
    x = x.withColumn("__here", here).filter("__side = 1").join(small(tops), [group, "__piece"], "left")
    return x.select("__p.*", F.coalesce("__here", "__before").alias(mark))
