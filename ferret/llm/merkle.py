"""Merkle manifest of a table: a hash tree per group of rows and one above
the groups, with an inclusion proof for every row.

A leaf is the digest of a row's columns. The leaves of a group stand in the
order of the id; of every ``FAN`` consecutive nodes the digest of their digests
is the parent, until one node, the group's subroot, remains. Subroots in the
order of their groups are the leaves of the tree that ends in the root.

Per level fixed-offset lag and lead columns, masked by a node's slot in its
run and by the run's length, are its siblings; first children hash the
parents. Places in a group come from a range partitioning and the counts of
its pieces, and windows span ``BLOCK`` places, so neither a group with most of
the rows nor their whole number meets in one task. Proofs go from the root
downwards, a join of nodes with their parents a level; a node meets at most
``FAN`` children. Levels are written to the shared folder.

Defined results: a null column is one mark in its leaf, unlike any value; null
groups are a group of their own and the first; null ids come first, equal ids
are in the order of their leaves, equal rows count each (their proofs differ
by place); a lone leaf is its subroot, a lone subroot the root, and their
proofs have no level; texts are hashed whole; columns that are not named are
not read; an empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, small, stored

FAN = 8
BLOCK = FAN ** 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for a null, else byte count, ``:`` and value."""
    marks = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
             for c in (c.cast("string") for c in columns)]
    return digest(*marks)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``proof``."""
    return F.aggregate(proof, leaf, lambda acc, x: digest(x["left"], acc, x["right"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), "")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` (with ``key``, not null) plus ``pos``, the place in the
    group of equal keys, and ``n``, the group's rows."""
    at, piece = F.col("at"), F.shiftright("at", 33)  # the partition's number stands above bit 33
    x = rows.repartitionByRange(partitions(rows.sparkSession), "key", *order).sortWithinPartitions("key", *order)
    x = stored(x.withColumn("at", F.monotonically_increasing_id()), "mk-ranged").withColumn("piece", piece)
    sizes = x.groupBy("key", "piece").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("key")  # a row per piece of a group
    before = F.sum("rows").over(group.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    sizes = stored(sizes.select("key", "piece", "first", F.coalesce(before, F.lit(0)).alias("base"), F.sum("rows").over(group).alias("n")), "mk-pieces")
    x = x.join(small(sizes), ["key", "piece"])
    return x.withColumn("pos", F.col("at") - F.col("first") + F.col("base")).drop("at", "piece", "first", "base")


def _beside(nodes: DataFrame) -> DataFrame:
    """Nodes ``key, pos, n, hash`` plus ``left`` and ``right``: the digests of
    the run's nodes before and after."""
    w = Window.partitionBy("key", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = (F.col("pos") % FAN).cast("int")
    length = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot).cast("int")
    x = nodes.select("*", *[F.lag("hash", k).over(w).alias(f"lag{k}") for k in range(1, FAN)],
                     *[F.lead("hash", k).over(w).alias(f"lead{k}") for k in range(1, FAN)])
    # the slot masks the lags, the run's length the leads
    left = F.slice(F.array(*[f"lag{k}" for k in range(FAN - 1, 0, -1)]), FAN - slot, slot)
    right = F.slice(F.array(*[f"lead{k}" for k in range(1, FAN)]), F.lit(1), length - slot - 1)
    return x.select(*nodes.columns, F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def _tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of the trees over ``key, pos, n, hash``, each stored, the last
    with one node a key. A single node goes up unchanged."""
    levels = [leaves.select("key", "pos", "n", "hash")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = _beside(levels[-1]).filter(F.col("pos") % FAN == 0)
        up = F.when(F.col("n") > 1, digest("hash", "right")).otherwise(F.col("hash"))
        levels.append(stored(first.select("key", F.floor(F.col("pos") / FAN).alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), up.alias("hash")), "mk-level"))
        most = -(-most // FAN)
    return levels


def _down(levels: list[DataFrame], above: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The lowest level plus ``proof`` and ``keep``, both from ``above`` (a row
    per key, ``proof`` of its top node) down the levels."""
    path = levels[-1].join(above, "key")
    for nodes in reversed(levels[:-1]):
        up = path.select("key", F.col("pos").alias("parent"), "proof", *keep)
        x = _beside(nodes).withColumn("parent", F.floor(F.col("pos") / FAN)).join(up, ["key", "parent"])
        own = F.array(F.struct("left", "right"))
        path = x.withColumn("proof", F.when(F.col("n") > 1, F.concat(own, "proof")).otherwise(F.col("proof"))).drop("parent", "left", "right")
    return path


def manifest(rows: DataFrame, columns: Sequence[str] = COLUMNS, group_col: str = "lang", id_col: str = "doc_id",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """Per row ``leaf, subroot, root`` and ``proof``, an array of ``left`` and
    ``right`` (digests before and after, joined) from the leaf's level to the
    root's, plus the columns ``keep`` computed from the row."""
    keep = keep or {}
    group = F.col(group_col).cast("string")
    key = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))
    leaf = leaf_of([F.col(c) for c in columns])
    extra = [f"keep_{k}" for k in range(len(keep))]
    x = rows.select(key.alias("key"), F.col(id_col).alias("id"), leaf.alias("hash"), *[c.alias(e) for e, c in zip(extra, keep.values(), strict=True)])
    # stored first: a range partitioning reads its input twice
    leaves = stored(_placed(stored(x, "mk-rows"), ["id", "hash"]), "mk-leaves")
    trees = _tree(leaves)
    tops = trees[-1].select(F.lit("").alias("key"), F.col("key").alias("tree"), F.col("hash"))
    tops = stored(_placed(tops, ["tree"]), "mk-tops")
    crown = _tree(tops)
    root = crown[-1].select("key", F.col("hash").alias("root"), F.array().cast(PROOF).alias("proof"))
    crown[0] = tops
    above = _down(crown, root, ["root"]).select(F.col("tree").alias("key"), F.col("hash").alias("subroot"), "root", "proof")
    trees[0] = leaves
    x = _down(trees, stored(above, "mk-above"), ["subroot", "root"])
    return x.select(F.col("hash").alias("leaf"), "subroot", "root", "proof", *[F.col(e).alias(n) for e, n in zip(extra, keep, strict=True)])
