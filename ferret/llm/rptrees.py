"""Embedding near-duplicates by a forest of random-projection trees.

A tree splits its space at the median of random projections. Vectors within a
margin of a split go to both sides (spill), so linked vectors are rarely
parted in a tree and hardly ever in all ``TREES``. Trees are fitted on a
bounded sample (``SAMPLE`` vectors, by hash of the id); every vector is then
led to its leaves. Inside a loose dense cluster most vectors lie within the
margin of any split, so a split whose sides together exceed ``SPREAD`` times
their parent is none, and the largest parts are split first until a tree has
``FLOATS / TREES`` numbers in its directions or its leaves hold ``COPIES`` times
the sample. A leaf that then holds more than ``BIG`` vectors of the table is split
on by the tasks, level by level: directions come from the leaf's number, medians
and the sides' sizes from partial aggregates, and the same rules say whether a
split is one. So leaves do not grow with the table, but for dense clusters; what
stays together is compared in chunk pairs. Vectors are compared within leaves,
in double precision, and all links found are exact.

Equal vectors become one row with a count first. A leaf of any size is dealt
into chunks and each pair of chunks is one task (matrix product), so neither a
dense cluster nor a leaf that the sample could not split is a large group. A
pair that shares several leaves counts in the first of them alone. Tasks give
back link counts and a spanning forest, never pairs; components come from
:mod:`components`.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; a null
vec_id links with nothing; rows with equal vec_ids count as vectors of their
own, like or unlike; labels and other columns are not read; an empty table
stays empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, stored
from .components import components

TREES = 10
SAMPLE = 20_000
LEAF = 200  # wished rows of a leaf
CHUNK = 512
BIG = 8 * CHUNK  # a leaf of more vectors is split again
WAYS = 4  # directions that such a leaf is tried with
SPILL = 0.6  # margin, in standard deviations of a linked pair's projected distance
STUCK = 0.85  # a split that leaves a child this share of its parent is none
SPREAD = 1.3  # nor is one whose children together are more than this of it
COPIES = 8  # a tree's leaves hold this many times the sample at most
FLOATS = 8_000_000  # of the directions of a forest: 64 MB
TRIES = 8  # directions after the first that a part is tried with


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors at length 1."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Forest:
    """Trees over unit vectors of one length. Leaves are numbered through."""

    def __init__(self, sample: np.ndarray, rows: float, threshold: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.margin = SPILL * np.sqrt(2 - 2 * threshold) / np.sqrt(dim)
        least = max(8, LEAF * len(sample) / max(1.0, rows))
        self.nodes: list[tuple | int] = []  # (direction, split, left, right) or the leaf's number
        self.roots, self.leaves = [], 0
        for _ in range(TREES):
            self.roots.append(self._grow(sample, least, rng, dim))

    def _split(self, x, idx, rng, dim) -> tuple | None:
        """A direction, a split and the two sides: the median of the first
        direction, else the allowed one of other places and directions that
        leaves the fewest pairs."""
        best = None
        for k in range(1 + TRIES):
            direction = rng.standard_normal(dim)
            direction /= np.linalg.norm(direction)
            p = x[idx] @ direction
            for split in np.quantile(p, [0.5] if k == 0 else [0.5, 0.35, 0.65, 0.2, 0.8]).tolist():
                left, right = p <= split + self.margin, p >= split - self.margin
                a, b = int(left.sum()), int(right.sum())
                if max(a, b) <= STUCK * len(idx) and a + b <= SPREAD * len(idx) and (best is None or a * a + b * b < best[0]):
                    best = (a * a + b * b, direction, split, idx[left], idx[right])
            if k == 0 and best:
                break
        return best and best[1:]

    def _grow(self, x, least, rng, dim) -> int:
        root, held = len(self.nodes), len(x)
        budget = max(1, FLOATS // (TREES * dim))  # splits left
        self.nodes.append(-1)
        todo = [(-len(x), root, np.arange(len(x)))]
        while todo:
            _, at, idx = heapq.heappop(todo)
            found = self._split(x, idx, rng, dim) if len(idx) > least and budget and held < COPIES * len(x) else None
            if found is None:
                self.nodes[at] = self.leaves
                self.leaves += 1
                continue
            direction, split, *sides = found
            budget -= 1
            held += len(sides[0]) + len(sides[1]) - len(idx)
            self.nodes[at] = (direction, split, len(self.nodes), len(self.nodes) + 1)
            for side in sides:
                heapq.heappush(todo, (-len(side), len(self.nodes), side))
                self.nodes.append(-1)
        return root

    def route(self, x: np.ndarray) -> list[list[int]]:
        """Leaves of each vector, ascending."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        todo = [(r, np.arange(len(x))) for r in reversed(self.roots)]
        while todo:
            at, idx = todo.pop()
            node = self.nodes[at]
            if isinstance(node, int):
                for k in idx.tolist():
                    out[k].append(node)
            elif len(idx):
                p = x[idx] @ node[0]
                todo.append((node[3], idx[p >= node[1] - self.margin]))
                todo.append((node[2], idx[p <= node[1] + self.margin]))
        return [sorted(x) for x in out]


def _spread(link: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest place reachable from each row and column over the links.
    Columns count on after the rows, unless rows and columns are the ``same``."""
    rows, none = np.arange(link.shape[0]), np.iinfo(np.int64).max
    cols = rows if same else link.shape[0] + np.arange(link.shape[1])
    while True:
        r = np.minimum(rows, np.where(link, cols, none).min(1, initial=none))
        c = np.minimum(cols, np.where(link, r[:, None], none).min(0, initial=none))
        if same:
            r = c = np.minimum(r, c)
        if (r == rows).all() and (c == cols).all():
            return rows, cols
        rows, cols = r, c


def _compare(threshold: float):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        own, leaf = rows["own"].to_numpy(), rows["leaf"].iloc[0]
        same = rows["i"].iloc[0] == rows["j"].iloc[0]
        left = np.flatnonzero(own == rows["i"].iloc[0])
        right = left if same else np.flatnonzero(own == rows["j"].iloc[0])
        ids, n = rows["node"].to_numpy(), rows["n"].to_numpy()
        x = unit(np.stack(rows["vec"].to_numpy()).astype(np.float64))
        link = x[left] @ x[right].T >= threshold
        if same:
            np.fill_diagonal(link, False)
        if link.any():
            # pairs that met in a leaf before this one count there
            at = np.repeat(np.arange(len(rows)), [len(v) for v in rows["leaves"]])
            seen = np.concatenate(list(rows["leaves"]))
            at, seen = at[seen < leaf], seen[seen < leaf]
            names, col = np.unique(seen, return_inverse=True)
            member = np.zeros((len(rows), len(names)), np.float32)
            member[at, col] = 1
            link &= member[left] @ member[right].T < 0.5
        count = np.zeros(len(rows), np.int64)
        count[left] += link @ n[right]
        if not same:
            count[right] += link.T @ n[left]
        r, c = _spread(link, same)
        place = np.concatenate([left, right])
        root = np.arange(len(rows))
        root[left] = place[r]
        if not same:
            root[right] = place[c]
        keep = count > 0
        return pd.DataFrame({"node": ids[keep], "links": count[keep], "root": ids[root[keep]]})

    return work


def _split_again(led: DataFrame, threshold: float) -> DataFrame:
    """``led`` (``node, n, vec, leaves``) with its large leaves split until none is
    large or a split would not part it."""
    kind = dict(led.dtypes)["vec"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, vecs = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            out: list = [None] * len(vecs)
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = unit(np.array([vecs[k] for k in at]))
                names, which = np.unique(leaf[at], return_inverse=True)
                for k, name in enumerate(names.tolist()):
                    ways = np.random.default_rng([name % 2 ** 64, 23]).standard_normal((WAYS, d))
                    ways /= np.linalg.norm(ways, axis=1, keepdims=True)
                    # in margins of a split
                    ps = x[which == k] @ ways.T * np.sqrt(d) / (SPILL * np.sqrt(2 - 2 * threshold))
                    for place, p in zip(at[which == k].tolist(), ps, strict=True):
                        out[place] = p
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], names=["node", "leaf", "ps"])

    stuck = None
    while True:
        x = led.select("node", "vec", F.explode("leaves").alias("leaf"))
        big = x.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > BIG)
        big = stored(big if stuck is None else big.join(stuck, "leaf", "left_anti"), "rp-big")
        if not big.head(1):
            return led
        p = x.join(small(big), "leaf").select("node", "leaf", "vec").mapInArrow(project, "node long, leaf long, ps array<double>")
        p = stored(p, "rp-projected")
        mids = p.groupBy("leaf").agg(F.array(*[F.percentile_approx(F.get("ps", F.lit(k)), 0.5, 200) for k in range(WAYS)]).alias("mids"))
        p = p.join(small(stored(mids, "rp-mids")), "leaf")
        side = lambda k, s: F.sum((s * (F.get("ps", F.lit(k)) - F.get("mids", F.lit(k))) <= 1).cast("long"))
        sizes = p.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.struct(side(k, 1).alias("a"), side(k, -1).alias("b"), F.lit(k).alias("k"))
                                                                               for k in range(WAYS)]).alias("ways"))
        parts = F.filter("ways", lambda w: (F.greatest(w["a"], w["b"]) <= STUCK * F.col("rows")) & (w["a"] + w["b"] <= SPREAD * F.col("rows")))
        best = F.array_min(F.transform(parts, lambda w: F.struct((w["a"] * w["a"] + w["b"] * w["b"]).alias("pairs"), w["k"].alias("k"))))
        sizes = stored(sizes.select("leaf", best["k"].alias("k")), "rp-ways")
        none = sizes.filter("k IS NULL").select("leaf")
        stuck = none if stuck is None else stuck.union(none)
        moved = p.join(small(sizes.filter("k IS NOT NULL")), "leaf")
        off = F.get("ps", F.col("k")) - F.get("mids", F.col("k"))
        child = lambda s: F.when(s * off <= 1, F.xxhash64("leaf", F.lit(s)))
        change = moved.select("node", "leaf", F.array_compact(F.array(child(1), child(-1))).alias("to")).groupBy("node").agg(
            F.collect_list("leaf").alias("gone"), F.flatten(F.collect_list("to")).alias("new"))  # of one vector: few
        leaves = F.sort_array(F.array_distinct(F.concat(F.array_except("leaves", "gone"), "new")))
        led = led.join(change, "node", "left").select("node", "n", F.col("vec").cast(kind).alias("vec"), F.when(F.col("gone").isNull(), F.col("leaves")).otherwise(leaves).alias("leaves"))
        led = stored(led, "rp-led")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"  # floats travel as such
    v = F.col(vec_col).cast(f"array<{kind}>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)), v).alias("vec"))
    good = rows.filter("vec IS NOT NULL AND vec_id IS NOT NULL")
    reps = good.groupBy("vec").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
    # different vectors are different nodes, whatever their ids
    reps = stored(reps.withColumn("node", F.monotonically_increasing_id()), "rp-vectors")
    sizes = {r["d"]: r["n"] for r in reps.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    forests, first = {}, 0
    for d, n in sorted(sizes.items()):
        sample = reps.filter(F.size("vec") == d).orderBy(F.xxhash64("vec")).limit(SAMPLE).select("vec").collect()
        forests[d] = (first, Forest(unit(np.array([r.vec for r in sample])), n, threshold))
        first += forests[d][1].leaves
    sent = spark.sparkContext.broadcast(forests)  # 64 MB of directions per length of vectors at most (FLOATS)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column(2).to_pylist()
            out: list = [None] * len(vecs)
            dims = np.array([len(x) for x in vecs])
            for d in np.unique(dims).tolist():
                first, forest = sent.value[d]
                at = np.flatnonzero(dims == d)
                for k, leaves in zip(at.tolist(), forest.route(unit(np.array([vecs[k] for k in at]))), strict=True):
                    out[k] = [first + x for x in leaves]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=["node", "n", "vec", "leaves"])

    led = stored(reps.select("node", "n", "vec").mapInArrow(route, f"node long, n long, vec array<{kind}>, leaves array<long>"), "rp-led")
    led = _split_again(led, threshold)
    x = led.withColumn("leaf", F.explode("leaves"))
    many = x.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    x = x.join(many, "leaf").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    x = x.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    found = x.groupBy("leaf", "i", "j").applyInPandas(_compare(threshold), "node long, links long, root long")
    found = stored(found, "rp-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    top = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "top")
    reps = stored(reps.join(links, "node", "left").join(top, "node", "left").withColumn("top", F.coalesce("top", "node")), "rp-linked")
    low = reps.groupBy("top").agg(F.min("low").alias("component"))
    reps = reps.join(low, "top").select("vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component")
    out = rows.join(reps, "vec", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    alone = F.col("vec_id").isNull()
    return out.select("vec_id", F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
