"""Topic models: online variational Bayes for LDA, the topics a table.

The method, its parameters and its results are those of Spark ML's online
``LDA`` (batches drawn with replacement, learning offset 1024 and decay 0.51,
concentrations 1 / k, that of the documents learned), but Spark ML holds the
topics x vocabulary matrix on the driver and sends it there at each iteration.
Here a row of the table is what a term's weights in all topics have above
``eta``, divided by ``scale``: ``idx, l0, l1, ...``. Old weights fade by way of
``scale`` alone, so an iteration is one job that adds to the drawn terms:

* the terms of the drawn documents are joined with their weights,
* each document, one row set of at most the vocabulary, infers its topics,
* its contributions are added to the weights by term, written beside the old ones.

Three more rows (``OWN``, ``ADDED``, ``COUNT``) give the driver the sums of the
drawn documents: expectations, contributions by topic, their number. What is drawn
depends on a document's place and the seed, not on partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, path_exists, scratch
from .ordinals import placed

RATE, OFFSET, DECAY, SHAPE = 0.05, 1024.0, 0.51, 100.0
BLOCK = 4096  # terms whose first weights are drawn together
OWN, ADDED, COUNT = -1, -2, -3


def _shifted(x, step):
    """``x`` raised to 8 at least by steps of 1, and the sum of ``step`` over them."""
    x, total = np.array(x, float), np.zeros(np.shape(x))
    for _ in range(8):
        low = x < 8
        if not low.any():
            break
        total += np.where(low, step(x), 0)
        x = np.where(low, x + 1, x)
    return x, total


def digamma(x):
    x, less = _shifted(x, lambda v: 1 / v)
    f = 1 / (x * x)
    return np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132)))) - less


def trigamma(x):
    x, more = _shifted(x, lambda v: 1 / (v * v))
    f = 1 / (x * x)
    return (1 + 0.5 / x + f * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f * (1 / 30 - f * 5 / 66))))) / x + more


def lgamma(x):
    x, less = _shifted(x, np.log)
    f = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - f * (1 / 360 - f * (1 / 1260 - f / 1680))) / x - less


def _expectation(a: np.ndarray) -> np.ndarray:
    """Of the logarithm of a Dirichlet variable."""
    return digamma(a) - digamma(a.sum())


def _cols(k: int) -> list[str]:
    return [f"l{j}" for j in range(k)]


def _schema(k: int) -> str:
    return ", ".join(["idx int", *[f"{c} double" for c in _cols(k)]])


def documents(corpus: DataFrame) -> DataFrame:
    """Stored rows of ``corpus`` (key columns and ``features``, a count vector):
    ``gid`` (place in the order of the keys), the keys, ``indices``, ``values``."""
    keys = [c for c in corpus.columns if c != "features"]
    x = placed(corpus, keys, out="gid")
    rest = x.select("gid", *keys)
    names, fields = [*rest.columns, "indices", "values"], ", ".join(f"`{c}` {t}" for c, t in rest.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], v.field("indices"), v.field("values")], names=names)

    x = x.select(*rest.columns, "features").mapInArrow(work, f"{fields}, indices array<int>, values array<double>")
    dense = F.transform("values", lambda _, at: at)  # a dense vector names no places
    return materialize(x.withColumn("indices", F.coalesce("indices", dense)))[0]


def _entries(docs: DataFrame, *cols) -> DataFrame:
    e = docs.select("gid", *cols, F.explode(F.arrays_zip("indices", "values")).alias("e"))
    return e.select("gid", *cols, F.col("e.indices").alias("idx"), F.col("e.values").alias("x")).filter("x <> 0")


def _drawn(seed: int, iteration: Column) -> Column:
    """How often a document is in the batch of ``iteration``: a Poisson variable."""
    u = F.pmod(F.xxhash64(F.lit(seed), iteration.cast("int"), "gid"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    below, count = 0.0, F.lit(0)
    for n in range(8):
        below += math.exp(-RATE) * RATE**n / math.factorial(n)
        count = count + (u >= below).cast("int")
    return count


def _inferred(table: pa.Table, k: int, alpha: np.ndarray, eta: float, scale: float, offset: np.ndarray, seed: list[int]):
    """Of a document's terms: places, counts, weights, log weights, and the
    document's topics, all steps as in Hoffman, Blei, Bach (2010)."""
    order = np.argsort(table.column("idx").to_numpy())
    idx, x = table.column("idx").to_numpy()[order], table.column("x").to_numpy()[order]
    log_beta = digamma(eta + scale * np.stack([table.column(c).to_numpy()[order] for c in _cols(k)], axis=1)) - offset
    beta = np.exp(log_beta)
    gamma = np.random.default_rng(seed).gamma(SHAPE, 1 / SHAPE, k)
    theta, change = np.exp(_expectation(gamma)), 1.0
    norm = beta @ theta + 1e-100
    while change > 1e-3:
        last = gamma
        gamma = theta * ((x / norm) @ beta) + alpha
        theta = np.exp(_expectation(gamma))
        norm = beta @ theta + 1e-100
        change = np.abs(gamma - last).mean()
    return idx, x, beta, log_beta, gamma, theta, norm


class TopicModel:
    """``topics`` (``idx, l0, ...``, weights less ``eta`` divided by ``scale``),
    the ``sums`` of these, the concentrations ``alpha`` of the documents and ``eta``
    of the topics, and the vocabulary's size."""

    def __init__(self, topics: DataFrame, sums: np.ndarray, alpha: np.ndarray, eta: float, size: int, scale: float = 1.0, seed: int = 0):
        self.topics, self.sums, self.alpha = topics.filter("idx >= 0"), np.array(sums, float), np.array(alpha, float)
        self.eta, self.size, self.scale, self.seed = eta, size, scale, seed
        self.k = len(self.alpha)

    @property
    def totals(self) -> np.ndarray:
        """Each topic's sum of weights."""
        return self.eta * self.size + self.scale * self.sums

    def _by_document(self, entries: DataFrame, work, schema: str) -> DataFrame:
        # the hint keeps the weights from being broadcast, which would pass them through the driver
        return entries.join(self.topics.hint("shuffle_hash"), "idx").groupBy("gid").applyInArrow(work, schema)

    def _inference(self):
        k, alpha, eta, scale, offset = self.k, self.alpha, self.eta, self.scale, digamma(self.totals)
        return lambda table, seed: _inferred(table, k, alpha, eta, scale, offset, seed)

    def learn(self, docs: DataFrame, n_docs: int, iteration: int, path: str) -> TopicModel:
        """The model after a batch that is not empty; its table is written to ``path``."""
        k, alpha, seed, infer = self.k, self.alpha, self.seed, self._inference()
        weight = (OFFSET + iteration) ** -DECAY
        scale = self.scale * (1 - weight)
        share = weight * n_docs / math.ceil(RATE * n_docs) / scale

        def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            idx, x, beta, _, gamma, theta, norm = infer(table, [seed, iteration, key[0].as_py()])
            times = table.column("c")[0].as_py()
            stat = (times * share * (x / norm))[:, None] * theta * beta
            more = np.stack([times * _expectation(gamma), stat.sum(axis=0), np.full(k, float(times))])
            return pa.table([pa.array(np.append(idx, [OWN, ADDED, COUNT]).astype(np.int32)), *map(pa.array, np.concatenate([stat, more]).T)], names=["idx", *_cols(k)])

        batch = docs.withColumn("c", _drawn(seed, F.lit(iteration))).filter("c > 0")
        got = self._by_document(_entries(batch, "c"), work, _schema(k))
        both = self.topics.unionByName(got).groupBy("idx").agg(*[F.sum(c).alias(c) for c in _cols(k)])
        both.write.mode("overwrite").parquet(path)
        topics = docs.sparkSession.read.schema(_schema(k)).parquet(path)
        seen = {r[0]: np.array(r[1:], float) for r in topics.filter("idx < 0").collect()}
        n = int(seen[COUNT][0])
        return TopicModel(topics, self.sums + seen[ADDED], _learned(alpha, seen[OWN] / n, n, weight), self.eta, self.size, scale, seed)

    def _corpus_bound(self, docs: DataFrame) -> float:
        alpha, seed, infer = self.alpha, self.seed, self._inference()

        def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            _, x, _, log_beta, gamma, _, _ = infer(table, [seed, key[0].as_py()])
            log_theta = _expectation(gamma)
            each = log_beta + log_theta
            top = each.max(axis=1)
            bound = x @ (top + np.log(np.exp(each - top[:, None]).sum(axis=1)))
            bound += ((alpha - gamma) * log_theta + lgamma(gamma) - lgamma(alpha)).sum() + float(lgamma(alpha.sum()) - lgamma(gamma.sum()))
            return pa.table([pa.array([float(bound)])], names=["bound"])

        return self._by_document(_entries(docs), work, "bound double").agg(F.coalesce(F.sum("bound"), F.lit(0.0))).first()[0]

    def _topics_bound(self) -> float:
        eta, scale, offset, cols = self.eta, self.scale, digamma(self.totals), _cols(self.k)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = eta + scale * np.stack([c.to_numpy() for c in batch.columns], axis=1)
                bound = ((eta - w) * (digamma(w) - offset) + lgamma(w) - lgamma(eta)).sum()
                yield pa.RecordBatch.from_arrays([pa.array([float(bound)])], names=["bound"])

        terms = self.topics.select(*cols).mapInArrow(work, "bound double").agg(F.coalesce(F.sum("bound"), F.lit(0.0))).first()[0]
        return terms + float((lgamma(eta * self.size) - lgamma(self.totals)).sum())

    def likelihood(self, docs: DataFrame) -> tuple[float, float]:
        """Bound of the log likelihood of ``documents()`` rows, and the log perplexity."""
        bound = self._corpus_bound(docs) + self._topics_bound()
        tokens = docs.agg(F.sum(F.aggregate("values", F.lit(0.0), lambda a, x: a + x))).first()[0]
        return bound, -bound / tokens if tokens else math.nan

    def describe(self, n: int) -> DataFrame:
        """``topic, rank`` (from 0), ``idx, weight``: the ``n`` heaviest terms of each topic."""
        each = F.array(*[(F.col(c) * self.scale + self.eta) / float(t) for c, t in zip(_cols(self.k), self.totals, strict=True)])
        t = self.topics.select("idx", F.posexplode(each).alias("topic", "weight"))
        w = Window.partitionBy("topic").orderBy(F.col("weight").desc(), "idx")
        return t.withColumn("rank", F.row_number().over(w) - 1).filter(F.col("rank") < n).select("topic", "rank", "idx", "weight")

    def transform(self, corpus: DataFrame) -> DataFrame:
        """The key columns and ``topicDistribution``, an array; zeros without a term."""
        docs = documents(corpus)
        seed, infer = self.seed, self._inference()

        def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            gamma = infer(table, [seed, key[0].as_py()])[4]
            return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([gamma / gamma.sum()], pa.list_(pa.float64()))], names=["gid", "own"])

        own = self._by_document(_entries(docs), work, "gid long, own array<double>")
        zeros = F.array(*[F.lit(0.0)] * self.k)
        return docs.drop("indices", "values").join(own, "gid", "left").withColumn("topicDistribution", F.coalesce("own", zeros)).drop("gid", "own")

    def save(self, path: str) -> None:
        spark = self.topics.sparkSession
        self.topics.write.mode("overwrite").parquet(f"{path}/topics")
        rest = [(self.sums.tolist(), self.alpha.tolist(), float(self.eta), self.size, float(self.scale), self.seed)]
        spark.createDataFrame(rest, "sums array<double>, alpha array<double>, eta double, size long, scale double, seed long").coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TopicModel:
        for part in ("topics", "parameters"):
            if not path_exists(spark, f"{path}/{part}"):
                raise FileNotFoundError(f"no topic model in {path}")
        p = spark.read.parquet(f"{path}/parameters").first()
        return TopicModel(spark.read.schema(_schema(len(p["alpha"]))).parquet(f"{path}/topics"), p["sums"], p["alpha"], p["eta"], p["size"], p["scale"], p["seed"])


def _learned(alpha: np.ndarray, mean: np.ndarray, n: int, weight: float) -> np.ndarray:
    """A Newton step of the documents' concentrations (Huang 2005), as long as all stay above 0."""
    slope = n * (mean - _expectation(alpha))
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - weight * (slope - b) / q
    return moved if (moved > 0).all() else alpha


def _first(spark: SparkSession, size: int, k: int, seed: int, path: str) -> TopicModel:
    eta = 1 / k

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                idx = np.arange(block * BLOCK, min(size, (block + 1) * BLOCK))
                w = np.random.default_rng([seed, block]).gamma(SHAPE, 1 / SHAPE, (k, len(idx))) - eta
                yield pa.RecordBatch.from_arrays([pa.array(idx.astype(np.int32)), *map(pa.array, w)], names=["idx", *_cols(k)])

    spark.range(-(-size // BLOCK)).mapInArrow(work, _schema(k)).write.parquet(path)
    topics = spark.read.schema(_schema(k)).parquet(path)
    sums = topics.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in _cols(k)]).first()
    return TopicModel(topics, sums, np.full(k, 1 / k), eta, size, seed=seed)


def models(docs: DataFrame, size: int, k: int, steps: tuple[int, ...], seed: int = 0) -> Iterator[TopicModel]:
    """The model after each number of iterations in ``steps`` (ascending). Two
    folders take turns, so a model but the last is to be used before the next."""
    spark, seed, path = docs.sparkSession, seed & (1 << 31) - 1, scratch(docs.sparkSession)
    n_docs = docs.count()
    some = docs.filter(F.exists("values", lambda x: x != 0)).select("gid", F.explode(F.sequence(F.lit(1), F.lit(max(1, *steps)))).alias("i"))
    filled = {r.i for r in some.filter(_drawn(seed, F.col("i")) > 0).select("i").distinct().collect()}
    model, turn = _first(spark, size, k, seed, f"{path}-0"), 0
    for step in range(max(steps) + 1):
        if step in filled:  # an empty batch teaches nothing
            turn = 1 - turn
            model = model.learn(docs, n_docs, step, f"{path}-{turn}")
        if step in steps:
            yield model
