"""Similar groups of documents: bag-of-words cosine, dense-vector cosine and
LDA topic vectors.

A group is a (venue, year) pair; its bag of words is the vectorizer tokens
of its titles (lowercase words of two or more word characters, stop words
removed, terms in at least ``min_df`` groups). Groups are never
concatenated into one string: the bag is kept in long form
``(venue, year, term, freq)``.

Similarity is always *requests against all*: a bounded request table is
broadcast and joined on the term (or vector dimension), so the work is
linear in the data and no pair of non-request groups is ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import analyze as A
from ..session import materialize, scratch, small
from ..sources import tables as T
from . import lda as LDA
from .ordinals import placed

BOW_RE = r"[\p{L}\p{N}_]{2,}"


def group_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Records with title, venue and year present: ``(venue, year, doc_id, title)``."""
    r = T.records(spark, sf).dropna(subset=["title", "venue", "year"])
    return r.select("venue", "year", "doc_id", F.lower("title").alias("title"))


def bow(spark: SparkSession, sf: str, min_df: int = 10, stop_words=None) -> DataFrame:
    """Long-form bag of words per group, terms kept when in >= ``min_df`` groups."""
    stops = list(stop_words if stop_words is not None else A.spark_stop_words("english"))
    g = group_titles(spark, sf)
    t = g.select("venue", "year", F.explode(F.regexp_extract_all("title", F.lit(BOW_RE), 0)).alias("term"))
    t = t.filter(~F.col("term").isin(stops))
    c = t.groupBy("venue", "year", "term").agg(F.count(F.lit(1)).alias("freq"))
    c = c.withColumn("_df", F.count(F.lit(1)).over(Window.partitionBy("term")))
    return c.filter(F.col("_df") >= min_df).drop("_df")


def cosine_requests(vecs: DataFrame, reqs: DataFrame, keys: list[str], dim: str, val: str,
                    k: int = 5) -> DataFrame:
    """Top-k cosine of every request against all vectors (long form).

    ``vecs``: ``keys + [dim, val]``; ``reqs``: ``["r_" + key ...] + [dim, val]``
    (bounded, broadcast). The request itself is excluded.
    """
    rk = [f"r_{c}" for c in keys]
    norms = vecs.groupBy(*keys).agg(F.sqrt(F.sum(F.col(val) * F.col(val))).alias("_n"))
    rnorm = reqs.groupBy(*rk).agg(F.sqrt(F.sum(F.col(val) * F.col(val))).alias("_rn"))
    dots = (vecs.join(small(reqs.withColumnRenamed(val, "_rv")), dim)
            .groupBy(*rk, *keys).agg(F.sum(F.col(val) * F.col("_rv")).alias("_dot")))
    s = dots.join(norms, keys).join(small(rnorm), rk)
    s = s.withColumn("similarity", F.col("_dot") / F.col("_n") / F.col("_rn"))
    self_ = F.lit(True)
    for a, b in zip(rk, keys):
        self_ = self_ & (F.col(a) == F.col(b))
    s = s.filter(~self_)
    w = Window.partitionBy(*rk).orderBy(F.round("similarity", 6).desc(), *[F.col(c).asc() for c in keys])
    s = s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return s.select(*rk, *keys, F.round("similarity", 6).alias("similarity"), "rank")


def looked_up(asked: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of ``asked`` with ``found`` and, where found, what ``groups``
    holds; an unknown group is one row with ``found`` false."""
    own = groups.withColumn("found", F.lit(True))
    rest = [c for c in groups.columns if c not in keys]
    return small(asked).join(own, keys, "left").select(*keys, F.coalesce("found", F.lit(False)).alias("found"), *rest)


def centroids(emb: DataFrame) -> DataFrame:
    """Mean vector per label, ``(r_label, r_vec array<double>)``: labels rows."""
    e = emb.select("label", F.posexplode("embedding").alias("i", "x"))
    e = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vec = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])  # one value per dimension
    return e.groupBy(F.col("label").alias("r_label")).agg(vec.alias("r_vec"))


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda acc, v: acc + v)


REQUESTS_AT_ONCE = 1_000


def dense_topk(vecs: DataFrame, key: str, vec: str, reqs: DataFrame, k: int = 10) -> DataFrame:
    """Top-k cosine of every request ``(r_label, r_vec)`` against all vectors.
    Vectors stay arrays: a block of requests is one broadcast row, scored
    within each vector's row, and Spark limits a request's rows before its
    exchange."""
    reqs, n = materialize(reqs.withColumn("r_norm", F.sqrt(_dot(F.col("r_vec"), F.col("r_vec")))))
    x = vecs.select(key, F.col(vec).cast("array<double>").alias("_v"))
    x = x.withColumn("_n", F.sqrt(_dot(F.col("_v"), F.col("_v"))))
    blocks, found = max(1, -(-n // REQUESTS_AT_ONCE)), None
    for b in range(blocks):
        block = reqs.filter(F.pmod(F.xxhash64("r_label"), F.lit(blocks)) == b).agg(
            F.collect_list(F.struct("r_label", "r_vec", "r_norm")).alias("_reqs"))
        s = x.join(F.broadcast(block)).select(key, F.explode(F.transform("_reqs", lambda r: F.struct(
            r["r_label"].alias("r_label"),
            F.try_divide(_dot(F.col("_v"), r["r_vec"]), F.col("_n") * r["r_norm"]).alias("similarity")))).alias("_s"))
        s = s.select("_s.r_label", key, "_s.similarity")
        found = s if found is None else found.unionByName(s)
    w = Window.partitionBy("r_label").orderBy(F.round("similarity", 6).desc(), F.col(key))
    found = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return found.select("r_label", key, F.round("similarity", 6).alias("similarity"), "rank")


def lda_corpus(spark: SparkSession, sf: str, min_df: int = 10) -> tuple[DataFrame, DataFrame, int]:
    """Sparse count vectors per group (as many entries as the group has terms),
    the vocabulary ``term, idx`` and its size. Indexes are places in term
    order, from a range partitioning."""
    b, _ = materialize(bow(spark, sf, min_df))
    vocab, v = materialize(placed(b.select("term").distinct(), ["term"], out="idx").withColumn("idx", F.col("idx").cast("int")))
    m = b.join(vocab, "term").groupBy("venue", "year").agg(F.sort_array(F.collect_list(F.struct("idx", F.col("freq").cast("double").alias("x")))).alias("_m"))
    return _as_vectors(m.select("venue", "year", "_m"), v), vocab, v


def _as_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``_m``, sorted (index, value) pairs, as a sparse ``features`` vector: the
    columns of Spark ML's vector type are written and read back as one."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    keep = [c for c in rows.columns if c != "_m"]
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
                     F.transform("_m", lambda e: e["idx"]).alias("indices"), F.transform("_m", lambda e: e["x"]).alias("values"))
    x = rows.select(*keep, parts.alias("features"))
    path = scratch(rows.sparkSession)
    x.write.parquet(path)
    schema = StructType([f if f.name != "features" else StructField("features", VectorUDT()) for f in x.schema.fields])
    return rows.sparkSession.read.schema(schema).parquet(path)


def lda_fit(corpus: DataFrame, k: int = 10, max_iter: int = 100, seed: int = 0) -> LDA.TopicModel:
    """The topic model of ``corpus`` (:mod:`lda`)."""
    (model,) = LDA.models(LDA.documents(corpus), _size(corpus), k, (max_iter,), seed)
    return model


def _size(corpus: DataFrame) -> int:
    """Of the vocabulary, which every vector knows."""
    first = corpus.select("features").first()
    return first["features"].size if first else 0


def lda_steps(corpus: DataFrame, k: int = 10, steps: tuple[int, ...] = (1, 10, 100), seed: int = 0) -> DataFrame:
    """The likelihood bound while fitting: ``iterations, log_likelihood,
    log_perplexity`` of models after so many iterations (one row a step)."""
    docs = LDA.documents(corpus)
    at = sorted(set(steps))
    rows = {n: (n, *model.likelihood(docs)) for n, model in zip(at, LDA.models(docs, _size(corpus), k, tuple(at), seed), strict=True)}
    return corpus.sparkSession.createDataFrame([rows[n] for n in steps], "iterations int, log_likelihood double, log_perplexity double")


def topic_words(model: LDA.TopicModel, vocab: DataFrame, n: int = 8) -> DataFrame:
    """``topic, rank, term``: the ``n`` first words of every topic."""
    return vocab.join(small(model.describe(n)), "idx").select("topic", (F.col("rank") + 1).alias("rank"), "term")
