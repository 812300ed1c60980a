"""Retrieval evaluation and test-collection pooling as set-based jobs.

Judgments (``qrels``) come from the data: a document is relevant to a
benchmark item when its text contains the item's passage. Candidates come
from the index (every containing document holds the passage's rarest
interior word), then ``contains`` verifies them: an exact equi-join, no
cross product of documents and passages.

Metrics follow the reference's loop: running precision / recall / F1 over
the ranked hits, stop at the first rank with recall 1, metrics at
``min(k, N)``, R-precision at ``min(N, n_rel)`` (the last row when a topic
has no judgments), all NULL when nothing was retrieved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import analyze as A
from ..session import materialize, scan_parallelism, small
from ..sources import tables as T
from . import dictionary as D
from .index import Index

PASSAGES_AT_ONCE, PASSAGE_BYTES = 10_000, 32 << 20
RANKED_BYTES = 8 << 20  # of hits as written (about 3 bytes each), ranked in a task


def qrels_containment(spark: SparkSession, sf: str, ix: Index) -> DataFrame:
    """``(topic, doc_id)`` for every document whose text contains the
    passage of benchmark item ``topic``."""
    b = T.table(spark, sf, "benchmark").select(F.col("item_id").alias("topic"), F.col("text").alias("passage"))
    toks = A.explode_tokens(b, "passage", ["topic"])
    n = toks.groupBy("topic").agg(F.max("pos").alias("_last"))
    toks = toks.join(n, "topic")
    # interior words only: a passage's first / last word may be glued to
    # neighbouring characters inside a document
    inner = toks.filter((F.col("pos") > 0) & (F.col("pos") < F.col("_last")))
    inner = A.analyze_tokens(inner.withColumn("field", F.lit("content")), A.STANDARD)
    inner, _ = materialize(inner.select("topic", "term").distinct())
    ts = ix.term_stats.filter(F.col("field") == "content")
    known, _ = materialize(ts.join(small(inner), "term").select("topic", "term", "df"))
    w = Window.partitionBy("topic").orderBy(F.col("df").asc(), F.col("term").asc())
    rare, _ = materialize(ix.bucketed(known.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).select("topic", "term")))
    post = ix.lookup(rare).filter(F.col("field") == "content").select("bucket", "term", "doc_id")
    # the filter lets the scan be pruned to the buckets asked for
    cand, _ = materialize(post.join(small(rare.filter("bucket >= 0")), ["bucket", "term"]).select("topic", "doc_id"))
    docs = T.table(spark, sf, "documents").select("doc_id", "text")
    # texts stay where they are: few candidates go to them
    found = docs.join(small(cand), "doc_id").join(small(b), "topic").filter(F.col("text").contains(F.col("passage"))).select("topic", "doc_id")
    # passages without an indexed interior word (one or two words, or only stop
    # words inside): their edge words are parts of words of the document
    rest, _ = materialize(b.filter("passage IS NOT NULL").join(
        known.select("topic").distinct(), "topic", "left_anti").join(
        _impossible(inner, known), "topic", "left_anti"))
    edges, n = materialize(_edge_leaves(rest, toks))
    if n:
        cand, _ = materialize(D.documents(edges, ix).select(F.col("qid").alias("topic"), "doc_id").distinct())
        near = docs.join(small(cand), "doc_id").join(small(rest), "topic").filter(F.col("text").contains(F.col("passage")))
        found = found.union(near.select("topic", "doc_id"))
    # what is left has edge words like stop words, which are not indexed, or no
    # word at all: held against every document, a block of passages at a time
    rest, n = materialize(rest.join(edges.select(F.col("qid").alias("topic")), "topic", "left_anti"))
    if n:
        size = rest.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
        blocks = max(-(-n // PASSAGES_AT_ONCE), -(-size // PASSAGE_BYTES))
        for k in range(blocks):
            part = rest.filter(F.pmod(F.xxhash64("topic"), F.lit(blocks)) == k)
            found = found.union(docs.join(F.broadcast(part), F.col("text").contains(F.col("passage"))).select("topic", "doc_id"))
    return found.distinct()


def _edge_leaves(rest: DataFrame, toks: DataFrame) -> DataFrame:
    """Multi-term leaves of passages by an edge word: the last word begins a
    word of the document, the first one ends one, an only word is part of one.
    A word that a stop word could stand for is no use (stop words are not
    indexed), nor one whose lower case depends on its place in a word."""
    words = toks.groupBy("topic").agg(
        F.max("_last").alias("last"), F.max(F.when(F.col("pos") == 0, F.lower("tok"))).alias("w1"),
        F.max(F.when(F.col("pos") == F.col("_last"), F.lower("tok"))).alias("w2"),
        F.max(F.col("tok").contains("\u03a3")).alias("odd"))
    stops = F.array(*[F.lit(x) for x in A.STANDARD.stop_list])
    never = lambda f, w: ~F.exists(stops, lambda x: f(x, F.col(w)))
    leaf = lambda kind, term: F.struct(F.lit(kind).alias("kind"), term.alias("term"))
    star = F.lit("*")
    one = F.when(never(F.contains, "w1"), leaf("wildcard", F.concat(star, "w1", star)))
    two = F.when(never(F.startswith, "w2"), leaf("prefix", F.col("w2"))).when(never(F.endswith, "w1"), leaf("wildcard", F.concat(star, "w1")))
    x = rest.join(words, "topic").filter("NOT odd").withColumn("l", F.when(F.col("last") == 0, one).otherwise(two)).filter("l IS NOT NULL")
    return x.select(F.col("topic").alias("qid"), F.lit("q").alias("ga"), F.lit(0).alias("b"), F.lit(0).alias("c"), "l.kind", F.lit("content").alias("field"),
                    "l.term", F.lit(None).cast("string").alias("hi"), F.lit(None).cast("int").alias("edits"))


def _impossible(inner: DataFrame, known: DataFrame) -> DataFrame:
    """Topics with an interior word that no document has."""
    return inner.join(known, ["topic", "term"], "left_anti").select("topic").distinct()


QRELS_SQL = ("SELECT DISTINCT b.item_id AS topic, d.doc_id FROM benchmark b JOIN documents d "
             "ON contains(d.text, b.text)")


def running_ranks(j: DataFrame) -> DataFrame:
    """Rank and running relevant count per topic without a per-topic window.

    ``j``: ``topic, doc_id, score, rel``. All hits are range-partitioned by
    (topic, score desc, doc_id), so a topic with a huge hit list spans many
    partitions; rows are numbered where they lie, per (topic, partition) piece,
    and the counts of the topic's earlier pieces (a small table: one row per
    piece) are added: a distributed prefix sum, one exchange in all. The rows
    are written first, as the bounds of the ranges are drawn from them too.
    """
    s, _ = materialize(j.withColumn("_s6", F.round("score", 6)).drop("score"))
    order = [F.col("topic"), F.col("_s6").desc(), F.col("doc_id")]
    r = s.repartitionByRange(scan_parallelism(s, RANKED_BYTES), *order).sortWithinPartitions(*order)
    r = r.drop("_s6").withColumn("_pid", F.spark_partition_id())
    counts = [StructField(c, LongType()) for c in ("_lr", "_lrel")]
    r, _ = materialize(r.mapInArrow(_numbered, StructType([*r.schema.fields, *counts])))
    piece = r.groupBy("topic", "_pid").agg(F.max("_lr").alias("_n"), F.max("_lrel").alias("_nr"))
    wp = Window.partitionBy("topic").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off, _ = materialize(piece.select("topic", "_pid", F.coalesce(F.sum("_n").over(wp), F.lit(0)).alias("_off"),
                                      F.coalesce(F.sum("_nr").over(wp), F.lit(0)).alias("_roff")))
    out = r.join(small(off), ["topic", "_pid"])
    return out.select("topic", "doc_id", "rel", (F.col("_lr") + F.col("_off")).alias("rank"),
                      (F.col("_lrel") + F.col("_roff")).alias("nrelevant"), *[c for c in j.columns
                                                                              if c not in ("topic", "doc_id",
                                                                                           "rel", "score")])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their topics with their number in the topic and
    the relevant ones up to there."""
    topic, n, n_rel = None, 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        code = b.column("topic").dictionary_encode().indices.to_numpy()
        rel = b.column("rel").to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        size = np.diff(np.r_[first, len(code)])
        upto = np.cumsum(rel)
        rank = np.arange(1, len(code) + 1) - np.repeat(first, size)
        nrelevant = upto - np.repeat(upto[first] - rel[first], size)
        if b.column("topic")[0].as_py() == topic:  # goes on from the batch before
            rank[: size[0]] += n
            nrelevant[: size[0]] += n_rel
        topic, n, n_rel = b.column("topic")[-1].as_py(), int(rank[-1]), int(nrelevant[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank), pa.array(nrelevant)], [*b.schema.names, "_lr", "_lrel"])


def contains_relevance(hits: DataFrame, qrels: DataFrame) -> DataFrame:
    """The reference's original rule: a hit is relevant when some judged
    document of its topic contains the hit's id as a substring. Judged ids
    (short strings) are taken apart, so hits join on topic and substring."""
    h = hits.select(F.col("qid").alias("topic"), "doc_id", F.col("doc_id").cast("string").alias("_part"))
    q = qrels.select("topic", F.col("doc_id").cast("string").alias("_j")).filter(F.length("_j") > 0)
    parts = F.flatten(F.transform(F.sequence(F.lit(1), F.length("_j")), lambda i: F.transform(
        F.sequence(F.lit(1), F.length("_j") - i + 1), lambda n: F.substring(F.col("_j"), i, n))))
    q = q.select("topic", F.explode(F.array_distinct(parts)).alias("_part")).distinct()
    return h.join(small(q), ["topic", "_part"], "left_semi").select("topic", "doc_id").distinct()


def _until_recalled(j: DataFrame, nrel: DataFrame) -> DataFrame:
    """Hits that may be read: where a topic's relevant hits are as many as its
    judged documents, recall is 1 at the last of them or before, and the hits
    after it are not ranked."""
    place = F.struct((-F.round("score", 6)).alias("s"), F.col("doc_id").alias("d"))
    last = j.filter("rel = 1").groupBy("topic").agg(F.max(place).alias("_last"), F.count(F.lit(1)).alias("_n"))
    last, _ = materialize(last.join(nrel, "topic").filter("_n >= n_rel").select("topic", "_last"))
    # rounding moves a score by half a millionth; only near the last one it is asked for
    at = -F.col("_last.s")
    read = F.col("_last").isNull() | (F.col("score") > at + 1e-6) | ((F.col("score") >= at - 1e-6) & (place <= F.col("_last")))
    return j.join(small(last), "topic", "left").filter(read).drop("_last")


def curve(hits: DataFrame, qrels: DataFrame, rel: DataFrame | None = None) -> DataFrame:
    """Running metrics per rank up to the early stop: ``(topic, rank,
    doc_id, rel, n_rel, precision, recall, f1)``. ``rel`` overrides which
    hits count as relevant (default: judged (topic, doc_id) pairs)."""
    h = hits.withColumnRenamed("qid", "topic")
    nrel = qrels.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rel"))
    relset = qrels if rel is None else rel
    nrel, _ = materialize(nrel)
    relset, _ = materialize(relset.select("topic", "doc_id").withColumn("_rel", F.lit(1)))
    j = (h.join(small(relset), ["topic", "doc_id"], "left")
         .withColumn("rel", F.coalesce("_rel", F.lit(0))).drop("_rel"))
    j, _ = materialize(j.select("topic", "doc_id", "score", "rel"))
    j = running_ranks(_until_recalled(j, nrel))
    j = j.join(small(nrel), "topic", "left").withColumn(
        "n_rel", F.coalesce("n_rel", F.lit(0)))
    # the running count before this rank is nrelevant - rel (no lag window)
    j = j.filter((F.col("n_rel") == 0) | ((F.col("nrelevant") - F.col("rel")) < F.col("n_rel")))
    p = F.col("nrelevant") / F.col("rank")
    rc = F.when(F.col("n_rel") > 0, F.col("nrelevant") / F.col("n_rel"))
    f1 = F.when(p.isNull() | rc.isNull(), F.lit(None)).when(p + rc == 0, F.lit(0.0)).otherwise(2 * p * rc / (p + rc))
    return j.select("topic", "rank", "doc_id", "rel", "n_rel", F.round(p, 4).alias("precision"),
                    F.round(rc, 4).alias("recall"), F.round(f1, 4).alias("f1"), p.alias("_p"), rc.alias("_r"),
                    f1.alias("_f"))


def metrics(hits: DataFrame, qrels: DataFrame, topics: DataFrame, k: int = 10,
            rel: DataFrame | None = None) -> DataFrame:
    """One row per topic: ``N, k, nrelevant_gt, precision, recall, f1,
    r_precision`` (4 digits, NULL where undefined)."""
    c = curve(hits, qrels, rel).select("topic", "rank", "n_rel", "_p", "_r", "_f")  # rows are written by then, with their counts
    n, _ = materialize(c.groupBy("topic").agg(F.max("rank").alias("N"), F.first("n_rel").alias("_nrel")))
    # k = 0 reads the last row, a negative k counts from the end
    cut = F.least(F.lit(k), F.col("N")) if k > 0 else F.col("N") + min(k + 1, 0) if k < 0 else F.col("N")
    rp_rank = F.when(F.col("_nrel") == 0, F.col("N")).otherwise(F.least(F.col("N"), F.col("_nrel")))
    at = lambda here, col: F.round(F.max(F.when(F.col("rank") == here, F.col(col))), 4)
    read = c.join(small(n), "topic").filter((F.col("rank") == cut) | (F.col("rank") == rp_rank)).groupBy("topic").agg(
        at(cut, "_p").alias("precision"), at(cut, "_r").alias("recall"), at(cut, "_f").alias("f1"),
        at(rp_rank, "_p").alias("r_precision"))
    nrel = qrels.groupBy("topic").agg(F.count(F.lit(1)).alias("nrelevant_gt"))
    base = topics.select("topic").join(n.select("topic", "N"), "topic", "left").join(nrel, "topic", "left")
    out = base.join(read, "topic", "left")
    kk = F.when(F.col("N").isNull() | F.lit(k == 0), F.lit(k)).otherwise(cut)
    return out.select("topic", F.coalesce("N", F.lit(0)).cast("long").alias("N"), kk.cast("long").alias("k"),
                      F.coalesce("nrelevant_gt", F.lit(0)).cast("long").alias("nrelevant_gt"),
                      "precision", "recall", "f1", "r_precision")


def top_with_ties(hits: DataFrame, k: int = 10) -> DataFrame:
    """Hits whose score ties or beats the k-th best score of their topic."""
    w = Window.partitionBy("qid").orderBy(F.round("score", 6).desc())
    return hits.withColumn("rnk", F.rank().over(w)).filter(F.col("rnk") <= k)


POOL_SIZE = 300


def fill_pool(pool: DataFrame, ids: DataFrame, size: int = POOL_SIZE, seed: int = 0) -> DataFrame:
    """``doc_id, origin``: the pool and as many of the other ``ids``, in a
    pseudo-random order by ``seed``, as make ``size`` in all."""
    pool, n = materialize(pool.select("doc_id"))
    rest = ids.join(pool, "doc_id", "left_anti").orderBy(pool_sample_key("doc_id", seed)).limit(max(0, size - n))
    return pool.withColumn("origin", F.lit("pool")).unionByName(rest.withColumn("origin", F.lit("random")))


def pool_sample_key(col: str = "doc_id", seed: int = 0):
    """Deterministic pseudo-random order shared with the oracle."""
    return F.md5(F.concat(F.col(col).cast("string"), F.lit(str(seed))))
