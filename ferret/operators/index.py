"""Fielded positional inverted index as DataFrames / parquet tables.

Layout (one row per field, term, document)::

    postings(field, bucket, term, doc_id, tf, flen, positions ARRAY<INT>)
    term_stats(field, term, df)
    corpus(n_docs, buckets)

Postings are stored by field and term bucket (a hash of the term modulo a
number that grows with the table), so a lookup prunes to the buckets of the
terms it asks for instead of reading a field whole.

``flen`` (field length after stop words) is stored on every posting so a
query needs no join to a per-document norm table.

Plan shape: the documents are hash-partitioned by ``doc_id`` once (a shuffle
of the compressed raw text, the smallest form of the data); tokenizing,
analysis, the per-document term grouping and the field length
(:mod:`postings`) then all run inside that partitioning without another
exchange. ``term_stats`` is a partial + final aggregation over postings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import analyze as A
from ..session import materialize, path_exists, scan_parallelism, table_path
from ..sources import tables
from . import postings as P

FIELDS = ("title", "content", "venue", "year", "authors")
# Bounds keep the number of folders (fields x buckets) listable.
BUCKET_BYTES, MIN_BUCKETS, MAX_BUCKETS = 64 << 20, 8, 4096
FILTER_TERMS = 10_000
POSTING = ("field", "bucket", "term", "doc_id", "tf", "flen", "positions")


@dataclass
class Index:
    postings: DataFrame
    term_stats: DataFrame
    corpus: DataFrame  # one row: n_docs
    buckets: int
    path: str | None = None  # folder of a stored index
    parts: dict[str, DataFrame] = field(default_factory=dict)

    def part(self, name: str, make: Callable[[], DataFrame], folders: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
        """A table derived from the index, built when first asked for and stored
        beside the postings, in ``folders`` and sorted by ``order`` if given (a
        lazy index stores it for the session)."""
        if name not in self.parts:
            spark = self.postings.sparkSession
            if self.path is None:
                self.parts[name] = materialize(make())[0]
            else:
                path = f"{self.path}/{name}"
                if not path_exists(spark, path):
                    x = make()
                    if folders:
                        x = x.hint("rebalance", *folders).sortWithinPartitions(*folders, *order)
                    w = x.write.mode("overwrite")
                    (w.partitionBy(*folders) if folders else w).parquet(path)
                self.parts[name] = spark.read.parquet(path)
        return self.parts[name]

    def lookup(self, terms: DataFrame) -> DataFrame:
        """Postings of at least the column ``term`` of ``terms``: join them on it
        too. Where the terms are few their values are a filter of the scan, so
        other postings go before a key is made of them; all stay where they are many."""
        few = [r[0] for r in terms.select("term").filter("term IS NOT NULL").distinct().limit(FILTER_TERMS + 1).collect()]
        return self.postings.filter(F.col("term").isin(few)) if len(few) <= FILTER_TERMS else self.postings

    def bucketed(self, terms: DataFrame) -> DataFrame:
        """``terms`` plus the bucket of each ``term``: join postings on it too."""
        return terms.withColumn("bucket", bucket_of(F.col("term"), self.buckets))


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def bucket_count(docs: DataFrame) -> int:
    """At least one bucket per 64 MB of documents."""
    return max(MIN_BUCKETS, min(MAX_BUCKETS, scan_parallelism(docs, BUCKET_BYTES)))


def _postings_from_tokens(tok: DataFrame) -> DataFrame:
    """Tokens hash-partitioned by doc_id -> postings, no further exchange."""
    p = (tok.groupBy("doc_id", "field", "term")
         .agg(F.count(F.lit(1)).cast("int").alias("tf"),
              F.sort_array(F.collect_list("pos")).alias("positions")))
    w = Window.partitionBy("doc_id", "field")
    p = p.withColumn("flen", F.sum("tf").over(w).cast("int"))
    return p.select("field", "term", "doc_id", "tf", "flen", "positions")


def _by_doc(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt by document, those of a document side by side."""
    return rows.repartition(partitions or scan_parallelism(rows), "doc_id").sortWithinPartitions("doc_id")


def _array_postings(d: DataFrame, an: dict[str, A.Analyzer | None]) -> DataFrame:
    """Postings of the columns ``an``, arrays of words of :func:`_by_doc` rows:
    each field by its analyzer, or as it is (``None``)."""
    plain = {f: a for f, a in an.items() if a is None or not (a.stemming or a.filters)}
    parts = []
    if plain:
        cased = [F.transform(f, a.cased).alias(f) if a else F.col(f) for f, a in plain.items()]
        parts.append(P.of_arrays(d.select("doc_id", *cased), {f: a.stop_list if a and a.stopwords else () for f, a in plain.items()}))
    for f in an.keys() - plain.keys():
        parts.append(P.of_terms(A.analyze_tokens(P.words(d.select("doc_id", f), f), an[f]), f))
    return reduce(DataFrame.unionByName, parts)


def postings_of_records(rec: DataFrame, title_an: A.Analyzers = A.DEFAULT_TITLE,
                        partitions: int | None = None) -> DataFrame:
    """Postings of ``doc_id, title, content, venue, year`` and, where the table
    has it, ``authors`` (array<string>, positions continue across values);
    ``doc_id`` of any type. Titles and the other fields are grouped in
    doc_id-partitioned branches (the title branch shuffles only the titles,
    about one percent of the text), without a further exchange. The year is
    not tokenized."""
    an = A.by_field(title_an)
    own = lambda *fields: {f: an.get(f, A.STANDARD) for f in fields}
    cut = lambda f: A.tokenize(F.col(f)).alias(f)
    post = _array_postings(_by_doc(rec.select("doc_id", "title"), partitions).select("doc_id", cut("title")), own("title"))
    d = _by_doc(rec.select("doc_id", "content", "venue", "year"), partitions)
    d = d.select("doc_id", cut("content"), cut("venue"), F.when(F.col("year").isNotNull(), F.array("year")).alias("year"))
    post = post.unionByName(_array_postings(d, own("content", "venue") | {"year": None}))
    if "authors" in rec.columns:
        d = _by_doc(rec.select("doc_id", "authors"), partitions)
        d = d.select("doc_id", F.flatten(F.transform("authors", A.tokenize)).alias("authors"))
        post = post.unionByName(_array_postings(d, own("authors")))
    return post


def postings_of_documents(docs: DataFrame, title_an: A.Analyzers = A.DEFAULT_TITLE,
                          partitions: int | None = None) -> DataFrame:
    """Postings of any documents table (batch or a micro-batch)."""
    rec = docs.select("doc_id", tables.title_col().alias("title"), F.col("text").alias("content"),
                      F.col("source").alias("venue"), F.col("lang").alias("year"))
    return postings_of_records(rec, title_an, partitions)


def index_records(rec: DataFrame, title_an: A.Analyzers = A.DEFAULT_TITLE) -> Index:
    """Lazy index of records (``id, title, content, authors, year, venue``),
    as :func:`ferret.sources.xml.clean_records` gives them."""
    rec = rec.withColumnRenamed("id", "doc_id")
    n = bucket_count(rec)
    post = postings_of_records(rec, title_an).withColumn("bucket", bucket_of(F.col("term"), n))
    count = rec.agg(F.count(F.lit(1)).alias("n_docs"), F.lit(n).alias("buckets"))
    return Index(post, term_stats(post), count, n)


def author_tokens(spark: SparkSession, sf_dir: str, an: A.Analyzers = A.DEFAULT_TITLE) -> DataFrame:
    """Analyzed tokens of the multi-valued authors field; positions continue
    across values (gap 0), partitioned by doc_id."""
    a = tables.authors(spark, sf_dir)
    a = a.repartition(scan_parallelism(a), "doc_id")
    a = a.withColumn("_n", F.size(A.tokenize(F.col("author"))))
    w = Window.partitionBy("doc_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    tok = a.select("doc_id", F.lit("authors").alias("field"),
                   F.posexplode(A.tokenize(F.col("author"))).alias("pos", "tok"), "_off")
    tok = tok.withColumn("pos", (F.col("pos") + F.col("_off")).cast("int")).drop("_off")
    return A.analyze_tokens(tok, A.by_field(an).get("authors", A.STANDARD)).select("doc_id", "field", "pos", "term")


def build(spark: SparkSession, sf_dir: str, title_an: A.Analyzers = A.DEFAULT_TITLE) -> Index:
    """Lazy index DataFrames straight from the tables."""
    docs = tables.table(spark, sf_dir, "documents")
    post = postings_of_documents(docs, title_an).unionByName(_postings_from_tokens(author_tokens(spark, sf_dir, title_an)))
    n = bucket_count(docs)
    post = post.withColumn("bucket", bucket_of(F.col("term"), n))
    return Index(post, term_stats(post), corpus(spark, sf_dir).withColumn("buckets", F.lit(n)), n)


def term_stats(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs"))


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Path, length and time of every file of the source tables, from the
    file system that Spark reads them with (any URI)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for name in ("documents", "conversations"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            parts += [f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(path)]
    return "|".join(sorted(parts))


def write(ix: Index, path: str) -> None:
    """Write postings and, beside them, the statistics."""
    write_postings(ix.postings, f"{path}/postings")
    # stats from the written postings (no second pass over the raw text)
    spark = ix.postings.sparkSession
    written = spark.read.parquet(f"{path}/postings")
    term_stats(written).write.mode("overwrite").partitionBy("field").parquet(f"{path}/term_stats")
    ix.corpus.write.mode("overwrite").parquet(f"{path}/corpus")
    # commit marker last
    ix.corpus.limit(0).write.mode("overwrite").parquet(path + "/_done")


def write_postings(post: DataFrame, path: str) -> None:
    """Term-sorted files in folders by field and bucket. ``rebalance`` brings a
    bucket's postings together and lets the adaptive planner split a bucket
    with a hot term over several tasks and join small ones."""
    (post.hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", "term", "doc_id")
     .write.mode("overwrite").partitionBy("field", "bucket").parquet(path))


def read(spark: SparkSession, path: str) -> Index:
    post = spark.read.parquet(f"{path}/postings")
    ts = spark.read.parquet(f"{path}/term_stats")
    corpus = spark.read.parquet(f"{path}/corpus")
    return Index(post.select(*POSTING), ts.select("field", "term", "df"), corpus, corpus.first()["buckets"], path)


def open_index(spark: SparkSession, sf_dir: str, title_an: A.Analyzers = A.DEFAULT_TITLE) -> Index:
    """Index of ``sf_dir`` stored under the shared checkpoint folder; built
    once (lineage cut by the written table), then read back."""
    path = table_path(spark, "index", _fingerprint(spark, sf_dir), A.key_of(title_an), "v2")
    if not path_exists(spark, path + "/_done"):
        write(build(spark, sf_dir, title_an), path)
    return read(spark, path)


def fetch(ix: Index, hits: DataFrame, records: Callable[[], DataFrame]) -> DataFrame:
    """``hits`` (``doc_id``, few: counted before they are broadcast) with the
    stored fields of their documents. Stored fields lie in folders by a hash of
    the id, sorted by id, so the scan is pruned to the folders asked for."""
    from ..session import small

    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ix.buckets)).cast("int")
    stored = ix.part("stored", lambda: records().withColumn("bucket", bucket), ["bucket"], ["doc_id"])
    return stored.join(small(hits.withColumn("bucket", bucket)), ["bucket", "doc_id"])
