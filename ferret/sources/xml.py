"""Semi-structured sources: bibliographic XML records, search-hit XML, TREC
topics, tab-separated judgments and one-per-line lists. Every reader
declares its schema (never inferred: a declared ``title STRING`` keeps inner
markup as text in document order). Records are read by a splittable scan that
cuts files at the key attribute, so a file of any size is many tasks; hits and
topics are small files, read by one task each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX

# Record row tags indexed, and hit types kept from a remote list.
RECORD_TAGS = ("article", "inproceedings")
HIT_TYPES = ("Conference and Workshop Papers", "Journal Articles")
# The attribute that every record begins with, and all record elements.
KEY = ' key="'
ALL_TAGS = ("article", "inproceedings", "proceedings", "book", "incollection", "phdthesis", "mastersthesis", "www",
            "person", "data")

RECORD_SCHEMA = T.StructType([
    T.StructField("_key", T.StringType()),
    T.StructField("author", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("booktitle", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

HIT_SCHEMA = T.StructType([
    T.StructField("_score", T.IntegerType()),
    T.StructField("_id", T.StringType()),
    T.StructField("info", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("authors", T.StructType([T.StructField("author", T.ArrayType(T.StringType()))])),
        T.StructField("venue", T.StringType()),
        T.StructField("pages", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
    ])),
])

TOPIC_SCHEMA = T.StructType([
    T.StructField("num", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("query", T.StringType()), T.StructField("desc", T.StringType()),
    T.StructField("narr", T.StringType()),
])

QRELS_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("iteration", T.StringType()),
    T.StructField("document", T.StringType()), T.StructField("relevancy", T.StringType()),
])


def _record_texts(spark: SparkSession, path: str, tags: tuple[str, ...], encoding: str) -> DataFrame:
    """``tag, xml``: the text of each record element of ``tags``; ``tag`` is null
    where a record is never closed. Elements without a key lie behind the
    record before them."""
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    # a few files may write the attribute otherwise; their rows are cut again
    pieces = F.split(value, r"\skey\s*=\s*(?=['\"])")
    rows = spark.read.option("lineSep", KEY).text(path).select(F.posexplode(pieces).alias("n", "p"))
    # the separator takes the opening quote with it
    rows = rows.select(F.when(F.col("n") > 0, F.substring("p", 2, 1 << 30)).otherwise(F.col("p")).alias("p"))
    names = "|".join(tags)
    end = rf"</({'|'.join(ALL_TAGS)})\s*>"
    key, tag = F.regexp_extract("p", "^([^<>\"']*)[\"']", 1), F.regexp_extract("p", end, 1)
    begins = F.regexp_like("p", F.lit("^[^<>\"']*[\"']"))
    body = F.regexp_replace(F.regexp_extract("p", rf"(?s)^[^\"']*[\"']([^>]*>.*?){end}", 1), r"^[^>]*>", "")
    keyed = F.when(begins & tag.isin(*tags), F.struct(tag.alias("tag"), F.concat(
        F.lit("<"), tag, F.lit(' key="'), key, F.lit('">'), body, F.lit("</"), tag, F.lit(">")).alias("xml")))
    torn = F.when(begins & (tag == "") & ~F.regexp_like("p", F.lit(r"^[^>]*/>")),
                  F.struct(F.lit(None).cast("string").alias("tag"), F.col("p").alias("xml")))
    rest = F.when(begins, F.regexp_replace("p", rf"(?s)^.*?{end}", "")).otherwise(F.col("p"))
    loose = F.transform(F.regexp_extract_all(rest, F.lit(rf"(?s)<(?:{names})\b[^>]*>.*?</(?:{names})\s*>"), 0),
                        lambda x: F.struct(F.regexp_extract(x, rf"^<({names})\b", 1).alias("tag"), x.alias("xml")))
    found = F.filter(F.concat(F.array(keyed, torn), loose), lambda x: x.isNotNull())
    return rows.select(F.explode(found).alias("r")).select("r.tag", "r.xml")


def read_xml_records(spark: SparkSession, path: str, tags=RECORD_TAGS, encoding: str = "UTF-8") -> DataFrame:
    """One row per record element of the given tags, whose other elements (e.g.
    ``book``) are left out, from one scan, with a ``tag`` column and the texts
    of all children in order as ``content``. Named character entities need no
    DTD. A record that cannot be parsed, or is never closed, keeps its own text in
    ``_corrupt_record`` and fails nothing."""
    x = _record_texts(spark, path, tuple(tags), encoding)
    x = x.withColumn("xml", TX.declare_entities(F.col("xml")))
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    x = x.withColumn("r", F.when(F.col("tag").isNotNull(), F.from_xml("xml", RECORD_SCHEMA.simpleString(), how)))
    texts = F.regexp_replace(TX.strip_markup(F.regexp_replace("xml", r"(?s)^<[^>]*>|</[^<]*>$", "")), "<[^>]*>", " ")
    content = TX.unescape(TX.decode_numeric(F.trim(F.regexp_replace(texts, r"\s+", " "))))
    corrupt = F.when(F.col("tag").isNull(), F.col("xml")).otherwise(F.col("r._corrupt_record"))
    return x.select(*[F.col(f"r.{f.name}").alias(f.name) for f in RECORD_SCHEMA if f.name != "_corrupt_record"],
                    corrupt.alias("_corrupt_record"), content.alias("content"), "tag")


def clean_records(raw: DataFrame) -> DataFrame:
    """Record -> stored fields: id, title (inline markup stripped, entities
    decoded), content (all texts in order), authors (in order), year, venue
    (journal or booktitle by tag)."""
    venue = F.when(F.col("tag") == "article", F.col("journal")).when(
        F.col("tag") == "inproceedings", F.col("booktitle")).otherwise(F.coalesce("journal", "booktitle"))
    return raw.select(F.nullif(F.col("_key"), F.lit("")).alias("id"), TX.unescape(TX.strip_markup(F.col("title"))).alias("title"),
                      "content", F.coalesce(F.col("author"), F.array().cast("array<string>")).alias("authors"),
                      "year", venue.alias("venue"), "tag", "_corrupt_record")


def split_rejects(rec: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reason``): a bad record is reported and
    skipped, the job goes on."""
    reason = (F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed"))
              .when(F.col("id").isNull(), F.lit("missing key"))
              .when(F.col("title").isNull() | (F.trim("title") == ""), F.lit("missing title")))
    r = rec.withColumn("reason", reason)
    return r.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record"), r.filter(F.col("reason").isNotNull())


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search-hit XML: ``(key, score, type)`` for hits of the kept types; the
    key is the record URL without its fixed-width prefix."""
    h = spark.read.format("xml").option("rowTag", "hit").schema(HIT_SCHEMA).load(path)
    h = h.filter(F.col("info.type").isin(list(HIT_TYPES)))
    return h.select(TX.url_key(F.col("info.url")).alias("key"), F.col("_score").alias("score"),
                    F.col("info.type").alias("type"))


def read_hit_totals(spark: SparkSession, path: str) -> DataFrame:
    """``file, total``: how many hits the remote search found, as each result
    file says it (more than it lists)."""
    h = spark.read.format("xml").option("rowTag", "hits").schema("_total BIGINT").load(path)
    return h.select(F.col("_metadata.file_path").alias("file"), F.col("_total").alias("total"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "top").schema(TOPIC_SCHEMA).load(path)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated judgments of all topics in one scan; values trimmed
    (files may carry a leading space) and cast; template rows with a
    non-numeric topic are dropped."""
    q = spark.read.option("sep", "\t").schema(QRELS_SCHEMA).csv(path)
    return q.select(F.trim("topic").try_cast("int").alias("topic"),
                    F.trim("iteration").try_cast("int").alias("iteration"),
                    F.trim("document").alias("document"), F.trim("relevancy").try_cast("int").alias("relevancy")
                    ).filter(F.col("topic").isNotNull())


def relevant(qrels: DataFrame) -> DataFrame:
    return qrels.filter(F.col("relevancy") == 1)


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """One value per non-empty line (pool keys, stop words)."""
    return spark.read.text(path).select(F.trim("value").alias(name)).filter(F.col(name) != "")
