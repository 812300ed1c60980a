"""Tables of queries derived from ``benchmark`` (every passage is a query),
in the shapes of the reference's test topics: free text, quoted phrase,
fielded, free text + facet. Each set exists as a Spark DataFrame
``(qid, query, adv)`` and as the oracle's unit rows ``(qid, u, field, text)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables as T

def _no_adv():
    return F.lit(None).cast("map<string,string>")


def _bench(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")


def keyword(spark, sf) -> DataFrame:
    return _bench(spark, sf).select("qid", F.col("text").alias("query"), _no_adv().alias("adv"))


KEYWORD_UNITS = "SELECT item_id AS qid, 0 AS u, 'content' AS field, trim(text) AS text FROM benchmark WHERE trim(text) <> ''"
QIDS = "SELECT item_id AS qid FROM benchmark"


def phrase(spark, sf) -> DataFrame:
    """The whole passage as one quoted phrase (quotes inside removed)."""
    q = F.concat(F.lit('"'), F.regexp_replace("text", '"', ""), F.lit('"'))
    return _bench(spark, sf).select("qid", q.alias("query"), _no_adv().alias("adv"))


PHRASE_UNITS = ("SELECT item_id AS qid, 0 AS u, 'content' AS field, "
                "'\"' || replace(text, '\"', '') || '\"' AS text FROM benchmark")


def fielded(spark, sf) -> DataFrame:
    """title: passage words (ORed) AND year: en."""
    adv = F.create_map(F.lit("title"), F.col("text"), F.lit("year"), F.lit("en"))
    return _bench(spark, sf).select("qid", F.lit("").alias("query"), adv.alias("adv"))


FIELDED_UNITS = ("SELECT item_id AS qid, 1 AS u, 'title' AS field, text FROM benchmark WHERE trim(text) <> '' "
                 "UNION ALL SELECT item_id AS qid, 2 AS u, 'year' AS field, 'en' AS text FROM benchmark")


def mixed(spark, sf) -> DataFrame:
    """Free text (SHOULD on content) + a required facet."""
    adv = F.create_map(F.lit("year"), F.lit("en"))
    return _bench(spark, sf).select("qid", F.col("text").alias("query"), adv.alias("adv"))


MIXED_UNITS = (KEYWORD_UNITS + " UNION ALL SELECT item_id AS qid, 1 AS u, 'year' AS field, 'en' AS text "
               "FROM benchmark")


def empty(spark, sf) -> DataFrame:
    """Queries with no word character at all (only the punctuation of each
    passage): every one must come back with zero hits."""
    q = F.regexp_replace("text", r"[\p{L}\p{N}_]", "")
    return _bench(spark, sf).select("qid", q.alias("query"), _no_adv().alias("adv"))


EMPTY_UNITS = ("SELECT item_id AS qid, 0 AS u, 'content' AS field, trim(regexp_replace(text, '[\\p{L}\\p{N}_]', '', 'g')) "
               "AS text FROM benchmark WHERE trim(regexp_replace(text, '[\\p{L}\\p{N}_]', '', 'g')) <> ''")


def with_words(spark, sf, words: DataFrame) -> DataFrame:
    """The passages, free of operator characters, plus ``words(qid, word)``."""
    q = keyword(spark, sf).withColumn("query", F.regexp_replace("query", r"[-+*?~^\[\]]", " "))
    w = words.groupBy("qid").agg(F.array_join(F.sort_array(F.collect_list("word")), " ").alias("w"))
    return q.join(w, "qid", "left").select("qid", F.concat_ws(" ", "query", "w").alias("query"), "adv")


def only_words(words: DataFrame) -> DataFrame:
    """Queries of ``words(qid, word)`` alone."""
    return words.groupBy("qid").agg(F.array_join(F.sort_array(F.collect_list("word")), " ").alias("query")).withColumn("adv", _no_adv())
