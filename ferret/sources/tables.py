"""Scans of the given parquet tables and the records view over them.

``records`` is the bibliographic record of the search engine, mapped onto the
driver tables: id = documents.doc_id, title = first line of the text,
content = whole text, venue = source, year (untokenized facet) = lang, and
authors (multi-valued, ordered) = the turns of the conversation with the
same id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def title_col(text: str = "text"):
    """First line of the text (the record title)."""
    return F.substring_index(F.col(text), "\n", 1)


TITLE_SQL = "split_part(text, chr(10), 1)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fields of every record: ``doc_id, title, venue, year``."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", title_col().alias("title"), F.col("source").alias("venue"),
                    F.col("lang").alias("year"))


RECORDS_SQL = (f"SELECT doc_id, {TITLE_SQL} AS title, source AS venue, lang AS year "
               "FROM documents")


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-valued authors in order: ``doc_id, turn, author``."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc_id"), "turn", F.col("text").alias("author"))
