"""Writers: judgments and templates as TSV, listings and key lists as text,
metric reports as JSON, fitted topic models with their vocabulary and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def write_qrels(qrels: DataFrame, path: str, by_topic: bool = True) -> None:
    """``topic, iteration, document, relevancy`` tab separated, one folder per
    topic when ``by_topic``."""
    cols = [F.col(c).cast("string") for c in ("topic", "iteration", "document", "relevancy")]
    df = qrels.select(*cols, F.col("topic").alias("t")) if by_topic else qrels.select(*cols)
    w = df.write.mode("overwrite").option("sep", "\t")
    (w.partitionBy("t") if by_topic else w).csv(path)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def save_topics(path: str, model, vocab: DataFrame, groups: DataFrame) -> None:
    """One folder with the topic ``model``, its vocabulary (``term, idx``) and
    the names of the groups it was fitted on. ``_done`` is written last: a folder
    without it is no bundle."""
    model.save(f"{path}/model")
    vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
    groups.write.mode("overwrite").parquet(f"{path}/groups")
    vocab.limit(0).write.mode("overwrite").parquet(f"{path}/_done")


def load_topics(spark: SparkSession, path: str):
    """``model, vocabulary, groups`` of :func:`save_topics`."""
    from ..operators.lda import TopicModel

    if not path_exists(spark, f"{path}/_done"):
        raise FileNotFoundError(f"no complete topic model in {path}")
    return TopicModel.load(spark, f"{path}/model"), spark.read.parquet(f"{path}/vocabulary"), spark.read.parquet(f"{path}/groups")
