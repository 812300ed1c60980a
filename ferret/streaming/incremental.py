"""Incremental indexing with Structured Streaming.

New document files arriving in a folder are read as a stream; every
micro-batch is analyzed by the same plan as the batch build and its
postings are appended to the postings table (postings are per document, so
an append is exactly the new documents' part of the index). Term statistics
are aggregates over the postings table and stay correct on read.
``foreachBatch`` may run a batch again after a failure; each batch therefore
writes folders of its own, named by its number and overwritten by a replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import analyze as A
from ..operators import index as I

DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
BUCKETS = 64  # of a streamed index, whose final size is not known


def start(spark: SparkSession, source_dir: str, index_path: str, checkpoint: str,
          title_an: A.Analyzers = A.DEFAULT_TITLE, available_now: bool = True):
    """Start the indexing stream; returns the ``StreamingQuery``."""
    docs = spark.readStream.schema(DOC_SCHEMA).parquet(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        post = I.postings_of_documents(batch, title_an).withColumn("bucket", I.bucket_of(F.col("term"), BUCKETS))
        I.write_postings(post, f"{index_path}/postings/epoch={epoch_id}")
        batch.select("doc_id").write.mode("overwrite").parquet(f"{index_path}/documents/epoch={epoch_id}")

    w = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read(spark: SparkSession, index_path: str) -> I.Index:
    """The streamed index with statistics derived from its postings."""
    post = spark.read.parquet(f"{index_path}/postings").select(*I.POSTING)
    corpus = spark.read.parquet(f"{index_path}/documents").agg(F.count(F.lit(1)).alias("n_docs"))
    return I.Index(post, I.term_stats(post), corpus, BUCKETS)
