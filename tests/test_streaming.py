"""The streaming indexer yields the same postings as the batch build."""

from pyspark.sql import functions as F

from ferret.operators import index as I
from ferret.streaming import incremental
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(3).write.parquet(src)
    q = incremental.start(spark, src, str(tmp_path / "ix"), str(tmp_path / "ck"))
    q.awaitTermination(300)
    ix = incremental.read(spark, str(tmp_path / "ix"))
    batch = I.postings_of_documents(docs)
    cols = ["field", "term", "doc_id", "tf", "flen", F.array_join("positions", ",").alias("p")]
    a = ix.postings.select(*cols)
    b = batch.select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert ix.corpus.first().n_docs == docs.count()


def test_replay_and_null_language(spark, tmp_path):
    """A batch written twice counts once; documents without a language count."""
    from unittest import mock

    rows = [(1, "alpha beta", "en", "s", 10), (2, "gamma", None, "s", 5), (3, None, None, None, None)]
    src, out = str(tmp_path / "in"), str(tmp_path / "ix")
    spark.createDataFrame(rows, incremental.DOC_SCHEMA).write.parquet(src)
    kept = []
    stream = type(spark.readStream.schema(incremental.DOC_SCHEMA).parquet(src).writeStream)
    real = stream.foreachBatch
    with mock.patch.object(stream, "foreachBatch", lambda self, f: real(self, lambda b, e: (f(b, e), f(b, e), kept.append(e)))):
        incremental.start(spark, src, out, str(tmp_path / "ck")).awaitTermination(300)
    ix = incremental.read(spark, out)
    assert kept and ix.corpus.first().n_docs == 3
    assert ix.postings.filter("term = 'alpha' AND field = 'content'").count() == 1
