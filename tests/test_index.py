"""The stored index: term buckets prune the scan, results do not depend on them."""

from ferret.operators import index as I
from ferret.operators import search as S
from ferret.plans import querysets as QS
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_lookup_prunes_buckets(spark):
    ix = I.open_index(spark, SF_SMALL)
    one = S.search(ix, QS.keyword(spark, SF_SMALL).limit(1))
    scans = [x for x in _plan(one).split("\n\n") if "/postings]" in x]
    assert len(scans) == 1 and "positions" not in scans[0]
    pruned = next(x for x in scans[0].splitlines() if x.startswith("PartitionFilters"))
    assert "dynamicpruning" in pruned and "bucket" in pruned


def test_every_posting_is_in_its_bucket(spark):
    ix = I.open_index(spark, SF_SMALL)
    assert ix.postings.filter(ix.postings.bucket != I.bucket_of(ix.postings.term, ix.buckets)).isEmpty()
    assert ix.postings.drop("bucket").exceptAll(I.build(spark, SF_SMALL).postings.drop("bucket")).isEmpty()


def test_bucket_count_does_not_change_hits(spark, tmp_path):
    a = I.open_index(spark, SF_SMALL)
    b = I.build(spark, SF_SMALL)
    post = b.postings.withColumn("bucket", I.bucket_of(b.postings.term, 3))
    I.write(I.Index(post, b.term_stats, b.corpus.selectExpr("n_docs", "3 AS buckets"), 3), str(tmp_path))
    c = I.read(spark, str(tmp_path))
    q = QS.phrase(spark, SF_SMALL).limit(20)
    assert c.buckets == 3 and S.search(a, q).collect() == S.search(c, q).collect()
