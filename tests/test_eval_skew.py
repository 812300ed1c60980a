"""Running ranks with a hot topic: the distributed prefix sum (range
partitions + per-piece offsets) equals a plain sort-and-cumsum."""

from pyspark.sql import functions as F

from ferret.operators import evaluate as E


def test_running_ranks_hot_topic(spark):
    rows = [(1, i, float((i * 7919) % 1000) / 10.0, int(i % 3 == 0)) for i in range(6000)]
    rows += [(2, i, float(i), int(i % 2 == 0)) for i in range(12)]
    j = spark.createDataFrame(rows, "topic int, doc_id long, score double, rel int")
    got = {(r.topic, r.doc_id): (r.rank, r.nrelevant) for r in E.running_ranks(j).collect()}
    want = {}
    for t in (1, 2):
        hs = sorted([r for r in rows if r[0] == t], key=lambda r: (-round(r[2], 6), r[1]))
        c = 0
        for k, r in enumerate(hs, start=1):
            c += r[3]
            want[(t, r[1])] = (k, c)
    assert got == want


def test_hot_topic_spans_partitions(spark):
    rows = [(1, i, float(i % 97), 0) for i in range(4000)]
    j = spark.createDataFrame(rows, "topic int, doc_id long, score double, rel int")
    s = j.withColumn("_s6", F.round("score", 6)).repartitionByRange(8, "topic", F.col("_s6").desc(), "doc_id")
    pieces = s.select(F.spark_partition_id().alias("p")).distinct().count()
    assert pieces > 1  # one topic is spread over several tasks, not one
