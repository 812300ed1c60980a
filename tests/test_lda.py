"""The topic model against Spark ML's on the same weights, and what it sends to the driver."""

import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from ferret.operators import lda
from ferret.operators import similar as SIM

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SIZE = 60


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    themes = rng.dirichlet(np.full(SIZE, 0.1), 3)
    rows = []
    for g in range(40):
        words = rng.choice(SIZE, 80, p=rng.dirichlet(np.full(3, 0.3)) @ themes)
        idx, n = np.unique(words, return_counts=True)
        rows.append((g, Vectors.sparse(SIZE, idx.tolist(), n.astype(float).tolist())))
    rows += [(40, Vectors.sparse(SIZE, [], [])), (41, Vectors.dense(np.eye(SIZE)[7] * 5))]
    return spark.createDataFrame(rows, T.StructType([T.StructField("g", T.IntegerType()), T.StructField("features", VectorUDT())]))


def test_equals_spark_ml_on_the_same_weights(spark, corpus):
    theirs = LDA(k=3, maxIter=30, seed=4, optimizer="online").fit(corpus)
    weights = theirs.topicsMatrix().toArray()
    eta, scale = 1 / 3, 0.25
    own = spark.createDataFrame([(i, *(float(x - eta) / scale for x in w)) for i, w in enumerate(weights)], lda._schema(3))
    sums = ((weights - eta) / scale).sum(axis=0)
    ours = lda.TopicModel(own, sums, theirs.estimatedDocConcentration().toArray(), eta, SIZE, scale)
    bound, perplexity = ours.likelihood(lda.documents(corpus))
    assert bound == pytest.approx(theirs.logLikelihood(corpus), rel=1e-4)
    assert perplexity == pytest.approx(theirs.logPerplexity(corpus), rel=1e-4)
    want = {r.g: r.x for r in theirs.transform(corpus).select("g", vector_to_array("topicDistribution").alias("x")).collect()}
    got = {r.g: r.topicDistribution for r in ours.transform(corpus).collect()}
    assert sorted(got) == sorted(want) and got[40] == [0, 0, 0]
    for g in want:
        assert got[g] == pytest.approx(want[g], abs=5e-3)
    words = {r.topic: r.termIndices for r in theirs.describeTopics(6).collect()}
    said = sorted(map(tuple, ours.describe(6).select("topic", "rank", "idx").collect()))
    assert said == [(t, k, i) for t in sorted(words) for k, i in enumerate(words[t])]


def test_learns_as_well_as_spark_ml(corpus):
    ends = [next(lda.models(lda.documents(corpus), SIZE, 3, (15,), s)).likelihood(lda.documents(corpus))[0] for s in (1, 2)]
    theirs = [LDA(k=3, maxIter=15, seed=s, optimizer="online").fit(corpus).logLikelihood(corpus) for s in range(6)]
    assert np.mean(ends) == pytest.approx(np.mean(theirs), rel=0.05)


def test_does_not_depend_on_partitions_and_keeps_sums(spark, corpus):
    a, b = (SIM.lda_fit(c, k=3, max_iter=6, seed=2) for c in (corpus.coalesce(1), corpus.repartition(7)))
    x, y = (np.array(sorted(map(tuple, m.topics.collect()))) for m in (a, b))
    assert len(x) == SIZE and x == pytest.approx(y, rel=1e-6)
    assert a.sums == pytest.approx(x[:, 1:].sum(axis=0)) and a.alpha == pytest.approx(b.alpha)


def test_topics_are_not_sent_to_the_driver(tmp_path):
    """Results of a job may hold 1 MB here; the topics have 8 MB."""
    code = textwrap.dedent(f"""
        import numpy as np
        from pyspark.sql import SparkSession, types as T
        from pyspark.ml.linalg import Vectors, VectorUDT
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.maxResultSize", "1m")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
        from ferret.operators import similar as SIM
        rng, size = np.random.default_rng(1), 100_000
        rows = [(g, Vectors.sparse(size, sorted(rng.choice(size, 500, replace=False).tolist()), [1.0] * 500)) for g in range(60)]
        kind = T.StructType([T.StructField("g", T.IntegerType()), T.StructField("features", VectorUDT())])
        model = SIM.lda_fit(spark.createDataFrame(rows, kind), k=10, max_iter=3)
        vocab = spark.range({100_000}).selectExpr("cast(id as int) idx", "concat('w', id) term")
        print("WORDS", SIM.topic_words(model, vocab).count())
    """)
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, env=os.environ | {"PYTHONPATH": REPO}, capture_output=True, text=True, timeout=300)
    assert "WORDS 80" in done.stdout, done.stderr[-3000:]
