import math

from pyspark.sql import functions as F

from ferret.functions.scoring import idf_col, norm_col


def test_lossy_norm_goldens(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 16, 100)], "flen int")
    got = {r.flen: r.n for r in df.select("flen", norm_col(F.lit("title"), F.col("flen"), "lossy").alias("n")).collect()}
    assert got[1] == 1.0 and got[2] == 0.625 and got[3] == 0.5 and got[4] == 0.5 and got[5] == 0.4375
    assert got[16] == 0.25


def test_exact_norm_and_idf(spark):
    r = spark.range(1).select(norm_col(F.lit("content"), F.lit(4), "exact").alias("n"),
                              norm_col(F.lit("year"), F.lit(4), "exact").alias("y"),
                              idf_col(F.lit(9), F.lit(100)).alias("idf")).first()
    assert r.n == 0.5 and r.y == 1.0
    assert abs(r.idf - (1 + math.log(100 / 10))) < 1e-12
