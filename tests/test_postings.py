"""Postings grouped by numpy: the rows of the definition, on odd inputs too,
and no row per word on the way."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferret.functions import analyze as A
from ferret.operators import index as I
from ferret.operators import postings as P

KEEPS = A.Analyzer(lowercase=False, stemming=False, stopwords=False)
SHORT = A.Analyzer(stemming=True, filters=(("short", lambda c: F.when(F.length(c) < 9, c)),))
ROWS = [
    (1, "The running dogs' RUN of a dog", "Dogs and dog, the dog. don't 3.5 İstanbul ΣΣ naïve", "src", "en"),
    (1, "run runner running", "a second text of document one: dog dogs", "src", "en"),
    (2, None, None, None, None),
    (3, "", "the of and", "A b", "The"),
    (4, "relational relate relating conditionally", "x " * 40 + "y", "src", ""),
    (None, "no id", "two rows", "n", "en"),
    (None, "no id", "without an id", "n", "de"),
]


def by_rows(rec, an):
    """The definition: a row per word, grouped."""
    own, parts = A.by_field(an), []
    for f in ("title", "content", "venue"):
        t = A.explode_tokens(rec, f, ["doc_id"]).withColumn("field", F.lit(f))
        parts.append(A.analyze_tokens(t, own.get(f, A.STANDARD)).select("doc_id", "field", "pos", "term"))
    parts.append(rec.filter("year IS NOT NULL").select("doc_id", F.lit("year").alias("field"), F.lit(0).alias("pos"), F.col("year").alias("term")))
    tok = parts[0]
    for p in parts[1:]:
        tok = tok.unionByName(p)
    return I._postings_from_tokens(tok)


def listed(df):
    return sorted(map(tuple, df.select("field", "term", "doc_id", "tf", "flen", "positions").collect()), key=str)


@pytest.mark.parametrize("an", [A.DEFAULT_TITLE, KEEPS, {"title": SHORT, "content": A.DEFAULT_TITLE}, {"venue": KEEPS, "content": SHORT}])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_of_the_definition(spark, an, kind):
    rec = spark.createDataFrame(ROWS, "doc_id long, title string, content string, venue string, year string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = I.postings_of_records(rec, an)
    want = by_rows(rec, an)
    assert got.dtypes == want.dtypes
    assert listed(got) == listed(want) and len(listed(got)) > 20
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # documents go on over batches
    try:
        assert listed(I.postings_of_records(rec, an, 1)) == listed(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert I.postings_of_records(rec.limit(0), an).count() == 0


def test_words_are_not_rows(spark):
    rec = spark.createDataFrame(ROWS, "doc_id long, title string, content string, venue string, year string")
    plan = I.postings_of_records(rec, KEEPS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan and "Generate" not in plan
    assert plan.count("Exchange hashpartitioning") + plan.count("REPARTITION_BY") >= 2


def test_some_whole_documents_at_a_time(monkeypatch):
    """Groups end with a document; a word comes once a group, not as often as it stands there."""
    words = [["a", "b"], ["a"], [], ["c", "a", "a"], ["b"]] * 4
    ids = sorted(k // 2 for k in range(len(words)))
    rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(words)], ["doc_id", "t"])
    for at_once, groups in ((1, 10), (7, 5), (1000, 1)):
        monkeypatch.setattr(P, "WORDS_AT_ONCE", at_once)
        for step in (1, 3, 20):
            parts = list(P._documents([rows.slice(k, step) for k in range(0, 20, step)], ["t"]))
            assert [x for docs, d, _ in parts for x in docs.take(pa.array(d)).to_pylist()] == ids
            assert [w for *_, t in parts for w in t["t"].to_pylist()] == words
            seen = [set(docs.to_pylist()) for docs, *_ in parts]
            assert sum(map(len, seen)) == len(set.union(*seen)) == 10
            if step == 20:
                assert len(parts) <= groups + 1  # and the last document of a batch


def test_postings_leave_in_the_order_of_their_sort():
    """Term by term, as Spark orders strings (by byte), then by document: runs for the sort of the index."""
    terms = pa.array(["b", "é", "a", "z", "B", "ab"])
    d, term, pos = (pa.array(x).to_numpy() for x in ([0, 0, 1, 1, 1, 2, 2], [0, 1, 2, 0, 0, 4, 5], [0, 1, 0, 1, 2, 0, 3]))
    for in_order in (True, False):
        rows = P._rows("t", pa.array([7, 8, 9]), terms, d, term, pos, in_order).to_pydict()
        assert rows["term"] == sorted(rows["term"], key=str.encode) and list(zip(rows["term"], rows["doc_id"])) == [("B", 9), ("a", 8), ("ab", 9), ("b", 7), ("b", 8), ("é", 7)]
        assert rows["positions"] == [[0], [0], [3], [0], [1, 2], [1]] and rows["tf"] == [1, 1, 1, 1, 2, 1] and rows["flen"] == [2, 3, 2, 2, 3, 2]
