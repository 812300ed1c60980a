"""The pipeline against plain versions of its stages on a small table."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from ferret.llm import mixing
from ferret.llm.common import stored
from tests.llm import test_minhash, test_suffix

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(900)] + ["größe", "naïve"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    shared = text(40)
    out = [(k, text(rng.randrange(55, 120)) + ("\n" + shared if k % 4 == 0 else "") + " " + text(10)) for k in range(60)]
    near = out[7][1].split()
    near[10] = "changed"
    out += [(70, out[5][1]), (71, " ".join(near)), (72, "too short"), (73, None), (74, "same words again " * 40), (75, "#$ % & | " * 30 + text(60))]
    return [(d, t, "en", None if d % 9 == 0 else f"s{d % 4}", len(t or "")) for d, t in out]


def clean(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    hit = {p for k, g in enumerate(grams) if grams.count(g) > 1 for p in (k, k + 1, k + 2)}
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    lines = [x for x in (t or "").split("\n") if x.split()]
    dup = len(lines) - len(set(lines))
    return not (len(w) < 50 or 100 * len(hit) > 50 * len(w) or (10 * symbols > len(w) and symbols >= 10) or (len(lines) >= 4 and 2 * dup > len(lines)))


def test_stages_and_run(spark, tmp_path):
    table = rows()
    spark.createDataFrame(table, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [r for r in table if clean(r[1])]
    groups = test_minhash.brute([(r[0], r[1]) for r in kept], 5, 80)
    one = [r for r in kept if groups[r[0]][2]]
    assert len(one) < len(kept) < len(table)
    got = df
    for (name, stage), want in zip(corpus_pipeline.STAGES[:2], (kept, one), strict=False):
        got = stored(stage(spark, got, str(tmp_path)), name)
        assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in want), name
    cuts = {r.doc_id: r.text for r in corpus_pipeline.repeated_strings(spark, got, str(tmp_path)).collect()}
    plain = {x[0]: x for x in test_suffix.brute([(r[0], r[1]) for r in one])}
    for r in one:  # ASCII texts lose exactly the repeated bytes
        if r[1].isascii():
            assert hashlib.sha256(cuts[r[0]].encode()).hexdigest() == plain[r[0]][4]
        else:
            assert 0 <= len(cuts[r[0]].encode()) - (plain[r[0]][1] - plain[r[0]][2]) <= 4 * plain[r[0]][3]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in final) == sorted(cuts)
    for r in final:
        ids = enc.encode_ordinary(cuts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(cuts[r.doc_id].encode()).hexdigest()


def test_rows_carry_the_mixture(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "MIX_BLOCK", 4)
    spark.createDataFrame(rows(), COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
    want = {r.doc_id: r.position for r in mixing.schedule(docs, mixing.WEIGHTS, block=4).collect()}
    got = {r.doc_id: r.mix_position for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want and sorted(got.values()) == list(range(len(want)))


def test_place_of_split_and_empty_files(spark, tmp_path):
    df = spark.createDataFrame(rows(), COLUMNS)
    mixing.mixed(df, block=4).write.option("maxRecordsPerFile", 3).parquet(f"{tmp_path}/mixed")
    want = {r.doc_id: r.position for r in mixing.schedule(df, block=4).collect()}
    assert {r.doc_id: r.at for r in mixing.placed(spark.read.parquet(f"{tmp_path}/mixed"), "at").collect()} == want
    mixing.mixed(df.limit(0)).write.parquet(f"{tmp_path}/none")
    assert mixing.placed(spark.read.schema(df.schema).parquet(f"{tmp_path}/none")).collect() == []


def test_places_of_rows_that_no_mixture_wrote(spark, tmp_path):
    """In-memory rows and other files have no place; the stage still encodes them."""
    df = spark.createDataFrame(rows()[:20], COLUMNS)
    (tmp_path / "other").mkdir()
    import pyarrow.parquet as pq

    pq.write_table(df.toArrow(), f"{tmp_path}/other/some.parquet")
    for docs in (df, spark.read.parquet(f"{tmp_path}/other"), df.limit(0)):
        got = corpus_pipeline.encode_texts(spark, docs, str(tmp_path)).collect()
        assert len(got) == docs.count() and all(r.mix_position is None for r in got)


def test_run_with_nulls_repeats_clashes_and_nothing(spark, tmp_path):
    words = " ".join(f"w{k}" for k in range(80))
    odd = [(1, words, "en", "s", 3), (1, words, "en", "s", 3), (1, words + " more", None, None, None), (None, words[::-1], "en", "s", 1),
           (2, None, "en", "s", 0), (3, "", "en", "s", 0), (None, None, None, None, None)]
    for name, table in (("odd", odd), ("none", [])):
        df = spark.createDataFrame([(*r, 7, "x", "y") for r in table], f"{COLUMNS}, mix_block int, __rid string, block string")
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        # the near copies of document 1 are one group, texts without 50 words go
        assert sorted(str(r.doc_id) for r in got) == (["1", "None"] if table else [])
        assert sorted(r.mix_position for r in got) == list(range(len(got)))
