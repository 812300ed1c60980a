"""Range coder round trips and token files against plain encoding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferret.llm import idcoder, tokenfile
from ferret.llm.common import run_dir


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(1, 40))
def test_round_trip(ids, times):
    ids = np.array(ids * times, np.int64)
    words, crcs, code = idcoder.encode(ids, 301)
    assert (idcoder.decode(len(ids), 301, words, crcs, code) == ids).all()


def test_repeats_shrink_and_damage_is_seen():
    ids = np.tile([5, 9, 7, 40_000], 5000)
    words, crcs, code = idcoder.encode(ids, 49_408)
    assert len(code) < len(ids) // 8
    broken = bytearray(code)
    broken[len(code) // 2] ^= 64
    with pytest.raises(ValueError):
        idcoder.decode(len(ids), 49_408, words, crcs, bytes(broken))


TEXTS = [None, "", "Plain words, and Größe; naïve café.", "x" * 3000, "it's 'tis don't 3.14 <|endoftext|> a<|startoftext|>b",
         "é ö nb sp \x1c \x85 İstanbul ΣΑΣ \U0001f600", "tab\tnew\nline\r\nend " * 50, "same", "same"]


def test_files_match_plain_encoding(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfile, "GROUP", 100)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = [(k - 1 if k else None, t, k) for k, t in enumerate(TEXTS)] + [(3, "again", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    out = run_dir(spark, "ids-test")
    tokenfile.write(df, out, path)
    got = sorted(tokenfile.read(spark, out).collect(), key=lambda r: r.start)
    want = sorted(((d, t or "") for d, t, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    at = 0
    assert len(got) == len(want)
    for r, (d, t) in zip(got, want, strict=True):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) == (d, at, len(ids), zlib.crc32(raw))
        at += len(ids)


def test_empty_table(spark):
    out = run_dir(spark, "ids-test")
    tokenfile.write(spark.createDataFrame([], "doc_id long, text string"), out, public_tokenizers.path("word_bpe_49k.json"))
    assert tokenfile.read(spark, out).count() == 0


def test_blocks_are_independent():
    """A block's code is the same alone and among others."""
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 60, 3 * idcoder.BLOCK + 100)
    words, crcs, code = idcoder.encode(ids, 500)
    at = 0
    for k, block in enumerate(np.split(ids, np.arange(1, 4) * idcoder.BLOCK)):
        one = idcoder.encode(block, 500)
        assert (one[0][0], one[1][0]) == (words[k], crcs[k]) and one[2] == code[4 * at:4 * (at + words[k])]
        assert (idcoder.decode(len(block), 500, *one) == block).all()
        at += words[k]
