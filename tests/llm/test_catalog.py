"""Oracle text, plain encodings and edges of the row-wise operators."""

import base64

import public_tokenizers
import pytest
import tiktoken

from ferret.llm import bpe, catalog, langid, quality, urls
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare


@pytest.mark.parametrize("name", ["op7_quality_rules", "op8_url_filter"])
def test_matches_oracle(spark, name):
    s, d, *_ = compare(spark, catalog.QUERIES[name], catalog.SQL[name], SF_SMALL)
    assert s == d


def test_bpe_pieces():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.ByteBPE(bpe.read_ranks(path), public_tokenizers.PATTERN)
    texts = ["", "plain words", "aaaaaaaaaaaaaaaaaaaa", "é☃ 漢字 \U0001f600", "it's  3.14\n\n x", "q" * 500, "<|endoftext|>"]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == enc.encode_ordinary(t) and own.decode(ids) == t.encode()


def test_edges(spark):
    df = spark.createDataFrame([(None, None, None)], "doc_id long, text string, ledger string")
    assert quality.keep_clean(df).count() == 0
    assert urls.split_url(None) == ("", "") and urls.split_url("x://A.b?c/d") == ("a.b", "")
    assert langid.Profiles([]).predict("abc") == ("und", 0.0)
