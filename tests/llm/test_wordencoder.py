"""A worker's encoder serves its next tasks, with the same ids."""

import pyarrow as pa
import pytest
import public_tokenizers

from ferret.llm import tokenfile

TEXTS = pa.array(["Plain words, words again.", "", "a\tb\nc\r d  é naïve", "it's 12 #x zürich!", "plain WORDS"])


def _lists(enc):
    return [x.tolist() for x in enc.encode(TEXTS)]


def test_next_task_encodes_no_word_again(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        json = f.read()
    monkeypatch.setattr(tokenfile, "_LAST", [])
    want = [x.ids for x in tokenfile.WordEncoder(json).tok.encode_batch(TEXTS.to_pylist(), add_special_tokens=False)]
    assert _lists(tokenfile._encoder(json)) == want
    again = tokenfile._encoder(json)
    again.words.resolve = again.pool.resolve = lambda new: pytest.fail(f"encoded again: {new}")
    assert _lists(again) == want
    again.pool.numbers["left by a failed task"]
    assert _lists(tokenfile._encoder(json)) == want and tokenfile._encoder(json) is not again
