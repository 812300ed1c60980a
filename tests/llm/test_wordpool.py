"""Plain words stay in Arrow; the coder with large alphabets and damage."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ferret.llm import idcoder, tokenfile


@pytest.fixture(scope="module")
def json():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def _distinct(n: int) -> list[str]:
    return ["".join("etaoinshéü"[int(d)] for d in str(k)) for k in range(n)]


def test_plain_words_are_no_python_objects(json, monkeypatch):
    listed = []
    plain = tokenfile._listed
    monkeypatch.setattr(tokenfile, "_listed", lambda x: listed.append(len(x)) or plain(x))
    enc, words = tokenfile.WordEncoder(json), _distinct(20_000)
    text = " ".join(w.capitalize() + "..."[:k % 4] for k, w in enumerate(words))
    want = enc.tok.encode(text, add_special_tokens=False).ids
    assert enc.encode(pa.array([text]))[0].tolist() == want
    assert sum(listed) < 1000


def test_emptied_pool(json):
    enc, words = tokenfile.WordEncoder(json), _distinct(3000)
    enc.words.most = 500
    for a in range(0, 3000, 700):
        texts = [" ".join(words[a:a + 700]), "", "Straße!? 12,3 ª º µ × ÷ aª ÿ. .ab a.b it's", " ".join(words[:100])]
        want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in enc.encode(pa.array(texts))] == want
    assert len(enc.words.held[0]) < 2000


def test_runs_told_apart_one_by_one(json):
    enc = tokenfile.WordEncoder(json)
    enc.ends[:] = False  # no run's words are told apart
    texts = ["The quick brown fox, again", "zwölf"]
    assert [x.tolist() for x in enc.encode(pa.array(texts))] == [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("alphabet", [2, 70_000, 3_000_000])
def test_alphabets(alphabet):
    rng = np.random.default_rng(alphabet)
    n = 2 * idcoder.BLOCK + 1500
    ids = np.where(rng.random(n) < 0.5, rng.integers(0, min(alphabet, 40), n), rng.integers(0, alphabet, n))
    ids[::97] = alphabet - 1
    words, crcs, code = idcoder.encode(ids, alphabet)
    assert 4 * int(words.sum()) == len(code)
    assert (idcoder.decode(n, alphabet, words, crcs, code) == ids).all()


def test_any_damage_is_told():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 3000, 2 * idcoder.BLOCK + 77)
    words, crcs, code = idcoder.encode(ids, 49_408)
    for k in range(6):
        broken = np.frombuffer(code, np.uint8).copy()
        broken[rng.integers(0, len(code) * 9 // 10, 50)] ^= 255
        with pytest.raises(ValueError):
            idcoder.decode(len(ids), 49_408, words, crcs, bytes(broken))
