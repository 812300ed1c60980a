"""Nulls, empty and very long texts, repeated rows, empty tables and clashing
column names, for the operators that work row by row, against plain versions."""

import base64
import hashlib
import re
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ferret.llm import bpe, catalog, langid, quality, urls
from tests.conftest import SF_SMALL

LONG = "lorem ipsum dolor sit amet " * 60_000  # 1.6 million characters
TEXTS = [None, "", "   \n\t ", "12 34 !?", "plain words here", "größer als naïve cafés \U0001f600", LONG, "same row", "same row"]
COLUMNS = "doc_id long, text string, lang string, code string, `rank` string, ledger string, `__text` string, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k < 8 else 7, t, ("aa", "bb", None)[k % 3], "x", None, "y", "z", "w") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark, columns=COLUMNS):
    return spark.createDataFrame([], columns)


# ---------------------------------------------------------------- 1: language identification

def plain_grams(text):
    c = "\1" + "".join(x if unicodedata.category(x)[0] == "L" else "\1" for x in text.lower()) + "\1"
    code = lambda s: sum(ord(x) << 21 * (len(s) - 1 - i) for i, x in enumerate(s))
    out = Counter(code(x) for x in c if x != "\1")
    out.update(code(c[i:i + 2]) for i in range(len(c) - 1) if c[i:i + 2] != "\1\1")
    out.update(code(c[i:i + 3]) for i in range(len(c) - 2) if c[i + 1] != "\1")
    return out


def top(counts):
    return sorted(counts, key=lambda g: (-counts[g], g))[:langid.PROFILE]


def plain_predict(profiles, text):
    mine = top(plain_grams(text or ""))
    if not mine or not profiles:
        return "und", 0.0
    far = {}
    for lang, ranked in profiles.items():
        place = {g: k for k, g in enumerate(ranked)}
        far[lang] = sum(abs(place[g] - k) if g in place else langid.PROFILE for k, g in enumerate(mine))
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (langid.PROFILE * len(mine))


def test_language_matches_plain_version_and_held_out(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    got = {r.doc_id: r for r in catalog.QUERIES["op1_language_id"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    counts = {}
    for r in rows:
        if r.text is not None and r.lang is not None and not got[r.doc_id].held_out:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    profiles = {k: top(v) for k, v in counts.items()}
    for r in rows[:60]:
        lang, score = plain_predict(profiles, r.text)
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-12
    held = [r for r in rows if got[r.doc_id].held_out and r.lang is not None and r.text]
    assert held and sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_language_edges(spark, docs):
    profiles = langid.collect_profiles(langid.learn(docs))
    assert profiles.langs == ["aa", "bb"]
    got = langid.predict(docs, profiles, ["doc_id", "code", "rank"]).collect()
    assert len(got) == len(TEXTS) and got[0].code == "x"
    plain = {}
    for k, t in enumerate(TEXTS):
        if t is not None and k % 3 < 2:
            plain.setdefault(("aa", "bb")[k % 3], Counter()).update(plain_grams(t))
    plain = {k: top(v) for k, v in plain.items()}
    want = sorted(plain_predict(plain, t) for t in TEXTS)
    assert np.allclose([x[1] for x in want], [x[1] for x in sorted((r.lang_pred, r.score) for r in got)])
    assert sorted(x[0] for x in want) == sorted(r.lang_pred for r in got) and [x[0] for x in want].count("und") == 4
    none = langid.collect_profiles(langid.learn(empty(spark)))
    assert {r.lang_pred for r in langid.predict(docs, none, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(empty(spark), profiles, ["doc_id"]).count() == 0


# ---------------------------------------------------------------- 7: quality rules

def plain_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {p for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if times[g] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), len(lines), sum(map(len, w)), sum(x in quality.SYMBOLS for x in t), len(lines) - len(set(lines)), len(hit))


def test_quality_edges(spark, docs):
    x = quality.ledger(docs, out="found")
    assert x.columns == [*docs.columns, "found"]
    rows = x.select("text", "found.*").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert tuple(r)[1:7] == plain_measures(r.text)
        assert bool(r.fail_bits & 1) == (r.n_words < 50)
    assert quality.keep_clean(docs).columns == docs.columns
    assert quality.keep_clean(empty(spark)).count() == 0 and quality.ledger(empty(spark), out="found").count() == 0
    one = {r.rule: r for r in quality.ablation(x, "found").collect()}
    assert one["few_words"].n_fail == len(TEXTS) - 1 and one["few_words"].n_rejected == len(TEXTS)
    assert one["repeated_words"].n_alone == 1  # the long text


# ---------------------------------------------------------------- 8: URL filter

URLS = [None, "", "no scheme", "http://", "http://COM", "http://com/", "http://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/",
        "http://a.www.example.com/en/x", "http://xexample.com/en/", "http://a.net/es/1", "http://a.net/ES/1", "x://y://net/fr/",
        "http://net?/fr/", "http://net#/fr/", "http://a.net/fr/" + "y" * 300_000, "http://a.net/fr/é", "http://a.net/fr/é", "HTTP://net/es"]


def plain_judge(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in catalog.URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, urls.DEFAULT_VERDICT)))


def test_url_edges(spark):
    columns = "page_id long, url string, host string, path int, rule string, k string"
    pages = spark.createDataFrame([(k or None, u, "h", 1, None, "k") for k, u in enumerate(URLS)], columns)
    key = lambda r: (r[0] is not None, r[0] or 0)
    want = [(k or None, *plain_judge(u)) for k, u in enumerate(URLS)]
    rules = spark.createDataFrame(catalog.URL_RULES, "rule string, verdict string")
    for got in (urls.judge(pages, catalog.URL_RULES), urls.judge_by_join(pages, rules)):
        assert sorted((tuple(r) for r in got.collect()), key=key) == want
    assert urls.judge(empty(spark, columns), catalog.URL_RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}
    twice = [("com/", "allow"), ("com/", "block")]
    assert urls.judge(pages.filter("page_id = 5"), twice).first().verdict == "block"


# ---------------------------------------------------------------- 10: byte-level BPE

def test_bpe_edges(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, t in enumerate(TEXTS):
        ids = enc.encode_ordinary(t or "")
        want.append((min(k, 7), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.digests(docs, path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert bpe.digests(empty(spark), path, public_tokenizers.PATTERN).count() == 0
