"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character 1- to 3-grams
in order. A document is compared to each profile by the out-of-place
distance: for each of its own most frequent n-grams, how far its rank is from
the profile's, or the largest distance where the profile lacks it. The
nearest profile wins.

Counts are over all learning texts: tasks count per language and hand on one
row per distinct n-gram, a shuffle sums them, and a window keeps each
language's first ``PROFILE`` (Spark limits the groups before the shuffle, so a
language with most of the rows is no hot task). Only the profiles, languages x
``PROFILE`` rows, come to the driver; more than ``MAX_LANGUAGES`` languages is
an error. Prediction is a map over rows.

Defined results: null texts and texts without a letter give ``und`` and 0, as
does an empty learning set; equal counts rank by code point, equal distances
by language name; null languages teach nothing; repeated rows count each;
long texts are counted whole, in pieces.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 400
MAX_LANGUAGES = 5_000
PIECE = 1 << 20
_PAD = np.uint64(1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str) -> Iterator[np.ndarray]:
    """Codes of all 1- to 3-grams, 21 bits a character, in pieces. Everything
    but letters is one pad; n-grams of pads alone, and 3-grams around a pad,
    are left out."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    c = np.where(_letters()[raw], raw, 1).astype(np.uint64)
    c = np.concatenate([[_PAD], c, [_PAD]])
    for a in range(0, len(c), PIECE):
        x = c[a:a + PIECE + 2]
        one, two, three = x[:PIECE], x[1:PIECE + 1], x[2:]
        yield one[one != _PAD]
        pair = (one[:len(two)] << np.uint64(21)) | two
        yield pair[(one[:len(two)] != _PAD) | (two != _PAD)]
        n = len(three)
        yield ((pair[:n] << np.uint64(21)) | three)[two[:n] != _PAD]


def merge(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def tally(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and how often each occurs."""
    parts = [np.unique(np.concatenate(x), return_counts=True) for x in _by_piece(text)]
    if len(parts) == 1:
        return parts[0]
    return merge(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def _by_piece(text: str) -> Iterator[list[np.ndarray]]:
    it = grams(text)
    for first in it:
        yield [first, next(it), next(it)]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Profiles ``lang, code, rank`` (0 the most frequent) from labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = seen.setdefault(lang, [[], [], 0])
                codes, counts = tally(text)
                held[0].append(codes)
                held[1].append(counts)
                held[2] += len(codes)
                if held[2] > 2_000_000:
                    one = merge(np.concatenate(held[0]), np.concatenate(held[1]))
                    held[:] = [one[0]], [one[1]], 0
        for lang, (codes, counts, _) in seen.items():
            codes, counts = merge(np.concatenate(codes), np.concatenate(counts))
            for a in range(0, len(codes), 50_000):
                k = len(codes[a:a + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * k, pa.string()), pa.array(codes[a:a + k].astype(np.int64)), pa.array(counts[a:a + k].astype(np.int64))],
                    names=["lang", "code", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    n = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return n.withColumn("rank", rank - 1).filter(F.col("rank") < PROFILE).select("lang", "code", "rank")


class Profiles:
    def __init__(self, rows: list):
        self.langs = sorted({r.lang for r in rows})
        self.codes = np.array(sorted({r.code for r in rows}), np.uint64)
        self.ranks = np.full((len(self.langs), len(self.codes)), -1, np.int64)
        for r in rows:
            self.ranks[self.langs.index(r.lang), np.searchsorted(self.codes, np.uint64(r.code))] = r.rank

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = tally(text) if text else ((), ())
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = np.lexsort((codes, -counts))[:PROFILE]
        codes = codes[top]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.ranks[:, at]
        off = np.abs(known - np.arange(len(codes)))
        off[(known < 0) | (self.codes[at] != codes)] = PROFILE
        distance = off.sum(1)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (PROFILE * len(codes))


def collect_profiles(profiles: DataFrame) -> Profiles:
    rows = profiles.limit(PROFILE * MAX_LANGUAGES + 1).collect()
    if len(rows) > PROFILE * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Profiles(rows)


def predict(docs: DataFrame, profiles: Profiles, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus ``lang_pred`` and ``score`` (1 - distance / largest distance)."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    x = docs.select(*id_cols, F.col(text_col).cast("string").alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sent.value.predict(t) for t in batch.column(len(id_cols)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*id_cols, "lang_pred", "score"])

    fields = [f"`{c}` {t}" for c, t in x.dtypes[:-1]]
    return x.mapInArrow(work, ", ".join([*fields, "lang_pred string", "score double"]))
