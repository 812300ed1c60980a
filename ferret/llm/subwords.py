"""Text classifier over supervised subword embeddings.

Every word and every character n-gram of a word (3 and 4 bytes, with the
word's ends marked) is hashed to one of ``BUCKETS`` learned vectors. The vector
of a document is the mean of those of all its features; a linear layer with
softmax gives the classes. Vectors and layer are trained together by
stochastic gradient descent in numpy, a document a step, with a learning rate
that falls to zero.

Features are counted by tasks over whole texts. The model is fitted on the
driver on a bounded sample of the labelled rows: the first ``SAMPLE`` documents
by hash of id and text, of these as many as hold ``FEATURES`` distinct
features together (160 MB). Learning over, vectors times layer is one number
per bucket and class; this table (512 KB a class) is broadcast, and
prediction is a map over rows with one gather per feature.

Defined results: null and empty texts and texts of white space have no feature
and get the classes' bias alone; without a learning row every class is equally
likely; null labels teach nothing; labels without a document teach nothing; an
id that occurs twice teaches once per text and label; equal texts get equal
scores; texts of any length count in full, ``PIECE`` bytes at a time; columns
that are not asked for are not read; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BITS = 16
BUCKETS = 1 << BITS
DIM = 16
SAMPLE = 4_000
FEATURES = 20_000_000
EPOCHS = 10
RATE = 1.0
PIECE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 divided by the golden ratio


def _bucket(code: np.ndarray) -> np.ndarray:
    code = code * _MIX
    code ^= code >> np.uint64(29)
    return ((code * _MIX) >> np.uint64(64 - BITS)).astype(np.int32)


def _words(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Buckets of the words ``raw[first:last]``: first and last eight bytes and
    the length."""
    length = last - first
    head, tail = np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint64)
    for k in range(8):
        fits = k < length
        head[fits] = (head[fits] << np.uint64(8)) | raw[first[fits] + k]
        tail[fits] = (tail[fits] << np.uint64(8)) | raw[last[fits] - 1 - k]
    return _bucket(head * _MIX + tail * np.uint64(31) + length.astype(np.uint64) + np.uint64(1 << 40))


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, in pieces."""
    raw = np.frombuffer(b" " + (text or "").encode() + b" ", np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, last = edge[::2], edge[1::2]
    for a in range(0, len(first), PIECE // 8):
        yield _words(raw, first[a:a + PIECE // 8], last[a:a + PIECE // 8])
    for a in range(0, len(raw) - 2 if len(first) else 0, PIECE):
        s = space[a:a + PIECE + 3]
        x = np.where(s, 0x20, raw[a:a + PIECE + 3]).astype(np.uint64)
        n = min(PIECE, len(x) - 2)
        three = (x[:n] << np.uint64(16)) | (x[1:n + 1] << np.uint64(8)) | x[2:n + 2]
        inner = ~s[1:n + 1]
        yield _bucket(three[inner])
        n = min(n, len(x) - 3)
        four = (three[:n] << np.uint64(8)) | x[3:n + 3] | np.uint64(1 << 36)
        yield _bucket(four[inner[:n] & ~s[2:n + 2]])


def tally(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    for x in features(text):
        counts += np.bincount(x, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at]


class Model:
    """``tables``: per class the score of each bucket, ``bias``: per class."""

    def __init__(self, classes: list[int], tables: np.ndarray, bias: np.ndarray):
        self.classes, self.tables, self.bias = classes, tables, bias

    def probabilities(self, text: str | None) -> np.ndarray:
        z, n = np.zeros(len(self.classes)), 0
        for x in features(text):
            n += len(x)
            for k, t in enumerate(self.tables):
                z[k] += t[x].sum()
        return softmax(z / max(1, n) + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 17) -> Model:
    """The model of ``rows`` (class, buckets, counts), in their order."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((DIM, len(classes))), np.zeros(len(classes))
    place = {c: k for k, c in enumerate(classes)}
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for r in rng.permutation(len(rows)).tolist():
            label, at, counts = rows[r]
            lr = rate * (1 - step / steps)
            step += 1
            share = counts / max(1, counts.sum())
            own = vectors[at]
            mean = share @ own
            off = softmax(mean @ layer + bias)
            off[place[label]] -= 1
            pull = layer @ off
            layer -= lr * np.outer(mean, off)
            bias -= lr * 0.1 * off
            vectors[at] = own - lr * share[:, None] * pull
    return Model(classes, (vectors @ layer).T.copy(), bias)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
          classes: tuple[int, ...] = (0, 1)) -> Model:
    """Model of the documents of ``labels``, one of ``classes`` each."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(*classes))
    ids = docs.select(F.col(id_col).alias("id"))
    few = marked.join(ids, "id", "left_semi").distinct().orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(few), "id")
    x = x.select(F.xxhash64("id").alias("a"), F.xxhash64("text").alias("b"), "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(3).to_pylist()):
                at, counts = tally(text)
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:3], pa.array([at], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64())), pa.array([len(at)], pa.int32())],
                    names=["a", "b", "label", "buckets", "counts", "n"])

    rows = stored(x.mapInArrow(count, "a long, b long, label int, buckets array<int>, counts array<long>, n int"), "sw-learning")
    order = ["a", "b", "label"]
    held, last = 0, None
    for r in rows.select(*order, "n").distinct().orderBy(*order).limit(SAMPLE).collect():
        held += r.n
        if held > FEATURES:
            break
        last = r
    if last is None:
        return Model(list(classes), np.zeros((len(classes), BUCKETS)), np.zeros(len(classes)))
    cut = F.struct(*[F.lit(last[c]).cast(t).alias(c) for c, t in zip(order, ("long", "long", "int"), strict=True)])
    got = rows.filter(F.struct(*order) <= cut).dropDuplicates(order).orderBy(*order).limit(SAMPLE).toArrow()
    return train([(r["label"], np.array(r["buckets"], np.int32), np.array(r["counts"], float)) for b in got.to_batches(64) for r in b.to_pylist()], list(classes))


def predict(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text", label: int = 1, out: str = "score") -> DataFrame:
    """``id_cols`` plus the probability of class ``label``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    x = docs.select(*id_cols, F.col(text_col).cast("string").alias("__text"))
    k = model.classes.index(label)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [float(sent.value.probabilities(t)[k]) for t in batch.column(len(id_cols)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.float64())], names=[*id_cols, out])

    fields = [f"`{c}` {t}" for c, t in x.dtypes[:-1]]
    return x.mapInArrow(work, ", ".join([*fields, f"`{out}` double"]))
