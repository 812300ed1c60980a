"""Token-id files: texts encoded by a tokenizer, ids range-coded in blocks.

Documents are ordered by ``doc_id`` over range partitions; each task encodes
its texts (a distinct word once, see ``pieces``) and writes groups of whole
documents of about ``GROUP`` ids. A group row holds its documents, their id
counts, and the blocks of :mod:`idcoder`, each with its own models and
checksum, so any group can be read alone. The files are Parquet tables, which
Spark writes with its commit protocol: a task that is lost is written again.

A partition is as large as its share of the rows and a group as large as
``GROUP`` ids or one document, whatever the sources; nothing is gathered
beyond that. Positions over all files come from two small sums, groups within
a partition and partitions within the table.

Defined results: null and empty texts have the end id only; null doc_ids come
first; rows with equal doc_ids keep their own records, by text; an empty table
gives files without groups; columns other than the two asked for are not read.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import idcoder
from .common import partitions, small, text_or_empty
from .pieces import PiecePool

GROUP = 2000 * idcoder.BLOCK
RUN = 100  # words that go to the tokenizer as one text
MAX_WORDS = 1_000_000  # distinct words that a worker keeps, about 60 bytes each while they are looked up
CHUNK_BYTES = 16_000_000  # of text that is cut into words at a time, a longer text alone
# Sure to be one pre-token: Latin-1 letters. Symbols after them are the next one.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
_TAIL = ".,;:!?#$%&*|<>()"
FILE = ("part int, grp int, alphabet int, n_tokens long, doc_ids array<long>, doc_lens array<long>, "
        "words binary, crcs binary, code binary")


def _listed(x: pa.Array) -> list:
    """The values of an array without nulls; Arrow's own list takes several times as long."""
    return x.to_numpy(zero_copy_only=False).tolist()


def _lists(ids: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    ends = np.zeros(len(lens) + 1, np.int32)
    np.cumsum(lens, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


class WordPool:
    """Ids of distinct words, as Arrow lists. Arrow numbers the words too, so
    none becomes a Python object; emptied when it holds ``most``."""

    def __init__(self, resolve: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]], most: int):
        self.resolve, self.most = resolve, most
        self._clear()

    def _clear(self) -> None:
        self.held = pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32()))

    def numbered(self, words: pa.StringArray) -> np.ndarray:
        """Places of distinct ``words`` among ``ids``; new ones are encoded."""
        if len(self.held[0]) > self.most:
            self._clear()
        known, ids = self.held
        at = pc.index_in(words, value_set=known)
        new = words.filter(at.is_null())
        if not len(new):
            return at.to_numpy()
        out = at.fill_null(-1).to_numpy().copy()
        out[out < 0] = np.arange(len(known), len(known) + len(new))
        self.held = pa.concat_arrays([known, new]), pa.concat_arrays([ids, _lists(*self.resolve(new))])
        return out

    @property
    def ids(self) -> pa.ListArray:
        return self.held[1]


class WordEncoder:
    """Ids of texts by a ``tokenizers`` tokenizer that drops white space and
    ends words by a suffix: pieces between ASCII white space are independent,
    so each distinct piece of a chunk is looked up once. A plain word is looked
    up in lower case, apart from symbols after it, and encoded once; so are
    other pieces, whole."""

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.bare = Tokenizer.from_str(json), Tokenizer.from_str(json)
        # lower-case Latin-1 words are normal already and end at white space
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.alphabet = max(vocab.values()) + 1
        self.ends = np.zeros(self.alphabet, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words = WordPool(self._words, MAX_WORDS)
        self.pool = PiecePool(self._whole)

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, one after the other, and their numbers of ids.
        Words go in runs and are told apart by the word-end ids; those of runs
        whose word count differs go one by one."""
        cuts = np.append(np.arange(0, len(words), RUN), len(words)).astype(np.int32)
        runs = _listed(pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " "))
        ids, lens = [], []
        for k, e in enumerate(self.bare.encode_batch_fast(runs, add_special_tokens=False)):
            one = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[one]) + 1
            if len(ends) == cuts[k + 1] - cuts[k] and ends[-1] == len(one):
                ids.append(one)
                ends[1:] -= ends[:-1].copy()
                lens.append(ends)
            else:
                alone = self._whole(words[cuts[k]:cuts[k + 1]].to_pylist())
                ids += [np.array(x, np.uint32) for x in alone]
                lens.append(np.array([len(x) for x in alone]))
        return np.concatenate(ids), np.concatenate(lens)

    def _pieces(self, pieces: pa.StringArray) -> pa.ListArray:
        """Ids of distinct pieces: of a plain word, if any, then of the rest."""
        word = pc.utf8_rtrim(pieces, characters=_TAIL)
        rest = pc.utf8_ltrim(pieces, characters=_LETTERS)
        n = [pc.binary_length(x).to_numpy() for x in (pieces, word, rest)]
        plain = pa.array((n[1] + n[2] == n[0]) & (n[1] > 0))  # letters, then symbols
        words = pc.utf8_lower(word.filter(plain)).dictionary_encode()
        rest = pc.if_else(plain, rest, pieces).dictionary_encode()
        other = _listed(rest.dictionary)
        other = self.pool.numbered(other, len(other))
        known = self.words.numbered(words.dictionary)
        none = len(self.words.ids)
        at = np.full((len(pieces), 2), none, np.int64)
        at[plain.to_numpy(zero_copy_only=False), 0] = known[words.indices.to_numpy()]
        at[:, 1] = none + 1 + other[rest.indices.to_numpy()]
        ids = pa.concat_arrays([self.words.ids, pa.array([[]], pa.list_(pa.uint32())), _lists(self.pool.ids, self.pool.lens)])
        both = ids.take(pa.array(at.ravel()))
        return pa.ListArray.from_arrays(both.offsets.take(pa.array(np.arange(0, 2 * len(pieces) + 1, 2))), both.values)

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Arrow cuts the texts, numbers their pieces, and puts the ids together."""
        pieces = pc.split_pattern(pc.replace_substring_regex(texts, "[\n\t\r]", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        ids = self._pieces(coded.dictionary).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy(), dtype=np.int64)])
        cuts = ids.offsets.to_numpy()[ends].tolist()
        flat = ids.values.to_numpy()
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_LAST: list = []  # the encoder of this worker process and its tokenizer


def _encoder(json: str) -> WordEncoder:
    """The words that a worker has met serve its next tasks too; not those of
    a pool that a failed task left with numbers but no ids."""
    if not _LAST or _LAST[0] != json or len(_LAST[1].pool.numbers) != len(_LAST[1].pool.lens):
        _LAST[:] = json, WordEncoder(json)
    return _LAST[1]


def _runs(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``CHUNK_BYTES`` of text."""
    ends, a = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK_BYTES, "right")))
        yield a, b
        a = b


def _group(part: int, grp: int, alphabet: int, docs: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids).astype(np.int64)
    words, crcs, code = idcoder.encode(flat, alphabet)
    row = {"part": part, "grp": grp, "alphabet": alphabet, "n_tokens": len(flat), "doc_ids": docs, "doc_lens": [len(x) for x in ids],
           "words": words.tobytes(), "crcs": crcs.tobytes(), "code": code}
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, add ``end_id``, write the files below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())  # bounded by the vocabulary
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, grp, docs_, ids, held = _encoder(sent.value), TaskContext.get().partitionId(), 0, [], [], 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for a, b in _runs(batch.column(1)):
                for doc, got in zip(batch.column(0).slice(a, b - a).to_pylist(), enc.encode(batch.column(1).slice(a, b - a)), strict=True):
                    docs_.append(doc)
                    ids.append(np.concatenate([got, end]))
                    held += len(got) + 1
                    if held >= GROUP:
                        yield _group(part, grp, enc.alphabet, docs_, ids)
                        grp, docs_, ids, held = grp + 1, [], [], 0
        if docs_:
            yield _group(part, grp, enc.alphabet, docs_, ids)

    x = x.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    x.mapInArrow(work, FILE).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files back: ``doc_id, start`` (ids of all documents before),
    ``n_tokens`` and binary ``ids`` (little-endian unsigned 32-bit)."""
    files = spark.read.schema(FILE).parquet(path)
    groups = files.select("part", "grp", "n_tokens")
    parts = groups.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))  # as many rows as write tasks
    in_part = Window.partitionBy("part").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("part", "grp", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("grp_start")).join(parts, "part")

    groups = groups.select("part", "grp", (F.col("part_start") + F.col("grp_start")).alias("first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = idcoder.decode(row["n_tokens"], row["alphabet"], np.frombuffer(row["words"], np.int64),
                                     np.frombuffer(row["crcs"], np.int64), row["code"]).astype("<u4")
                lens = np.array(row["doc_lens"], np.int64)
                ends = np.cumsum(lens)
                for a in range(0, len(lens), 500):
                    cut = slice(a, a + 500)
                    raw = [ids[e - n:e].tobytes() for e, n in zip(ends[cut], lens[cut], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][cut], pa.int64()), pa.array(row["first"] + ends[cut] - lens[cut]), pa.array(lens[cut]), pa.array(raw, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    # places join the coded groups, so what may be shuffled is the code, never the ids
    return files.join(small(groups), ["part", "grp"]).mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")
