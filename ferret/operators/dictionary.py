"""The term dictionary of an index, and what multi-term clauses look up in it.

* ``terms``: every term of a field in order, in blocks of ``BLOCK``.
* ``fences``: the first term of each block. The two ends of a range (a prefix is
  one) are placed among them by one sort of ends and fences.
* Documents of ranges, prefixes and wildcards: :class:`Matcher` says of a term
  which of a block of clauses it matches. The ends of all ranges cut the
  dictionary into slots, and a term has one, whatever number of ranges holds it;
  a pattern is found by its literal ends and then checked. Where few terms match,
  their postings are looked up; else the postings of the field are read through
  once, a term at a time, and no pairs of clauses and terms are joined.
* Fuzzy terms: each term is cut into ``MAX_EDITS + 1`` pieces where it lies. Within
  that many edits one piece stays as it is, and of the edits as many lie before it
  as pieces do, so a fuzzy term finds its variants by equal pieces at few places
  and checks the distance. Only the terms are exchanged, never their pieces.

The stored tables are built when a query first needs them, beside the postings.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, parallelism, small
from .bydoc import Slots
from .index import Index, bucket_of
from .ordinals import last_mark, placed

BLOCK, FAN, LEVELS = 64, 16, 8  # LEVELS cover 64 * 16 ** 8 terms of a field
MAX_EDITS = 2
TOP = "\U0010ffff"  # after all that a prefix may go on with
LOOKUP_TERMS = 100_000  # matched terms whose postings are looked up one by one
LEAF = ["qid", "ga", "b", "c"]


# ---------------------------------------------------------------- what is stored

def terms(ix: Index) -> DataFrame:
    """``field, term, df, ord, block``."""
    def make():
        x = placed(ix.term_stats.select("field", "term", "df"), ["term"], "field")
        return x.withColumn("block", F.floor(F.col("ord") / BLOCK).cast("long"))
    return ix.part("terms", make)


def fences(ix: Index) -> DataFrame:
    """``field, term, block``: the first term of each block."""
    return ix.part("fences", lambda: terms(ix).filter(F.col("ord") % BLOCK == 0).select("field", "term", "block"))


def _cut(n: Column) -> list[tuple[Column, Column]]:
    """Starts (from 0) and lengths of the pieces of a string of ``n`` characters."""
    k = MAX_EDITS + 1
    start = [F.floor(n * i / k).cast("int") for i in range(k + 1)]
    return [(start[i], start[i + 1] - start[i]) for i in range(k)]


def _piece_key(length: Column, i: int, text: Column) -> Column:
    return F.concat_ws(":", length, F.lit(i), text)


# ---------------------------------------------------------------- ranges and prefixes

def _ends(leaves: DataFrame) -> DataFrame:
    """Leaves plus the least and greatest string that they match (null: open)."""
    prefix = F.col("kind") == "prefix"
    lo = F.when(F.col("term") != "*", F.col("term"))
    return leaves.withColumn("lo", lo).withColumn(
        "hi", F.when(prefix, F.concat("term", F.lit("\U0010ffff"))).otherwise(F.when(F.col("hi") != "*", F.col("hi"))))


def _cover(a: Column, z: Column) -> Column:
    """Nodes ``level, node`` that cover the blocks from ``a`` to before ``z``: a
    fold over the levels, which takes what no whole parent covers."""
    kind = "array<struct<level:int,node:bigint>>"
    none = F.array().cast(kind)

    def run(level, x, y):
        ids = F.transform(F.sequence(x, y - 1), lambda i: F.struct(level.alias("level"), i.alias("node")))
        return F.when(x < y, ids.cast(kind)).otherwise(none)

    def step(acc, level):
        up, down = F.ceil(acc["a"] / FAN).cast("long"), F.floor(acc["z"] / FAN).cast("long")
        split = (up < down) & (level < LEVELS - 1)  # some parent is whole
        here = F.when(split, F.concat(run(level, acc["a"], up * FAN), run(level, down * FAN, acc["z"]))).otherwise(run(level, acc["a"], acc["z"]))
        rest = lambda x: F.when(split, x).otherwise(F.lit(0).cast("long"))
        return F.struct(rest(up).alias("a"), rest(down).alias("z"), F.concat(acc["nodes"], here).alias("nodes"))

    start = F.struct(a.cast("long").alias("a"), z.cast("long").alias("z"), none.alias("nodes"))
    return F.aggregate(F.array(*[F.lit(lv) for lv in range(LEVELS)]), start, step, lambda acc: acc["nodes"])


def ranges(leaves: DataFrame, ix: Index) -> tuple[DataFrame, DataFrame]:
    """Leaves ``LEAF, kind, field, term, hi`` of ranges and prefixes as
    ``LEAF, field, level, node`` (whole blocks) and ``LEAF, field,
    term`` (terms of the two edge blocks, as many as fit)."""
    x = _ends(leaves.select(*LEAF, "kind", "field", "term", "hi"))
    probe = F.explode(F.array(F.struct(F.lit("lo").alias("end"), F.coalesce("lo", F.lit("")).alias("key")),
                              F.struct(F.lit("hi").alias("end"), F.coalesce("hi", F.lit("\U0010ffff" * 4)).alias("key"))))
    probes = x.select(*LEAF, "field", probe.alias("p")).select(*LEAF, "field", F.col("p.end").alias("end"), F.col("p.key").alias("key"))
    at = last_mark(probes, fences(ix).withColumnRenamed("term", "key"), "field", "key", "block")
    at = at.groupBy(*LEAF).agg(F.max(F.when(F.col("end") == "lo", F.col("block"))).alias("from"),
                               F.max(F.when(F.col("end") == "hi", F.col("block"))).alias("to"))
    x = x.join(small(at), LEAF).filter(F.col("to").isNotNull() & (F.coalesce("lo", F.lit("")) <= F.coalesce("hi", F.lit("\U0010ffff" * 4))))
    # a range that begins before the first term has no edge block at its start
    first = F.coalesce(F.col("from"), F.lit(-1)).cast("long")
    whole = F.explode(_cover(first + 1, F.greatest(F.col("to"), first + 1)))
    covered = x.select(*LEAF, "field", whole.alias("n")).select(*LEAF, "field", "n.level", "n.node")
    edge = x.select(*LEAF, "field", "lo", "hi", F.explode(F.array_distinct(F.array("from", "to"))).alias("block")).filter("block IS NOT NULL")
    inside = (F.col("lo").isNull() | (F.col("term") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("term") <= F.col("hi")))
    edges = terms(ix).select("field", "block", "term").join(small(edge), ["field", "block"]).filter(inside)
    return covered, edges.select(*LEAF, "field", "term")


# ---------------------------------------------------------------- fuzzy terms

def _places(i: int, off: int) -> list[int]:
    """How far off its place in a term piece ``i`` may lie in a word that is
    ``off`` characters shorter. Take the first piece with fewer edits up to its
    end than pieces: it is whole, with ``i`` edits before it and at most
    ``MAX_EDITS - i`` after it."""
    return [s for s in range(-i, i + 1) if abs(s + off) <= MAX_EDITS - i]


def _letters(text: Column) -> Column:
    """The characters of a string as bits of a long. An edit changes two at most,
    one if it changes the length."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c).bitwiseAND(63))
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda acc, c: acc.bitwiseOR(bit(c)))


def variants(asked: DataFrame, ix: Index) -> DataFrame:
    """Distinct ``field, word, edits`` as ``field, word, edits, term, df, dist``:
    all terms of the dictionary within ``edits`` (``MAX_EDITS`` at most)."""
    m, w = F.length("word"), F.col("word")
    keys = []
    for off in range(-MAX_EDITS, MAX_EDITS + 1):
        n = m + off  # length of the term that is looked for
        for i, (a, k) in enumerate(_cut(n)):
            for s in _places(i, off):
                fits = (n >= 1) & (F.lit(abs(s) + abs(s + off)) <= F.col("edits")) & (a + s >= 0) & (a + s + k <= m)
                keys.append(F.when(fits, _piece_key(n, i, F.substr(w, a + s + 1, k))))
    pieces = F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("piece")
    x, _ = materialize(asked.select("field", "word", "edits", m.alias("m"), _letters(w).alias("w_letters"), pieces))
    # terms are dealt evenly: few files of the dictionary hold many pairs to check
    spark, t, n = ix.term_stats.sparkSession, F.col("term"), F.length("term")
    fields = [r.field for r in x.select("field").distinct().collect()]  # of the index
    dealt = ix.term_stats.select("field", "term", "df").filter(F.col("field").isin(fields)).repartition(parallelism(spark), "field", "term")
    cut = F.array(*[_piece_key(n, i, F.substr(t, a + 1, k)) for i, (a, k) in enumerate(_cut(n))])
    dealt = dealt.select("field", "term", "df", n.alias("n"), _letters(t).alias("t_letters"), F.explode(cut).alias("piece"))
    x = dealt.join(small(x), ["field", "piece"])
    # the cheap test first; -1 (beyond MAX_EDITS) becomes the greatest, so the distance is found once
    x = x.filter(F.bit_count(F.col("w_letters").bitwiseXOR(F.col("t_letters"))) <= 2 * F.col("edits") - F.abs(F.col("n") - F.col("m")))
    x = x.filter(F.pmod(F.levenshtein("word", "term", MAX_EDITS), F.lit(MAX_EDITS + 2)) <= F.col("edits"))
    # a pair found by several pieces lies in its term's partition: no exchange
    return x.select("field", "word", "edits", "term", "df", F.levenshtein("word", "term", MAX_EDITS).alias("dist")).distinct()


def fuzzy(leaves: DataFrame, ix: Index) -> DataFrame:
    """``LEAF, field, term`` of fuzzy leaves (``term``, ``edits``)."""
    x = leaves.select(*LEAF, "field", F.col("term").alias("word"), "edits")
    found = variants(x.select("field", "word", "edits").distinct(), ix)
    return found.join(small(x), ["field", "word", "edits"]).select(*LEAF, "field", "term")


# ---------------------------------------------------------------- documents

def _key(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Matcher:
    """Which clauses of a block a term matches. ``clauses`` has the columns
    ``field, kind, term, hi`` (prefix, range, wildcard) and the clause's number
    ``probe``."""

    def __init__(self, clauses: list[tuple[str, str, str, str | None, int]]):
        ends, self.cuts, base, ranges = defaultdict(list), {}, 0, []
        self.patterns: dict[str, dict] = {}
        for field, kind, term, hi, probe in clauses:
            if kind == "wildcard":
                self._add(field, term, probe)
                continue
            lo = b"" if term == "*" and kind == "range" else _key(term)
            last = _key(term + TOP) if kind == "prefix" else None if hi == "*" else _key(hi)
            if last is None or lo <= last:
                # a byte string after all that is not above the last one
                ends[field].append((lo, None if last is None else last + b"\0", probe))
        for field, own in sorted(ends.items()):
            cuts = sorted({e for lo, end, _ in own for e in (lo, end) if e is not None})
            at = {e: i + 1 for i, e in enumerate(cuts)}
            covered = np.zeros(len(cuts) + 2, dtype=np.int64)
            for lo, end, probe in own:
                a, b = at[lo], len(cuts) + 1 if end is None else at[end]
                ranges.append((probe, base + a, base + b))
                covered[a] += 1
                covered[b] -= 1
            self.cuts[field] = cuts, np.cumsum(covered).tolist(), base
            base += len(cuts) + 1
        cols = np.array(ranges, dtype=np.int64).reshape(-1, 3)
        self.slots = Slots(cols[:, 0], cols[:, 1], cols[:, 2], base) if len(cols) else None

    def _add(self, field: str, pattern: str, probe: int) -> None:
        """A pattern (``*`` any text, ``?`` one character) by its literal ends, or
        by its longest literal if it has none at its ends."""
        head, tail = re.match(r"[^*?]*", pattern)[0], re.search(r"[^*?]*$", pattern)[0]
        inner = "" if head or tail else max(re.split(r"[*?]+", pattern), key=len)
        rx = re.compile("".join({"*": ".*", "?": "."}.get(c) or re.escape(c) for c in pattern), re.DOTALL)
        by = self.patterns.setdefault(field, {})
        by.setdefault((len(head), len(tail), len(inner)), defaultdict(list))[head, tail, inner].append((rx, probe))

    def keys(self, field: str, term: str) -> list[int]:
        """Numbers of the wildcards that a term matches, and its slot ``s`` as
        ``-1 - s`` if a range holds it."""
        out = []
        if field in self.cuts:
            cuts, covered, base = self.cuts[field]
            s = bisect_right(cuts, _key(term))
            if covered[s]:
                out.append(-1 - base - s)
        n = len(term)
        for (h, t, i), found in self.patterns.get(field, {}).items():
            if h + t > n or i > n:
                continue
            for inner in {term[k:k + i] for k in range(n - i + 1)} if i else ("",):
                for rx, probe in found.get((term[:h], term[n - t:], inner), ()):
                    if rx.fullmatch(term):
                        out.append(probe)
        return out

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``field, term, ...`` of terms that match as ``..., keys``; a term
        that comes in many rows of a batch is judged once."""
        for b in batches:
            fields = b["field"].dictionary_encode()
            for k, field in enumerate(fields.dictionary.to_pylist()):
                x = b if len(fields.dictionary) == 1 else b.filter(pa.array(fields.indices.to_numpy() == k))
                code = x["term"].dictionary_encode()
                lists = pa.array([self.keys(field, t) for t in code.dictionary.to_pylist()], pa.list_(pa.int32()))
                at = code.indices.to_numpy()
                own = np.flatnonzero(lists.value_lengths().to_numpy(zero_copy_only=False)[at] > 0)
                rest = x.drop_columns(["field"]) if "doc_id" in x.schema.names else x
                rest = rest.drop_columns(["term"]) if "doc_id" in rest.schema.names else rest
                rest = rest.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*rest.columns, lists.take(pa.array(at[own]))], [*rest.schema.names, "keys"])

    def of(self, df: DataFrame) -> DataFrame:
        """``field, term`` (of terms) or ``field, term, doc_id`` (of postings) that
        match, as ``field, term, keys`` or ``doc_id, keys``."""
        df = df.filter(F.col("field").isin(sorted({*self.cuts, *self.patterns})))
        names = ["doc_id"] if "doc_id" in df.columns else ["field", "term"]
        return df.mapInArrow(self.rows, ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names) + ", keys array<int>")


def matches(clauses: list[tuple], ix: Index) -> tuple[DataFrame | None, Slots | None]:
    """``doc_id, keys`` (see :mod:`bydoc`) of multi-term clauses ``field, kind,
    term, hi, edits, probe``; a document may come more than once."""
    found, parts, matcher = None, [], Matcher([(f, k, t, hi, p) for f, k, t, hi, _, p in clauses if k != "fuzzy"])
    spark = ix.postings.sparkSession
    if matcher.cuts or matcher.patterns:
        found, n = materialize(matcher.of(ix.term_stats.select("field", "term")))
        if n > LOOKUP_TERMS:
            parts.append(matcher.of(ix.postings.select("field", "term", "doc_id")))
            found = None
    fuzzy = [(f, t, e, p) for f, k, t, _, e, p in clauses if k == "fuzzy"]
    if fuzzy:
        asked = spark.createDataFrame(fuzzy, "field string, word string, edits int, probe int")
        near = variants(asked.select("field", "word", "edits").distinct(), ix).select("field", "word", "edits", "term")
        near = near.join(F.broadcast(asked), ["field", "word", "edits"]).groupBy("field", "term").agg(F.collect_list("probe").alias("keys"))
        found = near if found is None else found.unionByName(near)
    if found is not None:
        found, _ = materialize(ix.bucketed(found))
        lookup = ["field", "bucket", "term"]
        # the filter lets the scan be pruned to the buckets asked for
        parts.append(ix.postings.select(*lookup, "doc_id").join(small(found.filter("bucket >= 0")), lookup).select("doc_id", "keys"))
    return reduce(DataFrame.unionByName, parts) if parts else None, matcher.slots


def documents(leaves: DataFrame, ix: Index) -> DataFrame:
    """``LEAF, doc_id`` of multi-term leaves (few: their clauses are numbered on
    the driver): a document comes once per term of the leaf that it holds."""
    rows, _ = materialize(leaves.select(*LEAF, "field", "kind", "term", "hi", "edits"))
    kinds = ["field", "kind", "term", "hi", "edits"]
    asked = [tuple(r) for r in rows.select(*kinds).distinct().collect()]
    numbers = [(*c, i) for i, c in enumerate(asked)]
    found, slots = matches(numbers, ix)

    def probes(batches):
        for b in batches:
            lists = b["keys"]
            own = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            key = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if slots is not None:
                low = key < 0
                at, probe = slots.hit(own[low], -1 - key[low])
                own, key = np.r_[own[~low], at], np.r_[key[~low], probe]
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(pa.array(own)), pa.array(key)], ["doc_id", "probe"])

    kind = ix.postings.schema["doc_id"].dataType.simpleString()
    probe = ix.postings.sparkSession.createDataFrame(numbers, "field string, kind string, term string, hi string, edits int, probe long")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in kinds])
    leaf = rows.alias("l").join(F.broadcast(probe.alias("r")), same).select(*[F.col(f"l.{c}") for c in LEAF], "probe")
    return found.mapInArrow(probes, f"doc_id {kind}, probe long").join(small(leaf), "probe").select(*LEAF, "doc_id")
