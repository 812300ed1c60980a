"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks of ``block`` documents. A source of weight
w (its share of all weights, an exact fraction) has its j-th block released at
floor((j - 1) / w) and due at ceil(j / w), and the earliest due of the released
blocks takes the slot. So at every slot each source is less than one block from
its target. When a source has no block left, the rest go on with their weights
in proportion, in a new phase.

Exact shares repeat after a round of as many slots as the weights add up to,
taken as whole numbers without a common factor. The driver works out one round
per phase, or the phase alone where it ends within its first round, from the
sources' row counts; nothing is rounded, so the bound holds over any number of
rounds. It holds one slot per block at most, and no more than a round. The
place of a block then is arithmetic on its number, done by Spark for all rows;
rounds over ``INLINE`` slots are joined in pieces of ``PIECE`` slots.

Rows are numbered within a source in hash order without gathering a source in
one task: hash ranges of a source are counted first, and a window numbers each
range, so a source with a third of the rows is many small groups.

Defined results: null sources are a source of their own; weights must be
positive, sources without one get ``default``; all rows are kept, repeated
rows too (rows alike in every sorted column are interchangeable); an empty
table stays empty; helper columns take names that the table does not have.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Mapping
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, partitions

INLINE = 2520  # slots of a round that rows find without a join by piece
PIECE = 256
MAX_PIECES = 20_000  # broadcast up to here
RANGE_ROWS = 50_000  # wished rows of a hash range
MAX_SOURCES = 2_000
# Target weights of op3_mix_sources and the pipeline: the main source four
# times, the next four twice a plain source (weight 1), rows without a source half.
WEIGHTS: dict[str | None, float] = {None: 0.5, "src0": 4.0, "src1": 2.0, "src2": 2.0, "src3": 2.0, "src4": 2.0}


def shares(weights: Mapping[int, float]) -> dict[int, int]:
    """The weights (as written in decimals, or fractions) in whole numbers
    without a common factor: slots per source of the shortest exact round."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


def pfair_round(quota: Mapping[int, int], blocks: Mapping[int, int] | None = None) -> dict[int, array]:
    """Slots of each source's blocks in one round, earliest deadline first, up
    to the slot where a source has none of its ``blocks`` left."""
    slots = sum(quota.values())
    due: list[tuple[int, int, int]] = []
    release: dict[int, list[tuple[int, int]]] = {0: [(s, 1) for s in quota]}
    out = {s: array("q") for s in quota}
    slot = 0
    while slot < slots:
        for s, j in release.pop(slot, ()):
            heapq.heappush(due, (-(-j * slots // quota[s]), s, j))
        _, s, j = heapq.heappop(due)
        out[s].append(slot)
        slot += 1
        if blocks is not None and j == blocks[s]:
            break
        if j < quota[s]:
            release.setdefault(max(slot, j * slots // quota[s]), []).append((s, j + 1))
    return out


def phases(blocks: Mapping[int, int], weights: Mapping[int, float]) -> list[dict]:
    """Per phase: first slot, slots of a round, and per source its first block,
    its blocks, its blocks of a round and their slots. A phase that ends within
    its first round counts as one round."""
    left, begun, out, first = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), [], 0
    while left:
        quota = shares({s: weights[s] for s in left})
        slots, size = pfair_round(quota, left), sum(quota.values())
        over = [s for s, n in left.items() if len(slots[s]) == n]
        if over:
            end = size = slots[over[0]][-1] + 1
            done = quota = {s: len(x) for s, x in slots.items()}
        else:
            place = lambda s, k: k // quota[s] * size + slots[s][k % quota[s]]
            end = min(place(s, n - 1) for s, n in left.items()) + 1
            rounds, rest = divmod(end, size)
            done = {s: rounds * quota[s] + sum(x < rest for x in slots[s]) for s in left}
        out.append({"slot": first, "size": size, "of": {s: (begun[s], n, quota[s], slots[s]) for s, n in done.items() if n}})
        for s, n in done.items():
            begun[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        first += end
    return out


def schedule(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = 64, default: float = 1.0,
             source_col: str = "source", id_col: str = "doc_id", out: tuple[str, str, str] = ("block", "slot", "position")) -> DataFrame:
    """``docs`` plus ``block`` (number within its source), ``slot`` (place of
    the block in the mixture) and ``position`` (place of the row, from 0)."""
    spark = docs.sparkSession
    weights = dict(weights or {})
    if default <= 0 or any(w <= 0 for w in weights.values()):
        raise ValueError("weights are positive")
    h, part, base, src, n = (fresh(docs, f"__{x}") for x in ("hash", "part", "base", "src", "row"))
    src_of = F.col(source_col).cast("string")
    x = docs.withColumn(h, F.xxhash64(F.col(id_col).cast("string"), F.lit("mix")))
    counts = docs.groupBy(src_of.alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    counts.sort(key=lambda r: (r.s is not None, r.s or ""))
    ranges = 1
    while ranges * RANGE_ROWS < max([0, *(r.n for r in counts)]):
        ranges *= 2
    # hash ranges of a source, their sizes, and the rows before each
    x = x.withColumn(part, F.floor((F.shiftrightunsigned(F.col(h), 1) / F.lit(2.0 ** 63)) * ranges).cast("long"))
    sizes = x.groupBy(src_of.alias(src), part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(src, F.col(part).alias(f"{part}r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    rows = Window.partitionBy(src_of, part).orderBy(h, id_col)
    x = x.withColumn(n, F.row_number().over(rows) - 1)
    if len(counts) * ranges <= 1_000_000:
        sizes = F.broadcast(sizes)  # a row per source and range
    x = x.join(sizes, (src_of.eqNullSafe(F.col(src))) & (F.col(part) == F.col(f"{part}r")))
    x = x.withColumn(n, F.col(n) + F.col(base))
    plan = phases({k: -(-r.n // block) for k, r in enumerate(counts)}, {k: weights.get(r.s, default) for k, r in enumerate(counts)})
    # one row per source, its phases with the slots of a round where they are
    # few: bounded by MAX_SOURCES sources, as many phases, and INLINE slots
    own: dict[int, list] = {k: [] for k in range(len(counts))}
    short = []  # slots of short last blocks and what each lacks
    pieces = []  # slots of long rounds
    for i, p in enumerate(plan):
        for k, (first, many, quota, slots) in p["of"].items():
            inline = p["size"] <= INLINE
            own[k].append((i, first, first + many, quota, p["slot"], p["size"], slots.tolist() if inline else None))
            if not inline:
                pieces += [(k, i, a // PIECE, slots[a:a + PIECE].tolist()) for a in range(0, len(slots), PIECE)]
            if first + many == -(-counts[k].n // block) and counts[k].n % block:
                short.append((p["slot"] + (many - 1) // quota * p["size"] + slots[(many - 1) % quota], block - counts[k].n % block))
    plans, lacks = fresh(x, "__plans"), F.expr("array(" + ", ".join(f"named_struct('s', {s}L, 'n', {m}L)" for s, m in sorted(short)) + ")")
    who = fresh(x, "__who")
    table = spark.createDataFrame([(counts[k].s, k, v) for k, v in own.items()], f"`{src}` string, `{who}` int, `{plans}` array<struct<i:int,lo:long,hi:long,quota:long,s0:long,size:long,at:array<long>>>")
    x = x.drop(src).join(F.broadcast(table), src_of.eqNullSafe(F.col(src)))
    number, phase, slot = fresh(x, "__block"), fresh(x, "__phase"), fresh(x, "__slot")
    x = x.withColumn(number, F.floor(F.col(n) / block).cast("long"))
    x = x.withColumn(phase, F.filter(plans, lambda p: (p["lo"] <= F.col(number)) & (F.col(number) < p["hi"]))[0]).drop(plans)
    at = lambda f: F.col(phase)[f]
    k = F.col(number) - at("lo")
    slots, within = at("at"), k % at("quota")
    if pieces:
        keys = [fresh(x, f"__{c}") for c in ("pwho", "pphase", "ppiece", "pat")]
        long = spark.createDataFrame(pieces, f"`{keys[0]}` int, `{keys[1]}` int, `{keys[2]}` long, `{keys[3]}` array<long>")
        # rows of short rounds find no piece, by keys that spread them
        piece = F.when(slots.isNull(), F.floor(within / PIECE).cast("long")).otherwise(-1 - F.col(n))
        x = x.join(F.broadcast(long) if len(pieces) <= MAX_PIECES else long,
                   (F.col(who) == F.col(keys[0])) & (at("i") == F.col(keys[1])) & (piece == F.col(keys[2])), "left")
        found = F.when(slots.isNull(), F.element_at(keys[3], (within % PIECE + 1).cast("int"))).otherwise(F.element_at(slots, (within + 1).cast("int")))
    else:
        found = F.element_at(slots, (within + 1).cast("int"))
    x = x.withColumn(slot, at("s0") + F.floor(k / at("quota")).cast("long") * at("size") + found)
    less = F.aggregate(lacks, F.lit(0).cast("long"), lambda acc, y: acc + F.when(y["s"] < F.col(slot), y["n"]).otherwise(F.lit(0))) if short else F.lit(0)
    return x.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(number).alias(out[0]), F.col(slot).alias(out[1]),
                    (F.col(slot) * block + F.col(n) % block - less).cast("long").alias(out[2]))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in the order of the mixture:
    range-partitioned and sorted by position, so files read in order give it."""
    names = tuple(fresh(docs, f"__{x}") for x in ("mix_block", "mix_slot", "mix_position"))
    x = schedule(docs, out=names, **how)
    return x.repartitionByRange(partitions(docs.sparkSession), names[2]).sortWithinPartitions(names[2]).drop(*names)


def placed(docs: DataFrame, out: str = "mix_position") -> DataFrame:
    """``docs``, read back from the files that :func:`mixed` was written to,
    plus ``out``, the place of each row in the mixture. A scan promises no order
    of files, so the place is the row's index in its file after the rows of the
    files with smaller part numbers (one row per file goes to the driver). Rows
    that were not read from such files have no place: ``out`` is null."""
    none = docs.withColumn(out, F.lit(None).cast("long"))
    path, at, before = (fresh(docs, f"__{c}") for c in ("path", "at", "before"))
    try:
        meta = docs.metadataColumn("_metadata")
        x = docs.withColumns({path: meta.getField("file_path"), at: meta.getField("row_index")})
    except AnalysisException:  # no files behind these rows
        return none
    files = x.groupBy(path).agg(F.count(F.lit(1)).alias("n")).collect()
    # part number, and the number of the part's file
    names = {f[path]: re.search(r"part-(\d+)-[^/]*?-c(\d+)[^/]*$", f[path]) for f in files}
    if not all(names.values()):
        return none
    rows, total = [], 0
    for f in sorted(files, key=lambda f: tuple(map(int, names[f[path]].groups()))):
        rows.append((f[path], total))
        total += f.n
    starts = docs.sparkSession.createDataFrame(rows, f"`{path}` string, `{before}` long")
    x = x.join(F.broadcast(starts), path)
    return x.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(before) + F.col(at)).alias(out))
