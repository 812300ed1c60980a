"""Merkle manifest against a plain tree and the oracle text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ferret.llm import catalog, merkle
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, pos long, hash string, `left` int, keep_0 string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """Root and, per leaf, its siblings level by level."""
    proofs, level, of = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        runs = [level[k:k + 8] for k in range(0, len(level), 8)]
        for leaf_, at in enumerate(of):
            run, slot = runs[at // 8], at % 8
            proofs[leaf_].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            of[leaf_] = at // 8
        level = [sha(*run) for run in runs]
    return (level[0] if level else None), proofs


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in keys}
    root, above = tree([trees[k][0] for k in keys])
    out = []
    for k, up in zip(keys, above, strict=True):
        for x, proof in zip(sorted(groups[k], key=lambda x: x[:3]), trees[k][1], strict=True):
            out.append((x[3][0], x[2], trees[k][0], root, tuple(proof + up)))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "h", 2, "k") for r in rows], COLUMNS)
    x = merkle.manifest(df, keep={"doc_id": F.col("doc_id")}).withColumn("again", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert all(r.again == r.root for r in x)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in x), key=str)


def test_matches_plain_tree(spark):
    """A group over several blocks and levels, runs of one, a lone leaf, null
    and empty groups, nulls in every column, repeated ids and rows."""
    rng = random.Random(4)
    rows = [(k, f"text {k}", "hot", "s", k) for k in range(1100)] + [(k, "é" * (k % 5), rng.choice(["a", "b", "", "É", None]), "s", k) for k in range(1100, 1400)]
    rows += [(5000, "x" * 300_000, "lone", None, None), (None, None, None, None, None), (7, "other", "hot", "s", 1), (8, "text 8", "hot", "s", 8), (None, "t", "hot", "s", 1)]
    rng.shuffle(rows)
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_small_trees(spark, n):
    rows = [(k, f"t{k}", "one", "s", k) for k in range(n)]
    assert run(spark, rows) == plain(rows)


def test_query_matches_oracle(spark):
    s, d, *_ = compare(spark, catalog.QUERIES["op12_merkle_manifest"], catalog.SQL["op12_merkle_manifest"], SF_SMALL)
    assert s == d and s[0] > 0


def test_tampering_is_found(spark):
    got = catalog.QUERIES["op12_merkle_manifest"](spark, SF_SMALL).collect()
    bad = {r.doc_id for r in got if not r.verified}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    import zlib

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert bad == {d for d, t in texts.items() if zlib.crc32(str(d).encode()) % 3 == 0 and t and t.translate(low) != t} and bad
