"""WARC archives: round trips, magics inside payloads, splits, edges."""

import base64
import hashlib

import pytest

from ferret.llm import common, warc
from ferret.llm.common import run_dir

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nWARC-Payload-Digest: sha1:" + "A" * 32
        + "\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")


def expected(rows, least=0):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= least and p is not None and first[h or ""] != p
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response",
                    first[h or ""] if again else None))
    return sorted(out, key=str)


ROWS = [(k, f"http://a.example/{k}", t) for k, t in enumerate(
    ["<p>plain</p>", None, "", "ünï ☃" * 50, "<p>plain</p>", "a WARC/1.1\r\n b", FAKE, "x" + FAKE * 3 + "tail", "y" * 40_000 + FAKE,
     "\r\n\r\n", "ends with magic WARC/1.1\r\n", "<p>plain</p>", "WARC/1.1\r\n" * 5, FAKE])] + [(20, None, "z\r\nq"), (21, "http://x/\r\nWARC/1.1\r\n", "u"), (3, "again", "ünï ☃" * 50)]


@pytest.mark.parametrize("split", ["128m", "1000", "97"])
@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, split, least):
    old = [spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, block string").coalesce(2)
    path = run_dir(spark, "warc-test")
    warc.write(df, path, min_payload=least)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = sorted(map(tuple, warc.read(spark, path).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == expected(ROWS, least)


@pytest.mark.parametrize("bits", [1 << 20, 8])
def test_many_revisits(spark, monkeypatch, bits):
    """Above the broadcast limit, with a sparse and a full bitmap."""
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "SIEVE_BITS", bits)
    path = run_dir(spark, "warc-test")
    warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path)
    assert sorted(map(tuple, warc.read(spark, path).collect()), key=str) == expected(ROWS)


def test_empty(spark):
    path = run_dir(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0
