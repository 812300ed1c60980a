"""Queries of the training-data operators and their DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import bpe, langid, merkle, minhash, mixing, periodic, quality, rptrees, subwords, suffix, tokenfile, urls, warc
from .common import SPACE_CLASS, run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- 7: quality rules

_WS = r"[^\x20\x09-\x0D]+"
QUALITY_MEASURES_SQL = f"""
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WS}') AS ws,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WS}')) AS ls FROM d),
tok AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, x || ' ' || lead(x, 1) OVER q || ' ' || lead(x, 2) OVER q AS g FROM tok
  WINDOW q AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g WHERE g IS NOT NULL) WHERE c >= 2),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id)"""
QUALITY_FAILS_SQL = " OR ".join(f"({r.fails})" for r in quality.RULES)
_BASE_SQL = " OR ".join(f"({r.fails})" for r in quality.RULES if r.name in quality.BASE)


@register("op7_quality_rules", sql=(
    f"WITH {QUALITY_MEASURES_SQL} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
    f"({_BASE_SQL}) AS base_failed, NOT ({QUALITY_FAILS_SQL}) AS kept FROM m"))
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = quality.Policy(0, quality.BASE)
    return x.select("doc_id", *[f"ledger.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    (~quality.passes("ledger", base)).alias("base_failed"), quality.passes("ledger").alias("kept"))


# ---------------------------------------------------------------- 8: URL filter

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def _url_sql() -> str:
    rules = ", ".join(f"('{r}', '{urls.split_rule(r)[0]}', '{urls.split_rule(r)[1]}', '{v}')" for r, v in URL_RULES)
    return f"""
WITH a AS (SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN '' ELSE
  regexp_extract(substr(url, position('://' IN url) + 3), '^([^?#]*)', 1) END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  CASE WHEN position('/' IN rest) = 0 THEN '' ELSE substr(rest, position('/' IN rest)) END AS path FROM a),
r(rule, h, s, verdict) AS (VALUES {rules}),
j AS (SELECT p.page_id, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict FROM p JOIN r
  ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.s) GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.verdict, '{urls.DEFAULT_VERDICT}') AS verdict
FROM p LEFT JOIN j USING (page_id)"""


@register("op8_url_filter", sql=_url_sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


# ---------------------------------------------------------------- 10: byte-level BPE

@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


# ---------------------------------------------------------------- 1: language identification

@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held)
    profiles = langid.collect_profiles(langid.learn(docs.filter("NOT held_out")))
    return langid.predict(docs, profiles, ["doc_id", "held_out"])


# ---------------------------------------------------------------- 3: mixing sources

MIX_BLOCK = 64


@register("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources to the weights of ``mixing.WEIGHTS``."""
    return mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "source"), mixing.WEIGHTS, block=MIX_BLOCK)


# ---------------------------------------------------------------- 6: token-id files

@register("op6_token_file")
def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "ids")
    tokenfile.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    x = tokenfile.read(spark, path)
    return x.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# ---------------------------------------------------------------- 4: WARC

_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""


@register("op4_warc", sql=_WARC_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, min_payload=0)
    return warc.read(spark, path)


# ---------------------------------------------------------------- 9: MinHash near-duplicates

@register("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, percent=85)


# ---------------------------------------------------------------- 5: embedding near-duplicates

@register("op5_embedding_near_dedup")
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rptrees.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.95)


# ---------------------------------------------------------------- 2: suffix-array dedup

@register("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- 11: quality classifier

QUALITY_THRESHOLD = 0.7


@register("op11_quality_classifier")
def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    labels = table(spark, sf_dir, "labels").filter(~held).select("doc_id", F.col("quality").alias("label"))
    model = subwords.learn(docs.filter("NOT held_out"), labels)
    x = subwords.predict(docs, model, ["doc_id", "held_out"])
    return x.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


# ---------------------------------------------------------------- 12: Merkle manifest

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree_sql(up: str, walk: str, leaves: str) -> str:
    """Levels of the trees over ``leaves(k, pos, n, h)`` and the way of their
    rows ``(id, cur, proof)`` to the top."""
    return f"""
{up}(k, lvl, pos, n, h) AS (SELECT k, 0, pos, n, h FROM {leaves} UNION ALL
  SELECT k, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM {up} WHERE n > 1 GROUP BY k, lvl, pos // 8, n),
{up}_run AS (SELECT k, lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM {up} GROUP BY k, lvl, pos // 8),
{walk}(id, k, lvl, pos, n, cur, proof) AS (SELECT id, k, 0, pos, n, cur, proof FROM {leaves} UNION ALL
  SELECT w.id, w.k, w.lvl + 1, w.pos // 8, (w.n + 7) // 8,
    sha256(array_to_string(hs[:w.pos % 8], '') || w.cur || array_to_string(hs[w.pos % 8 + 2:], '')),
    w.proof || array_to_string(hs[:w.pos % 8], '') || array_to_string(hs[w.pos % 8 + 2:], '')
  FROM {walk} w JOIN {up}_run u ON w.k = u.k AND w.lvl = u.lvl AND w.pos // 8 = u.run WHERE w.n > 1)"""


# crc32 of the decimal doc_id, a step per bit
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]
  for x in string_split(CAST(doc_id AS VARCHAR), '')])), lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)))"""
_MERKLE_SQL = f"""
WITH RECURSIVE a AS (SELECT *, row_number() OVER () AS id, coalesce('=' || lang, '') AS k, {_leaf_sql('text')} AS leaf,
  CASE WHEN {_CRC_SQL} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS low FROM documents),
leaves AS (SELECT id, doc_id, k, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n,
  leaf AS h, coalesce(low, leaf) AS cur, '' AS proof FROM a),
{_tree_sql('up', 'walk', 'leaves')},
tops AS (SELECT k AS tree, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
crowns AS (SELECT w.id, '' AS k, t.pos, t.n, t.subroot AS h, w.cur, w.proof FROM walk w JOIN tops t ON w.k = t.tree WHERE w.n = 1),
top_leaves AS (SELECT DISTINCT k, pos, n, h FROM crowns),
{_tree_sql('crown', 'climb', 'crowns').replace('FROM crowns UNION ALL', 'FROM top_leaves UNION ALL', 1)}
SELECT doc_id, l.h AS leaf, t.subroot, c.h AS root, sha256(e.proof) AS proof_sha256, e.cur AS folded_root, e.cur = c.h AS verified
FROM leaves l JOIN tops t ON l.k = t.tree JOIN climb e ON e.id = l.id AND e.n = 1 JOIN crown c ON c.n = 1"""


@register("op12_merkle_manifest", sql=_MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.COLUMNS)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    low = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in merkle.COLUMNS]
    given = F.when(tampered, merkle.leaf_of(low))
    x = merkle.manifest(docs, keep={"doc_id": F.col("doc_id"), "given": given})
    x = x.withColumn("folded_root", merkle.fold(F.coalesce("given", "leaf"), F.col("proof")))
    return x.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


# ---------------------------------------------------------------- 13: periodic runs

_RUNS_SQL = f"""
WITH a AS (SELECT row_number() OVER () AS id, doc_id, coalesce(regexp_extract_all(text, '{_WS}'), []) AS w, {_CRC_SQL} AS h FROM documents),
b AS (SELECT *, CAST(len(w) AS BIGINT) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS cut FROM a),
c AS (SELECT *, 1 + (n - cut) // (3 + (h // 10) % 8) AS p FROM b),
d AS (SELECT id, doc_id, n, CASE WHEN cut IS NULL THEN w ELSE
  list_transform(range(0, n), lambda i: CASE WHEN i < cut THEN w[i + 1] ELSE w[cut + (i - cut) % p + 1] END) END AS w FROM c),
tok AS (SELECT id, n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
pair AS (SELECT t.id, t.i, u.i - t.i AS q FROM tok t JOIN tok u ON t.id = u.id AND t.x = u.x AND u.i > t.i AND 4 * (u.i - t.i) <= t.n),
isle AS (SELECT id, i, q, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS g FROM pair),
stretch AS (SELECT id, q, min(i) AS s, count(*) + q AS len FROM isle GROUP BY id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT id, s, len, min(q) AS q FROM stretch GROUP BY id, s, len),
r AS (SELECT id, count(*) AS n_runs, list(struct_pack(s := s, len := len, q := q) ORDER BY CAST(len AS DOUBLE) / q DESC, s, q)[1] AS best,
  string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS told, list(struct_pack(a := s + q, b := s + len)) AS gone FROM run GROUP BY id),
drops AS (SELECT DISTINCT id, unnest(range(g.a, g.b)) AS i FROM (SELECT id, unnest(gone) AS g FROM r)),
kept AS (SELECT tok.id, string_agg(x, ' ' ORDER BY tok.i) AS t FROM tok SEMI JOIN r ON tok.id = r.id ANTI JOIN drops ON tok.id = drops.id AND tok.i = drops.i GROUP BY tok.id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period,
  CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
  sha256(CASE WHEN r.id IS NULL THEN array_to_string(w, ' ') ELSE kept.t END) AS collapsed_sha256
FROM d LEFT JOIN r ON d.id = r.id LEFT JOIN kept ON d.id = kept.id"""


def _planted(text, doc_id):
    """Every tenth text (by crc32 of the id) with its end made periodic."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")

    def periodic_from(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat_ws(" ", F.slice(w, 1, a), F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p)))

    held = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic_from(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, held[0]).otherwise(text)


@register("op13_periodic_runs", sql=_RUNS_SQL)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("text"), F.col("doc_id")).alias("text"))
    x = periodic.periodic_runs(docs, ["doc_id"])
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda acc, r: F.when(better(acc, r), r).otherwise(acc))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    x = x.withColumn("best", best)
    return x.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
