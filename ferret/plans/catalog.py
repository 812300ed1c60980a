"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle text per operator of the inventory. Every query reads the given
tables (or tables Spark derived from them) in full.

Column names and roundings are the same on both sides; floats are rounded
to 4-6 digits and arrays are joined to strings so values hash stably.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import analyze as A
from ..functions import porter
from ..functions.scoring import idf_col, norm_col
from ..operators import index as I
from ..operators import ordinals
from ..operators import query as Q
from ..sources import tables as T
from ..session import small
from . import oracle_sql as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str | Callable[[], str]] = {}

# stands for Spark ML's English stop list in oracle text until the text is asked for
_EN_STOPS = "$ENGLISH_STOPS$"


def oracle_text(name: str) -> str:
    """Oracle text of a query. Stop lists are read here and not at import,
    which needs neither Spark's jars nor a session."""
    sql = SQL[name]
    sql = sql() if callable(sql) else sql
    return sql.replace(_EN_STOPS, A.sql_list(A.spark_stop_words("english"))) if _EN_STOPS in sql else sql


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- analysis

@register("tokenize", sql=(
    f"SELECT doc_id, CAST(generate_subscripts(_t, 1) - 1 AS INT) AS pos, unnest(_t) AS token, "
    f"lower(unnest(_t)) AS token_lc FROM (SELECT doc_id, regexp_extract_all(text, '{O.TOK}') AS _t "
    f"FROM documents) _x"))
def q_tokenize(spark, sf):
    """Every token of every whole text with its place."""
    t = A.explode_tokens(T.table(spark, sf, "documents"), "text", ["doc_id"])
    return t.select("doc_id", F.col("pos").cast("int").alias("pos"), F.col("tok").alias("token"),
                    F.lower("tok").alias("token_lc"))


@register("porter_stem", sql=porter.stem_sql(
    f"SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{O.TOK}'))) AS word FROM documents",
    "word", "stem"))
def q_porter_stem(spark, sf):
    """Stem of every distinct word of the whole texts."""
    d = T.table(spark, sf, "documents")
    words = A.explode_tokens(d, "text", []).select(F.lower("tok").alias("word")).distinct()
    return porter.stem_df(words, "word", "stem")


_STOPS = A.sql_list(A.ENGLISH_STOP_WORDS)


@register("stopword_filter", sql=(
    f"SELECT doc_id, CAST(len(_t) AS BIGINT) AS n_tokens, CAST(len(list_filter(_t, lambda x: NOT list_contains([{_STOPS}], "
    f"lower(x)))) AS BIGINT) AS n_kept FROM (SELECT doc_id, regexp_extract_all(text, '{O.TOK}') AS _t FROM documents) _x"))
def q_stopword_filter(spark, sf):
    d = T.table(spark, sf, "documents").select("doc_id", A.tokenize(F.col("text")).alias("_t"))
    stops = F.array(*[F.lit(w) for w in A.ENGLISH_STOP_WORDS])
    kept = F.filter("_t", lambda x: ~F.array_contains(stops, F.lower(x)))
    return d.select("doc_id", F.size("_t").cast("long").alias("n_tokens"), F.size(kept).cast("long").alias("n_kept"))


def _stop_lists() -> list[tuple[str, tuple[str, ...]]]:
    lists = [("standard_english", tuple(A.ENGLISH_STOP_WORDS))]
    for lang in ("english", "french", "german", "spanish"):
        lists.append((f"spark_{lang}", A.spark_stop_words(lang)))
    return lists


def _stop_lists_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {O.lit(n)} AS list_name, unnest([{A.sql_list(ws)}]) AS word" for n, ws in _stop_lists())
    vocab = (f"SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{O.TOK}'))) AS term FROM documents")
    return (f"WITH l AS (SELECT DISTINCT list_name, word FROM ({rows}) _r), v AS ({vocab}), "
            f"n AS (SELECT list_name, count(*) AS n_words FROM l GROUP BY list_name), "
            f"hit AS (SELECT list_name, count(*) AS n_hit FROM l JOIN v ON l.word = v.term GROUP BY list_name) "
            f"SELECT n.list_name, n.n_words, (SELECT count(*) FROM v) - coalesce(hit.n_hit, 0) AS vocab_size "
            f"FROM n LEFT JOIN hit USING (list_name)")


@register("stopword_lists", sql=_stop_lists_sql)
def q_stopword_lists(spark, sf):
    d = T.table(spark, sf, "documents")
    vocab = A.explode_tokens(d, "text", []).select(F.lower("tok").alias("term")).distinct()
    rows = [(n, w) for n, ws in _stop_lists() for w in set(ws)]
    lists = spark.createDataFrame(rows, "list_name string, word string")  # fixed size: a few hundred words
    n_words = lists.groupBy("list_name").agg(F.count(F.lit(1)).alias("n_words"))
    hit = vocab.join(F.broadcast(lists), vocab.term == lists.word).groupBy("list_name").agg(
        F.count(F.lit(1)).alias("n_hit"))
    n_vocab = vocab.count()  # one scalar
    return (n_words.join(hit, "list_name", "left")
            .select("list_name", "n_words", (F.lit(n_vocab) - F.coalesce("n_hit", F.lit(0))).alias("vocab_size")))


def _grid_sql() -> str:
    vocab = f"SELECT DISTINCT unnest(regexp_extract_all({T.TITLE_SQL}, '{O.TOK}')) AS tok FROM documents"
    s1 = porter.stem_sql(vocab, "tok", "st_raw")
    s2 = porter.stem_sql(f"SELECT *, lower(tok) AS lc FROM ({s1}) _a", "lc", "st_lc")
    cfg = " UNION ALL ".join(
        f"SELECT {str(c.lowercase).upper()} AS lowercase, {str(c.stemming).upper()} AS stemming, "
        f"{str(c.stopwords).upper()} AS stopwords" for c in A.CONFIG_GRID)
    term = ("CASE WHEN c.lowercase AND c.stemming THEN v.st_lc WHEN c.lowercase THEN v.lc "
            "WHEN c.stemming THEN v.st_raw ELSE v.tok END")
    return (f"SELECT lowercase, stemming, stopwords, count(DISTINCT term) AS vocab_size FROM ("
            f"SELECT c.lowercase, c.stemming, c.stopwords, {term} AS term FROM ({s2}) v, ({cfg}) c) _g "
            f"WHERE NOT stopwords OR term NOT IN ({_STOPS}) GROUP BY lowercase, stemming, stopwords")


@register("vocab_size_grid", sql=_grid_sql())
def q_vocab_size_grid(spark, sf):
    """Title vocabulary size under the 8 analyzer configurations in one job:
    the distinct raw vocabulary is stemmed once (raw and lowercased), then
    each word fans out to its 8 analyzed forms."""
    d = T.records(spark, sf)
    v = A.explode_tokens(d, "title", []).select("tok").distinct()
    v = porter.stem_df(v, "tok", "st_raw").withColumn("lc", F.lower("tok"))
    v = porter.stem_df(v, "lc", "st_lc")
    cfgs = F.array(*[F.struct(F.lit(c.lowercase).alias("lowercase"), F.lit(c.stemming).alias("stemming"),
                              F.lit(c.stopwords).alias("stopwords")) for c in A.CONFIG_GRID])
    g = v.select("*", F.explode(cfgs).alias("c")).select("c.*", "tok", "lc", "st_raw", "st_lc")
    term = (F.when(F.col("lowercase") & F.col("stemming"), F.col("st_lc")).when(F.col("lowercase"), F.col("lc"))
            .when(F.col("stemming"), F.col("st_raw")).otherwise(F.col("tok")))
    g = g.withColumn("term", term)
    g = g.filter(~F.col("stopwords") | ~F.col("term").isin(A.ENGLISH_STOP_WORDS))
    return g.groupBy("lowercase", "stemming", "stopwords").agg(F.count_distinct("term").alias("vocab_size"))


# ---------------------------------------------------------------- index

@register("build_postings", sql=(
    f"SELECT field, term, doc_id, tf, flen, array_to_string(positions, ',') AS positions "
    f"FROM ({O.postings_sql()}) _p"))
def q_build_postings(spark, sf):
    p = I.build(spark, sf).postings
    return p.select("field", "term", "doc_id", "tf", "flen", F.array_join("positions", ",").alias("positions"))


@register("term_stats", sql=(
    f"SELECT field, term, df, round({O.with_idf()}, 6) AS idf FROM ({O.term_stats_sql()}) _t"))
def q_term_stats(spark, sf):
    ix = I.open_index(spark, sf)
    n_docs = ix.corpus.first()["n_docs"]  # one scalar
    return ix.term_stats.select("field", "term", "df", F.round(idf_col(F.col("df"), F.lit(n_docs)), 6).alias("idf"))


@register("doc_lengths", sql=(
    f"SELECT field, doc_id, CAST(sum(tf) AS INT) AS flen, round({O.norm('field', 'sum(tf)', 'exact')}, 6) AS norm, "
    f"round({O.norm('field', 'sum(tf)', 'lossy')}, 6) AS norm_lossy FROM ({O.postings_sql()}) _p GROUP BY field, doc_id"))
def q_doc_lengths(spark, sf):
    p = I.open_index(spark, sf).postings
    g = p.groupBy("field", "doc_id").agg(F.sum("tf").cast("int").alias("flen"))
    return g.select("field", "doc_id", "flen",
                    F.round(norm_col(F.col("field"), F.col("flen"), "exact"), 6).alias("norm"),
                    F.round(norm_col(F.col("field"), F.col("flen"), "lossy"), 6).alias("norm_lossy"))


# ---------------------------------------------------------------- search

from ..operators import search as S  # noqa: E402
from . import querysets as QS  # noqa: E402


def _topk(qset, units, n=10):
    def fn(spark, sf):
        ix = I.open_index(spark, sf)
        return S.search(ix, qset(spark, sf), n)
    return fn, O.topk_sql(units, n)


for _name, _qs, _units in [("keyword_topk", QS.keyword, QS.KEYWORD_UNITS),
                           ("phrase_match", QS.phrase, QS.PHRASE_UNITS),
                           ("fielded_search", QS.fielded, QS.FIELDED_UNITS),
                           ("boolean_must_should", QS.mixed, QS.MIXED_UNITS)]:
    _fn, _sql = _topk(_qs, _units)
    register(_name, sql=_sql)(_fn)


@register("keyword_match", sql=f"SELECT qid, doc_id, round(score, 4) AS score FROM ({O.scored_sql(QS.KEYWORD_UNITS)}) _s")
def q_keyword_match(spark, sf):
    s = S.score(I.open_index(spark, sf), QS.keyword(spark, sf))
    return s.select("qid", "doc_id", F.round("score", 4).alias("score"))


@register("total_hits", sql=O.total_hits_sql(QS.KEYWORD_UNITS, QS.QIDS))
def q_total_hits(spark, sf):
    q = QS.keyword(spark, sf)
    return S.total_hits(S.score(I.open_index(spark, sf), q), q)


@register("empty_query", sql=O.total_hits_sql(QS.EMPTY_UNITS, QS.QIDS))
def q_empty_query(spark, sf):
    q = QS.empty(spark, sf)
    return S.total_hits(S.score(I.open_index(spark, sf), q), q)


# ---------------------------------------------------------------- evaluation

from ..operators import evaluate as E  # noqa: E402


def _eval_inputs(spark, sf):
    ix = I.open_index(spark, sf)
    hits = S.score(ix, QS.keyword(spark, sf))  # N = 0: all hits are ranked
    qrels, _ = S.materialize(E.qrels_containment(spark, sf, ix))
    topics = T.table(spark, sf, "benchmark").select(F.col("item_id").alias("topic"))
    return hits, qrels, topics


_HITS = f"hits AS ({O.scored_sql(QS.KEYWORD_UNITS)})"


def _curve_ctes() -> str:
    return (f"{_HITS}, qrels AS ({E.QRELS_SQL}), "
            "r AS (SELECT qid AS topic, doc_id, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, "
            "doc_id) AS rank FROM hits), nrel AS (SELECT topic, count(*) AS n_rel FROM qrels GROUP BY topic), "
            "j AS (SELECT r.*, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS rel, coalesce(nrel.n_rel, 0) AS n_rel "
            "FROM r LEFT JOIN qrels q USING (topic, doc_id) LEFT JOIN nrel USING (topic)), "
            "c0 AS (SELECT *, sum(rel) OVER (PARTITION BY topic ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND CURRENT ROW) AS nrelevant FROM j), "
            "c1 AS (SELECT *, coalesce(lag(nrelevant, 1) OVER (PARTITION BY topic ORDER BY rank), 0) AS _prev FROM c0), "
            "c2 AS (SELECT topic, rank, doc_id, rel, n_rel, CAST(nrelevant AS DOUBLE) / rank AS _p, "
            "CASE WHEN n_rel > 0 THEN CAST(nrelevant AS DOUBLE) / n_rel END AS _r FROM c1 "
            "WHERE n_rel = 0 OR _prev < n_rel), "
            "c AS (SELECT *, CASE WHEN _p IS NULL OR _r IS NULL THEN NULL WHEN _p + _r = 0 THEN 0.0 "
            "ELSE 2 * _p * _r / (_p + _r) END AS _f FROM c2)")


@register("eval_curve", sql=(
    f"WITH {_curve_ctes()} SELECT topic, rank, doc_id, rel, n_rel, round(_p, 4) AS precision, "
    f"round(_r, 4) AS recall, round(_f, 4) AS f1 FROM c"))
def q_eval_curve(spark, sf):
    hits, qrels, _ = _eval_inputs(spark, sf)
    return E.curve(hits, qrels).drop("_p", "_r", "_f")


@register("eval_metrics", sql=(
    f"WITH {_curve_ctes()}, n AS (SELECT topic, max(rank) AS N, any_value(n_rel) AS _nrel FROM c GROUP BY topic), "
    "cc AS (SELECT c.*, n.N, n._nrel FROM c JOIN n USING (topic)), "
    "ak AS (SELECT topic, round(_p, 4) AS precision, round(_r, 4) AS recall, round(_f, 4) AS f1 FROM cc "
    "WHERE rank = least(10, N)), "
    "ar AS (SELECT topic, round(_p, 4) AS r_precision FROM cc WHERE rank = CASE WHEN _nrel = 0 THEN N "
    "ELSE least(N, _nrel) END), "
    "g AS (SELECT topic, count(*) AS nrelevant_gt FROM qrels GROUP BY topic) "
    "SELECT b.item_id AS topic, CAST(coalesce(n.N, 0) AS BIGINT) AS N, "
    "CAST(CASE WHEN n.N IS NULL THEN 10 ELSE least(10, n.N) END AS BIGINT) AS k, "
    "CAST(coalesce(g.nrelevant_gt, 0) AS BIGINT) AS nrelevant_gt, ak.precision, ak.recall, ak.f1, ar.r_precision "
    "FROM benchmark b LEFT JOIN n ON n.topic = b.item_id LEFT JOIN g ON g.topic = b.item_id "
    "LEFT JOIN ak ON ak.topic = b.item_id LEFT JOIN ar ON ar.topic = b.item_id"))
def q_eval_metrics(spark, sf):
    hits, qrels, topics = _eval_inputs(spark, sf)
    return E.metrics(hits, qrels, topics, k=10)


_METRICS_TAIL = (
    ", n AS (SELECT topic, max(rank) AS N, any_value(n_rel) AS _nrel FROM c GROUP BY topic), "
    "cc AS (SELECT c.*, n.N, n._nrel FROM c JOIN n USING (topic)), "
    "ak AS (SELECT topic, round(_p, 4) AS precision, round(_r, 4) AS recall, round(_f, 4) AS f1 FROM cc "
    "WHERE rank = least(10, N)), "
    "ar AS (SELECT topic, round(_p, 4) AS r_precision FROM cc WHERE rank = CASE WHEN _nrel = 0 THEN N "
    "ELSE least(N, _nrel) END), "
    "g AS (SELECT topic, count(*) AS nrelevant_gt FROM qrels GROUP BY topic) "
    "SELECT b.item_id AS topic, CAST(coalesce(n.N, 0) AS BIGINT) AS N, "
    "CAST(CASE WHEN n.N IS NULL THEN 10 ELSE least(10, n.N) END AS BIGINT) AS k, "
    "CAST(coalesce(g.nrelevant_gt, 0) AS BIGINT) AS nrelevant_gt, ak.precision, ak.recall, ak.f1, ar.r_precision "
    "FROM benchmark b LEFT JOIN n ON n.topic = b.item_id LEFT JOIN g ON g.topic = b.item_id "
    "LEFT JOIN ak ON ak.topic = b.item_id LEFT JOIN ar ON ar.topic = b.item_id")
_CONTAINS_CTES = _curve_ctes().replace(
    "j AS (SELECT r.*, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS rel, coalesce(nrel.n_rel, 0) AS n_rel "
    "FROM r LEFT JOIN qrels q USING (topic, doc_id) LEFT JOIN nrel USING (topic))",
    "j AS (SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM qrels q WHERE q.topic = r.topic AND "
    "contains(CAST(q.doc_id AS VARCHAR), CAST(r.doc_id AS VARCHAR))) THEN 1 ELSE 0 END AS rel, "
    "coalesce(nrel.n_rel, 0) AS n_rel FROM r LEFT JOIN nrel USING (topic))")


@register("eval_contains", sql=f"WITH {_CONTAINS_CTES}{_METRICS_TAIL}")
def q_eval_contains(spark, sf):
    """Metrics with the original substring relevance rule."""
    hits, qrels, topics = _eval_inputs(spark, sf)
    hits, _ = S.materialize(hits)  # read for the rule and for the ranks
    return E.metrics(hits, qrels, topics, k=10, rel=E.contains_relevance(hits, qrels))


@register("qrels", sql=E.QRELS_SQL)
def q_qrels(spark, sf):
    return E.qrels_containment(spark, sf, I.open_index(spark, sf))


# ---------------------------------------------------------------- pooling

_TIES_SQL = (f"WITH {_HITS} SELECT qid, doc_id, round(score, 4) AS score, rnk FROM (SELECT *, rank() OVER "
             f"(PARTITION BY qid ORDER BY round(score, 6) DESC) AS rnk FROM hits) t WHERE rnk <= 10")


@register("topk_with_ties", sql=_TIES_SQL)
def q_topk_with_ties(spark, sf):
    hits = S.score(I.open_index(spark, sf), QS.keyword(spark, sf))
    return E.top_with_ties(hits, 10).select("qid", "doc_id", F.round("score", 4).alias("score"),
                                            F.col("rnk").cast("long").alias("rnk"))


def _pool(spark, sf):
    return q_topk_with_ties(spark, sf).select("doc_id").distinct()


_POOL = f"pool AS (SELECT DISTINCT doc_id FROM ({_TIES_SQL}) _t)"


@register("pool_union", sql=f"WITH {_POOL} SELECT doc_id FROM pool")
def q_pool_union(spark, sf):
    return _pool(spark, sf)


@register("pool_semi", sql=f"WITH {_POOL} SELECT r.* FROM ({T.RECORDS_SQL}) r SEMI JOIN pool USING (doc_id)")
def q_pool_semi(spark, sf):
    return T.records(spark, sf).join(_pool(spark, sf), "doc_id", "left_semi")


POOL_SIZE = E.POOL_SIZE


@register("pool_random_fill", sql=(
    f"WITH {_POOL}, rnd AS (SELECT doc_id FROM documents ANTI JOIN pool USING (doc_id) "
    f"ORDER BY md5(CAST(doc_id AS VARCHAR) || '0') LIMIT greatest(0, {POOL_SIZE} - (SELECT count(*) FROM pool))) "
    f"SELECT doc_id, 'pool' AS origin FROM pool UNION ALL SELECT doc_id, 'random' AS origin FROM rnd"))
def q_pool_random_fill(spark, sf):
    """Test collection = pool + a seeded pseudo-random sample of the other
    documents, up to 300 in all (ordered by a hash of the id: deterministic,
    a bounded top-n instead of a global sort)."""
    return E.fill_pool(_pool(spark, sf), T.table(spark, sf, "documents").select("doc_id"), POOL_SIZE)


def _authors_joined(spark, sf):
    a = T.authors(spark, sf)
    return a.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "author"))),
                                                            lambda s: s["author"]), ", ").alias("authors"))


_AUTH_SQL = ("SELECT conv_id AS doc_id, string_agg(text, ', ' ORDER BY turn) AS authors FROM conversations "
             "WHERE text IS NOT NULL GROUP BY conv_id")


@register("multi_value_join", sql=_AUTH_SQL)
def q_multi_value_join(spark, sf):
    return _authors_joined(spark, sf)


@register("pool_listing", sql=(
    f"WITH {_POOL} SELECT n, CAST(n AS VARCHAR) || ') ' || CAST(r.doc_id AS VARCHAR) || chr(10) || ' title: ' || "
    f"coalesce(r.title, '') || chr(10) || ' authors: ' || coalesce(a.authors, '') || chr(10) || ' year: ' || "
    f"coalesce(r.year, '') || chr(10) || ' venue: ' || coalesce(r.venue, '') AS listing FROM "
    f"(SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM ({T.RECORDS_SQL}) r0 SEMI JOIN pool USING (doc_id)) r "
    f"LEFT JOIN ({_AUTH_SQL}) a USING (doc_id)"))
def q_pool_listing(spark, sf):
    """Human-readable listing of the pool; ordinals come from a range
    partitioning and the counts of its pieces."""
    pool = ordinals.placed(_pool(spark, sf), ["doc_id"], out="n").withColumn("n", F.col("n") + 1)
    rec = T.records(spark, sf).join(small(pool), "doc_id")
    rec = rec.join(_authors_joined(spark, sf), "doc_id", "left")
    nl = F.lit("\n")
    line = F.concat(F.col("n").cast("string"), F.lit(") "), F.col("doc_id").cast("string"), nl, F.lit(" title: "),
                    F.coalesce("title", F.lit("")), nl, F.lit(" authors: "), F.coalesce("authors", F.lit("")), nl,
                    F.lit(" year: "), F.coalesce("year", F.lit("")), nl, F.lit(" venue: "),
                    F.coalesce("venue", F.lit("")))
    return rec.select(F.col("n").cast("long").alias("n"), line.alias("listing"))


@register("qrels_template", sql=(
    f"WITH {_POOL} SELECT 'TOPIC_NUM' || chr(9) || '0' || chr(9) || CAST(doc_id AS VARCHAR) || chr(9) || ' ' "
    f"AS line FROM pool"))
def q_qrels_template(spark, sf):
    t = F.lit("\t")
    return _pool(spark, sf).select(F.concat(F.lit("TOPIC_NUM"), t, F.lit("0"), t, F.col("doc_id").cast("string"),
                                            t, F.lit(" ")).alias("line"))


# ---------------------------------------------------------------- results

LINK_PREFIX = "rec/"


_FMT_SQL = (
    f"WITH t AS ({O.topk_sql(QS.KEYWORD_UNITS, 10)}) SELECT t.qid, t.rank, round(t.score, 2) AS score, "
    f"CAST(t.doc_id AS VARCHAR) AS key, regexp_replace(r.title, '\\.$', '') AS title, coalesce(a.authors, '') AS authors, "
    f"r.year, r.venue, '{LINK_PREFIX}' || CAST(t.doc_id AS VARCHAR) AS link FROM t JOIN ({T.RECORDS_SQL}) r USING (doc_id) "
    f"LEFT JOIN ({_AUTH_SQL}) a USING (doc_id)")


@register("format_results", sql=_FMT_SQL)
def q_format_results(spark, sf):
    """Late fetch of stored fields for the top 10 only: the hits look their
    documents up in the id buckets of the stored fields, trailing dot removed,
    authors joined, link built."""
    ix = I.open_index(spark, sf)
    top, _ = S.materialize(S.search(ix, QS.keyword(spark, sf), 10))
    j = I.fetch(ix, top.filter("rank <= 10"), lambda: T.records(spark, sf).join(_authors_joined(spark, sf), "doc_id", "left"))
    return j.select("qid", "rank", F.round("score", 2).alias("score"), F.col("doc_id").cast("string").alias("key"),
                    F.regexp_replace("title", r"\.$", "").alias("title"), F.coalesce("authors", F.lit("")).alias("authors"),
                    "year", "venue", F.concat(F.lit(LINK_PREFIX), F.col("doc_id").cast("string")).alias("link"))


# ---------------------------------------------------------------- similarity

from ..operators import similar as SIM  # noqa: E402

_GT_SQL = (f"SELECT venue, year, doc_id, lower(title) AS title FROM ({T.RECORDS_SQL}) r "
           "WHERE title IS NOT NULL AND venue IS NOT NULL AND year IS NOT NULL")
_BOW_SQL = (f"WITH t AS (SELECT venue, year, unnest(regexp_extract_all(title, '{SIM.BOW_RE}')) AS term FROM ({_GT_SQL}) g), "
            f"c AS (SELECT venue, year, term, count(*) AS freq FROM t WHERE term NOT IN ({_EN_STOPS}) "
            f"GROUP BY venue, year, term) SELECT venue, year, term, freq FROM c WHERE term IN "
            f"(SELECT term FROM c GROUP BY term HAVING count(*) >= 10)")


@register("group_titles", sql=(
    f"SELECT venue, year, count(*) AS n_titles, sum(length(title)) AS n_chars FROM ({_GT_SQL}) g GROUP BY venue, year"))
def q_group_titles(spark, sf):
    g = SIM.group_titles(spark, sf)
    return g.groupBy("venue", "year").agg(F.count(F.lit(1)).alias("n_titles"),
                                          F.sum(F.length("title")).alias("n_chars"))


@register("bow_terms", sql=_BOW_SQL)
def q_bow_terms(spark, sf):
    return SIM.bow(spark, sf)


def _bow_requests(b: DataFrame) -> DataFrame:
    """One request per venue: its English group (bounded by the venues)."""
    r = b.filter(F.col("year") == "en")
    return r.select(F.col("venue").alias("r_venue"), F.col("year").alias("r_year"), "term", "freq")


@register("similar_groups_bow", sql=(
    f"WITH b AS ({_BOW_SQL}), r AS (SELECT venue AS r_venue, year AS r_year, term, freq AS rv FROM b WHERE year = 'en'), "
    "n AS (SELECT venue, year, sqrt(sum(freq * freq)) AS nn FROM b GROUP BY venue, year), "
    "rn AS (SELECT r_venue, r_year, sqrt(sum(rv * rv)) AS rnn FROM r GROUP BY r_venue, r_year), "
    "d AS (SELECT r_venue, r_year, venue, year, sum(freq * rv) AS dot FROM b JOIN r USING (term) "
    "GROUP BY r_venue, r_year, venue, year), "
    "s AS (SELECT d.r_venue, d.r_year, d.venue, d.year, dot / nn / rnn AS sim FROM d JOIN n USING (venue, year) "
    "JOIN rn USING (r_venue, r_year) WHERE NOT (d.r_venue = d.venue AND d.r_year = d.year)) "
    "SELECT r_venue, r_year, venue, year, round(sim, 6) AS similarity, rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY r_venue, r_year ORDER BY round(sim, 6) DESC, venue, year) AS rank FROM s) x WHERE rank <= 5"))
def q_similar_groups_bow(spark, sf):
    b, _ = S.materialize(SIM.bow(spark, sf))
    reqs = _bow_requests(b)
    return SIM.cosine_requests(b, reqs, ["venue", "year"], "term", "freq", k=5)


@register("cosine_topk", sql=(
    "WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i "
    "FROM embeddings), c AS (SELECT label AS r_label, i, avg(CAST(x AS DOUBLE)) AS cx FROM e GROUP BY label, i), "
    "n AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS nn FROM e GROUP BY vec_id), "
    "cn AS (SELECT r_label, sqrt(sum(cx * cx)) AS cnn FROM c GROUP BY r_label), "
    "d AS (SELECT c.r_label, e.vec_id, sum(CAST(e.x AS DOUBLE) * c.cx) AS dot FROM e JOIN c USING (i) "
    "GROUP BY c.r_label, e.vec_id), "
    "s AS (SELECT d.r_label, d.vec_id, dot / nn / cnn AS sim FROM d JOIN n USING (vec_id) JOIN cn USING (r_label)) "
    "SELECT r_label, vec_id, round(sim, 6) AS similarity, rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY r_label ORDER BY round(sim, 6) DESC, vec_id) AS rank FROM s) x WHERE rank <= 10"))
def q_cosine_topk(spark, sf):
    """Top-10 vectors by cosine against each label's centroid."""
    emb = T.table(spark, sf, "embeddings")
    return SIM.dense_topk(emb, "vec_id", "embedding", SIM.centroids(emb), k=10)


@register("lda_corpus_stats", sql=(
    f"WITH b AS ({_BOW_SQL}) SELECT (SELECT count(*) FROM (SELECT DISTINCT venue, year FROM b)) AS n_groups, "
    "(SELECT count(DISTINCT term) FROM b) AS n_words, (SELECT sum(freq) FROM b) AS n_tokens"))
def q_lda_corpus_stats(spark, sf):
    b = SIM.bow(spark, sf)
    return b.agg(F.count_distinct("venue", "year").alias("n_groups"), F.count_distinct("term").alias("n_words"),
                 F.sum("freq").alias("n_tokens"))


def _lda(spark, sf, k=10, max_iter=100):
    corpus, vocab, _ = SIM.lda_corpus(spark, sf)
    return SIM.lda_fit(corpus, k=k, max_iter=max_iter, seed=0), corpus, vocab


@register("lda_topic_words")
def q_lda_topic_words(spark, sf):
    """Top 8 words per topic (rows-only check: LDA is iterative)."""
    model, _, vocab = _lda(spark, sf)
    return SIM.topic_words(model, vocab, 8)


@register("lda_likelihood")
def q_lda_likelihood(spark, sf):
    """Likelihood bound and perplexity after 1, 10 and 100 iterations."""
    corpus, _, _ = SIM.lda_corpus(spark, sf)
    return SIM.lda_steps(corpus, steps=(1, 10, 100))


@register("lda_similar_groups")
def q_lda_similar_groups(spark, sf):
    """Cosine of LDA topic distributions: each venue's English group against
    all groups, top 5 (rows-only check)."""
    model, corpus, _ = _lda(spark, sf)
    td = model.transform(corpus).select("venue", "year", F.posexplode("topicDistribution").alias("i", "x"))
    reqs = td.filter(F.col("year") == "en").select(F.col("venue").alias("r_venue"), F.col("year").alias("r_year"),
                                                  "i", "x")
    return SIM.cosine_requests(td, reqs, ["venue", "year"], "i", "x", k=5)


@register("group_lookup", sql=(
    f"WITH b AS ({_BOW_SQL}), g AS (SELECT venue, year, count(*) AS n_terms FROM b GROUP BY venue, year), "
    "r AS (SELECT DISTINCT source AS venue, unnest(['en', 'de', 'xx']) AS year FROM documents WHERE source IS NOT NULL) "
    "SELECT r.venue, r.year, g.venue IS NOT NULL AS found, g.n_terms FROM r LEFT JOIN g USING (venue, year)"))
def q_group_lookup(spark, sf):
    """Requested (venue, year) groups and whether the data has them: an unknown
    group is one row that says so."""
    groups = SIM.bow(spark, sf).groupBy("venue", "year").agg(F.count(F.lit(1)).alias("n_terms"))
    venues = T.records(spark, sf).filter("venue IS NOT NULL").select("venue").distinct()
    asked = venues.select("venue", F.explode(F.array(*[F.lit(y) for y in ("en", "de", "xx")])).alias("year"))
    return SIM.looked_up(asked, groups, ["venue", "year"])


# ---------------------------------------------------------------- topics

from ..operators import topics as TP  # noqa: E402

_NP_SQL = (
    f"WITH r AS (SELECT doc_id, year, regexp_extract_all(lower(title), {O.lit(TP.TAG_TOKEN_RE)}) AS toks "
    f"FROM ({T.RECORDS_SQL}) r0), "
    f"tg AS (SELECT doc_id, year, array_to_string(list_transform(toks, lambda w: w || '/' || ({TP.tag_sql('w')})), ' ') "
    f"|| ' ' AS tagged FROM r), "
    f"ch AS (SELECT doc_id, year, unnest(_c) AS chunk, generate_subscripts(_c, 1) - 1 AS idx FROM "
    f"(SELECT *, regexp_extract_all(tagged, '{TP.CHUNK_RE}') AS _c FROM tg) x) "
    f"SELECT doc_id, year, idx, trim(regexp_replace(chunk, '/\\S+', '', 'g')) AS phrase, "
    f"len(string_split(trim(regexp_replace(chunk, '/\\S+', '', 'g')), ' ')) AS n_words FROM ch")


@register("noun_phrases", sql=_NP_SQL)
def q_noun_phrases(spark, sf):
    return TP.noun_phrases(T.records(spark, sf), ["doc_id", "year"])


@register("popular_topics", sql=(
    f"WITH np AS ({_NP_SQL}), c AS (SELECT year, phrase, n_words, count(*) AS cnt FROM np GROUP BY year, phrase, n_words), "
    "u AS (SELECT year, CAST(floor(count(*) * 0.01) AS BIGINT) AS top1p FROM c WHERE n_words = 1 GROUP BY year), "
    "r AS (SELECT c.*, coalesce(u.top1p, 0) AS top1p, row_number() OVER (PARTITION BY c.year, n_words "
    "ORDER BY cnt DESC, phrase) AS _r FROM c LEFT JOIN u USING (year) WHERE n_words <= 3), "
    "k AS (SELECT * FROM r WHERE _r > CASE WHEN n_words = 1 THEN top1p ELSE 0 END "
    "AND _r <= CASE WHEN n_words = 1 THEN top1p ELSE 0 END + 10) "
    "SELECT year, phrase, cnt, rank FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY cnt DESC, phrase) "
    "AS rank FROM k) z WHERE rank <= 10"))
def q_popular_topics(spark, sf):
    return TP.popular(TP.noun_phrases(T.records(spark, sf), ["doc_id", "year"]), "year", 10)


# ---------------------------------------------------------------- cleaning

from ..functions import text as TX  # noqa: E402


@register("strip_markup", sql=(
    f"SELECT page_id, length({TX.strip_markup_sql('html')}) AS n_chars, md5({TX.strip_markup_sql('html')}) AS digest "
    "FROM pages"))
def q_strip_markup(spark, sf):
    p = T.table(spark, sf, "pages").select("page_id", TX.strip_markup(F.col("html")).alias("s"))
    return p.select("page_id", F.length("s").alias("n_chars"), F.md5("s").alias("digest"))


@register("unescape_entities", sql=(
    f"SELECT page_id, length({TX.unescape_sql('html')}) AS n_chars, md5({TX.unescape_sql('html')}) AS digest FROM pages"))
def q_unescape_entities(spark, sf):
    p = T.table(spark, sf, "pages").select("page_id", TX.unescape(F.col("html")).alias("s"))
    return p.select("page_id", F.length("s").alias("n_chars"), F.md5("s").alias("digest"))


@register("page_snippet", sql=f"SELECT page_id, {TX.snippet_sql('html')} AS snippet FROM pages")
def q_page_snippet(spark, sf):
    return T.table(spark, sf, "pages").select("page_id", TX.snippet(F.col("html")).alias("snippet"))


@register("url_key", sql=f"SELECT page_id, substring(url, {TX.URL_KEY_OFFSET + 1}) AS key FROM pages")
def q_url_key(spark, sf):
    return T.table(spark, sf, "pages").select("page_id", TX.url_key(F.col("url")).alias("key"))


_YEAR_W = 2  # width of the year facet in the data (language codes)


@register("composite_key_split", sql=(
    f"SELECT venue, year, venue || year AS gkey, substring(venue || year, 1, length(venue || year) - {_YEAR_W}) "
    f"AS venue_part, substring(venue || year, length(venue || year) - {_YEAR_W - 1}, {_YEAR_W}) AS year_part "
    f"FROM (SELECT DISTINCT venue, year FROM ({T.RECORDS_SQL}) r WHERE venue IS NOT NULL AND year IS NOT NULL) g"))
def q_composite_key_split(spark, sf):
    g = T.records(spark, sf).dropna(subset=["venue", "year"]).select("venue", "year").distinct()
    key = F.concat("venue", "year")
    v, y = TX.split_composite(key, _YEAR_W)
    return g.select("venue", "year", key.alias("gkey"), v.alias("venue_part"), y.alias("year_part"))


@register("catch_all_field", sql=(
    f"SELECT d.doc_id, len(regexp_extract_all(concat_ws(' ', d.text, a.authors, d.lang, d.source), '{O.TOK}')) "
    f"AS n_tokens FROM documents d LEFT JOIN (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS authors "
    f"FROM conversations GROUP BY conv_id) a ON a.conv_id = d.doc_id"))
def q_catch_all_field(spark, sf):
    """Catch-all text of a record (the whole text with its title, authors,
    year, venue in record order), counted in tokens."""
    d = T.table(spark, sf, "documents")
    a = T.authors(spark, sf).groupBy("doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "author"))), lambda s: s["author"]),
                     " ").alias("authors"))
    j = d.join(a, "doc_id", "left")
    allf = F.concat_ws(" ", F.col("text"), F.col("authors"), F.col("lang"), F.col("source"))
    return j.select("doc_id", F.size(A.tokenize(allf)).alias("n_tokens"))


@register("reject_split", sql=(
    f"SELECT doc_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason FROM "
    f"(SELECT doc_id, CASE WHEN title IS NULL OR trim(title) = '' THEN 'missing title' "
    f"WHEN venue IS NULL THEN 'missing venue' WHEN year IS NULL THEN 'missing year' END AS reason "
    f"FROM ({T.RECORDS_SQL}) r) x"))
def q_reject_split(spark, sf):
    """Required-field check: every record lands in accepted or rejected
    (with a reason); a bad record never stops the job."""
    r = T.records(spark, sf)
    reason = (F.when(F.col("title").isNull() | (F.trim("title") == ""), F.lit("missing title"))
              .when(F.col("venue").isNull(), F.lit("missing venue"))
              .when(F.col("year").isNull(), F.lit("missing year")))
    r = r.select("doc_id", reason.alias("reason"))
    return r.select("doc_id", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("status"),
                    "reason")


@register("facet_titles", sql=f"SELECT doc_id, title FROM ({T.RECORDS_SQL}) r WHERE year = 'en'")
def q_facet_titles(spark, sf):
    """All titles of one exact facet value (no limit); the predicate reaches
    the parquet scan."""
    return T.records(spark, sf).filter(F.col("year") == "en").select("doc_id", "title")


@register("lossy_norm", sql=(
    f"SELECT DISTINCT flen, round({O.norm('field', 'flen', 'exact')}, 6) AS norm, "
    f"round({O.norm('field', 'flen', 'lossy')}, 6) AS norm_lossy FROM ({O.postings_sql()}) p WHERE field = 'title'"))
def q_lossy_norm(spark, sf):
    p = I.open_index(spark, sf).postings.filter(F.col("field") == "title").select("field", "flen").distinct()
    return p.select("flen", F.round(norm_col(F.col("field"), F.col("flen"), "exact"), 6).alias("norm"),
                    F.round(norm_col(F.col("field"), F.col("flen"), "lossy"), 6).alias("norm_lossy")).distinct()


# ---------------------------------------------------------------- query strings

def _topic_strings(spark, sf):
    """Four query strings per benchmark passage, in the shapes of the test
    topics: free text, one quoted phrase, field + phrase + facet, two fields."""
    b = T.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.regexp_replace("text", '"', "").alias("t"))
    shapes = F.array(
        F.struct(F.lit(0).alias("shape"), F.col("t").alias("q")),
        F.struct(F.lit(1).alias("shape"), F.concat(F.lit('"'), "t", F.lit('"')).alias("q")),
        F.struct(F.lit(2).alias("shape"), F.concat(F.lit('title:"'), "t", F.lit('" year:en')).alias("q")),
        F.struct(F.lit(3).alias("shape"), F.concat(F.lit("authors:"), "t", F.lit(" venue:src1")).alias("q")))
    return b.select("qid", F.explode(shapes).alias("s")).select("qid", "s.shape", "s.q")


_TOPIC_SQL = ("SELECT item_id AS qid, 0 AS shape, replace(text, '\"', '') AS q FROM benchmark UNION ALL "
              "SELECT item_id, 1, '\"' || replace(text, '\"', '') || '\"' FROM benchmark UNION ALL "
              "SELECT item_id, 2, 'title:\"' || replace(text, '\"', '') || '\" year:en' FROM benchmark UNION ALL "
              "SELECT item_id, 3, 'authors:' || replace(text, '\"', '') || ' venue:src1' FROM benchmark")


@register("query_phrases", sql=(
    "SELECT qid, shape, array_to_string(regexp_extract_all(q, '\"([^\"]*)\"', 1), '|') AS phrases, "
    "len(regexp_extract_all(q, '\"([^\"]*)\"', 1)) AS n_phrases, "
    f"trim(regexp_replace(q, '\"[^\"]*\"', '', 'g')) AS rest FROM ({_TOPIC_SQL}) t"))
def q_query_phrases(spark, sf):
    t = _topic_strings(spark, sf)
    ph = F.regexp_extract_all("q", F.lit('"([^"]*)"'), 1)
    return t.select("qid", "shape", F.array_join(ph, "|").alias("phrases"), F.size(ph).alias("n_phrases"),
                    F.trim(F.regexp_replace("q", '"[^"]*"', "")).alias("rest"))


@register("query_rewrite", sql=(
    "SELECT qid, shape, array_to_string(list_transform(string_split(replace(q, 'authors', 'author'), '\"'), "
    "lambda x, i: CASE WHEN i % 2 = 0 AND i < len(string_split(q, '\"')) THEN replace(x, ' ', '.') WHEN i % 2 = 0 THEN '\"' || x ELSE x END), '') AS rewritten "
    f"FROM ({_TOPIC_SQL}) t"))
def q_query_rewrite(spark, sf):
    """Rewrite for a remote dialect: ``authors`` -> ``author``, each quoted
    phrase becomes its words joined by dots, quotes dropped. Text after an
    unclosed quote stays as it is."""
    t = _topic_strings(spark, sf)
    parts = F.split(F.replace("q", F.lit("authors"), F.lit("author")), '"', -1)
    closed = F.replace("q", F.lit("authors"), F.lit("author"))
    n = F.size(F.split(closed, '"', -1))
    rw = F.transform(parts, lambda x, i: F.when((i % 2 == 1) & (i + 1 < n), F.replace(x, F.lit(" "), F.lit(".")))
                     .when(i % 2 == 1, F.concat(F.lit('"'), x)).otherwise(x))
    return t.select("qid", "shape", F.array_join(rw, "").alias("rewritten"))


@register("query_fields", sql=(
    "WITH t AS (SELECT qid, shape, q, string_split(q, ':') AS parts FROM (" + _TOPIC_SQL + ") x), "
    "p AS (SELECT qid, shape, q, parts, unnest(range(1, greatest(len(parts), 2))) AS i FROM t WHERE len(parts) > 1), "
    "kv AS (SELECT qid, shape, i, string_split(trim(parts[i]), ' ')[-1] AS field, "
    "trim(CASE WHEN i + 1 < len(parts) THEN array_to_string(string_split(trim(parts[i + 1]), ' ')[1:-2], ' ') "
    "ELSE trim(parts[i + 1]) END) AS value FROM p), "
    "last AS (SELECT qid, shape, field, arg_max(value, i) AS value FROM kv GROUP BY qid, shape, field) "
    "SELECT qid, shape, '_text' AS field, CASE WHEN len(parts) > 1 THEN "
    "array_to_string(string_split(parts[1], ' ')[1:-2], ' ') ELSE q END AS value FROM t "
    "UNION ALL SELECT qid, shape, field, value FROM last WHERE value <> ''"))
def q_query_fields(spark, sf):
    """Split each topic string into free text and a field map (a repeated
    field keeps its last value, empty values are dropped), long form."""
    t = _topic_strings(spark, sf)
    free, pairs = Q.split_fields(F.col("q"))
    kv = t.select("qid", "shape", F.posexplode(pairs).alias("i", "kv")).select("qid", "shape", "i", "kv.*")
    last = kv.groupBy("qid", "shape", "field").agg(F.max_by("value", "i").alias("value")).filter(F.col("value") != "")
    return t.select("qid", "shape", F.lit("_text").alias("field"), free.alias("value")).unionByName(last)


_FIELDS_SQL = SQL["query_fields"]
_TOPIC_UNITS = (f"SELECT qid, 0 AS u, 'content' AS field, trim(value) AS text FROM (SELECT qid * 4 + shape AS qid, field, value FROM ({_FIELDS_SQL}) a) b "
                "WHERE field = '_text' AND trim(value) <> '' UNION ALL SELECT qid * 4 + shape AS qid, row_number() OVER (PARTITION BY qid, shape "
                f"ORDER BY field) AS u, field, value AS text FROM ({_FIELDS_SQL}) c WHERE field <> '_text' AND trim(value) <> ''")
_SHAPES = "(SELECT unnest(range(4)) AS s)"
_TOPIC_CURVE = (_curve_ctes().replace(_HITS, f"hits AS ({O.scored_sql(_TOPIC_UNITS)})")
                .replace(f"qrels AS ({E.QRELS_SQL})", f"qrels AS (SELECT topic * 4 + s AS topic, doc_id FROM ({E.QRELS_SQL}) q0, {_SHAPES} s0)"))


@register("eval_topics", sql=f"WITH {_TOPIC_CURVE}" + _METRICS_TAIL.replace("FROM benchmark b", f"FROM (SELECT item_id * 4 + s AS item_id FROM benchmark, {_SHAPES} s1) b"))
def q_eval_topics(spark, sf):
    """Metrics of query strings in the four shapes of the test topics (topic =
    4 * passage + shape): each string is parsed, searched and judged."""
    ix = I.open_index(spark, sf)
    t = _topic_strings(spark, sf).select((F.col("qid") * 4 + F.col("shape")).alias("qid"), "q")
    queries, _ = S.materialize(Q.parse(t))
    shapes = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("shape")
    qrels, _ = S.materialize(E.qrels_containment(spark, sf, ix).select("topic", "doc_id", shapes).select((F.col("topic") * 4 + F.col("shape")).alias("topic"), "doc_id"))
    return E.metrics(S.score(ix, queries), qrels, t.select(F.col("qid").alias("topic")), k=10)


# ---------------------------------------------------------------- multi-term operators

from ..operators import dictionary as D  # noqa: E402
from ..operators import terms as TM  # noqa: E402

_PT_SQL = O.analyzed_sql(
    f"SELECT item_id AS qid, 'content' AS field, unnest(_t) AS tok, generate_subscripts(_t, 1) - 1 AS pos "
    f"FROM (SELECT item_id, regexp_extract_all(text, '{O.TOK}') AS _t FROM benchmark) _b", A.STANDARD, ())
_TS_SQL = f"ts AS ({O.term_stats_sql()})"


_EX_TERM = ("ex AS (SELECT qid, term FROM (SELECT x.qid, x.term, row_number() OVER (PARTITION BY x.qid ORDER BY "
            "ts.df DESC, x.term) AS r FROM (SELECT DISTINCT qid, term FROM pt) x JOIN ts ON ts.field = 'content' "
            "AND ts.term = x.term) y WHERE r = 1)")
_RARE_TERM = _EX_TERM.replace("ex AS", "rare AS").replace("ts.df DESC", "ts.df ASC")
_POST = f"post AS ({O.postings_sql()})"


@register("exclude_term", sql=(
    f"WITH {_HITS}, {_POST}, {_TS_SQL}, pt AS ({_PT_SQL}), {_EX_TERM}, "
    "exd AS (SELECT DISTINCT ex.qid, p.doc_id FROM ex JOIN post p ON p.field = 'content' AND p.term = ex.term), "
    "h AS (SELECT * FROM hits ANTI JOIN exd USING (qid, doc_id)) "
    "SELECT qid, rank, doc_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY "
    "round(score, 6) DESC, doc_id) AS rank FROM h) z WHERE rank <= 10"))
def q_exclude_term(spark, sf):
    """Keyword search with the query's most common term prohibited (``-term``):
    it takes documents out and does not score."""
    ix = I.open_index(spark, sf)
    ex = TM.most_common_term(TM.passage_terms(spark, sf), ix)
    return S.search(ix, QS.with_words(spark, sf, ex.select("qid", F.concat(F.lit("-"), "term").alias("word"))), 10, operators=True)


@register("boosted_term", sql=(O.topk_sql(QS.KEYWORD_UNITS, 10, extra=(
    f"pt AS ({_PT_SQL}), {_RARE_TERM}, xl AS (SELECT qid, 0 AS u, 'content' AS field, 100000 AS b, 0 AS c, 'term' AS kind, term, "
    "NULL AS pterms, 2.5 AS boost, 'K' AS grp, '0:K' AS ga, FALSE AS must, FALSE AS b_all FROM rare), "
    "xt AS (SELECT qid, '0:K' AS ga, 0 AS b, term FROM rare WHERE FALSE)"))))
def q_boosted_term(spark, sf):
    """Keyword search with the query's rarest term once more at ``^2.5``."""
    ix = I.open_index(spark, sf)
    rare = TM.rarest_term(TM.passage_terms(spark, sf), ix)
    return S.search(ix, QS.with_words(spark, sf, rare.select("qid", F.concat("term", F.lit("^2.5")).alias("word"))), 10, operators=True)


def _multi_sql(words: str, matches: str, more: str = "") -> str:
    """Top 10 of queries that are constant-score clauses alone: ``words(qid,
    term, boost, ...)`` (distinct) and how a leaf ``w`` matches a term ``v.term``."""
    none = "SELECT item_id AS qid, 0 AS u, 'content' AS field, '' AS text FROM benchmark WHERE FALSE"
    return O.topk_sql(none, 10, extra=(
        f"pt AS ({_PT_SQL}), {more}w AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY term) AS b FROM ({words}) _w), "
        "xl AS (SELECT qid, 0 AS u, 'content' AS field, b, 0 AS c, 'multi' AS kind, term, NULL AS pterms, boost, 'K' AS grp, "
        "'0:K' AS ga, FALSE AS must, FALSE AS b_all FROM w), v AS (SELECT term FROM ts WHERE field = 'content'), "
        f"xt AS (SELECT w.qid, '0:K' AS ga, w.b, v.term FROM w JOIN v ON {matches})"))


@register("prefix_topk", sql=_multi_sql(
    "SELECT DISTINCT qid, substring(term, 1, CAST((length(term) + 1) // 2 AS INT)) AS term, 1.0 AS boost FROM pt", "starts_with(v.term, w.term)"))
def q_prefix_topk(spark, sf):
    """Ranked hits of every passage's terms, each cut to its first half (``opti*``)."""
    t = TM.passage_terms(spark, sf)
    half = F.substr("term", F.lit(1), F.floor((F.length("term") + 1) / 2).cast("int"))
    words = t.select("qid", F.concat(half, F.lit("*")).alias("word")).distinct()
    return S.search(I.open_index(spark, sf), QS.only_words(words), 10, operators=True)


_WILD_SQL = ("SELECT DISTINCT qid, CASE WHEN length(term) % 2 = 0 THEN '*' || substring(term, CAST(length(term) // 2 AS INT) + 1) "
             "ELSE substring(term, 1, CAST(length(term) // 2 AS INT)) || '?' || substring(term, CAST(length(term) // 2 AS INT) + 2) END AS term, "
             "1.0 AS boost FROM pt")


@register("wildcard_match", sql=_multi_sql(
    _WILD_SQL, "like_escape(v.term, replace(replace(replace(w.term, '_', '\\_'), '?', '_'), '*', '%'), '\\')"))
def q_wildcard_match(spark, sf):
    """Ranked hits of every passage's terms as patterns: terms of even length
    by their second half (``*ing``), the others with their middle open (``opt?m``)."""
    n = F.length("term")
    half = F.floor(n / 2).cast("int")
    tail = F.concat(F.lit("*"), F.substr("term", half + 1, n))
    open_ = F.concat(F.substr("term", F.lit(1), half), F.lit("?"), F.substr("term", half + 2, n))
    words = TM.passage_terms(spark, sf).select("qid", F.when(n % 2 == 0, tail).otherwise(open_).alias("word")).distinct()
    return S.search(I.open_index(spark, sf), QS.only_words(words), 10, operators=True)


_RANGE_WORDS = "SELECT qid, min(term) AS term, 3.0 AS boost, max(term) AS hi FROM pt GROUP BY qid"


@register("range_topk", sql=_multi_sql(_RANGE_WORDS, "v.term BETWEEN w.term AND w.hi"))
def q_range_topk(spark, sf):
    """Ranked hits of the range from each passage's first to its last term (``[a TO b]^3``)."""
    t = TM.passage_terms(spark, sf).groupBy("qid").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
    words = t.select("qid", F.concat(F.lit("["), "lo", F.lit(" TO "), "hi", F.lit("]^3")).alias("word"))
    return S.search(I.open_index(spark, sf), QS.only_words(words), 10, operators=True)


# DuckDB's levenshtein counts UTF-8 bytes: characters beyond ASCII (at most 58
# kinds) stand for control and other characters that no term holds.
_ONE_BYTE = "(SELECT string_agg(chr(CAST(x AS INT)), '') FROM (SELECT unnest(range(1, 32)) AS x UNION ALL SELECT unnest(range(33, 39)) UNION ALL " \
    "SELECT unnest(range(40, 46)) UNION ALL SELECT 47 UNION ALL SELECT unnest(range(58, 65)) UNION ALL SELECT unnest(range(91, 95)) UNION ALL " \
    "SELECT unnest(range(123, 126))) _o)"
_BYTES_SQL = ("chars AS (SELECT coalesce(string_agg(DISTINCT ch, ''), '') AS s FROM (SELECT unnest(string_split(term, '')) AS ch FROM "
              "(SELECT DISTINCT term FROM pt UNION SELECT DISTINCT term FROM ts WHERE field = 'content')) WHERE unicode(ch) > 127), "
              f"tr AS (SELECT s, substring({_ONE_BYTE}, 1, length(s)) AS o FROM chars)")
_BYTE = "translate({0}, (SELECT s FROM tr), (SELECT o FROM tr))"
_FUZZY_CTES = (f"{_BYTES_SQL}, fv AS (SELECT term, {_BYTE.format('term')} AS k, length(term) AS n, df FROM ts WHERE field = 'content'), "
               f"fw AS (SELECT term, {_BYTE.format('term')} AS k, length(term) AS n FROM (SELECT DISTINCT term FROM pt)), "
               "near AS (SELECT fw.term AS word, fv.term, fv.df, CAST(levenshtein(fw.k, fv.k) AS INT) AS dist FROM fw JOIN fv "
               "ON abs(fw.n - fv.n) <= 2 AND levenshtein(fw.k, fv.k) <= 2)")


@register("fuzzy_topk", sql=_multi_sql("SELECT DISTINCT qid, term, 1.0 AS boost FROM pt", "TRUE JOIN near ON near.word = w.term AND near.term = v.term AND near.dist <= 1",
                                       f"{_FUZZY_CTES}, "))
def q_fuzzy_topk(spark, sf):
    """Ranked hits of every passage's terms with one edit (``term~1``)."""
    words = TM.passage_terms(spark, sf).select("qid", F.concat("term", F.lit("~1")).alias("word")).distinct()
    return S.search(I.open_index(spark, sf), QS.only_words(words), 10, operators=True)


@register("prefix_match", sql=(
    f"WITH {_POST}, {_TS_SQL}, pt AS ({_PT_SQL}), pre AS (SELECT DISTINCT qid, w AS width, substring(term, 1, CAST(w AS INT)) AS prefix "
    "FROM (SELECT qid, term, unnest(range(1, length(term) + 1)) AS w FROM pt)), "
    "one AS (SELECT DISTINCT prefix FROM pre), v AS (SELECT term, substring(term, 1, CAST(w AS INT)) AS prefix FROM (SELECT term, "
    "unnest(range(1, length(term) + 1)) AS w FROM ts WHERE field = 'content')), "
    "ex AS (SELECT one.prefix, v.term FROM one JOIN v USING (prefix)), nt AS (SELECT prefix, count(*) AS n FROM ex GROUP BY prefix), "
    "pd AS (SELECT DISTINCT ex.prefix, p.doc_id FROM ex JOIN post p ON p.field = 'content' AND p.term = ex.term), "
    "d AS (SELECT pre.qid, pre.width, count(DISTINCT pd.doc_id) AS n_docs FROM pre JOIN pd USING (prefix) GROUP BY pre.qid, pre.width) "
    "SELECT qid, CAST(width AS INT) AS width, count(*) AS n_prefixes, CAST(sum(nt.n) AS BIGINT) AS n_terms, coalesce(any_value(d.n_docs), 0) AS n_docs "
    "FROM pre JOIN nt USING (prefix) LEFT JOIN d USING (qid, width) GROUP BY qid, width"))
def q_prefix_match(spark, sf):
    """Every prefix of every passage term: per passage and width the prefixes
    that some term has, the terms, and the documents that hold one."""
    ix = I.open_index(spark, sf)
    t = TM.passage_terms(spark, sf).select("qid", "term").distinct()
    pre = t.select("qid", F.explode(F.sequence(F.lit(1), F.length("term"))).alias("width"), "term")
    pre = pre.select("qid", "width", F.substr("term", F.lit(1), F.col("width")).alias("term")).distinct()
    asked = pre.select("qid", "width", F.lit("prefix").alias("kind"), "term", F.lit(None).cast("string").alias("hi"))
    asked, _ = S.materialize(asked)
    # a prefix of a passage term counts where the index has a term with it
    each = TM.count_terms(asked.select("term", "kind", "hi", F.col("term").alias("prefix")).distinct(), ix, ["prefix"]).filter("n_terms > 0")
    have = asked.join(each.select(F.col("prefix").alias("term")), "term", "left_semi").groupBy("qid", "width").agg(F.count(F.lit(1)).alias("n_prefixes"))
    return have.join(TM.count_matches(asked, ix, ["qid", "width"]), ["qid", "width"])


@register("range_match", sql=(
    f"WITH {_POST}, {_TS_SQL}, pt AS ({_PT_SQL}), r AS (SELECT qid, min(term) AS lo, max(term) AS hi FROM pt "
    "GROUP BY qid), ex AS (SELECT r.qid, r.lo, r.hi, ts.term FROM r JOIN ts ON ts.field = 'content' "
    "AND ts.term BETWEEN r.lo AND r.hi), "
    "d AS (SELECT qid, count(DISTINCT p.doc_id) AS n_docs FROM ex JOIN post p ON p.field = 'content' "
    "AND p.term = ex.term GROUP BY qid) "
    "SELECT qid, lo, hi, count(*) AS n_terms, coalesce(any_value(d.n_docs), 0) AS n_docs FROM ex LEFT JOIN d "
    "USING (qid) GROUP BY qid, lo, hi"))
def q_range_match(spark, sf):
    """Term range [min term, max term] of each passage on the content vocabulary."""
    ix = I.open_index(spark, sf)
    r = TM.passage_terms(spark, sf).groupBy("qid").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
    r, _ = S.materialize(r)
    asked = r.select("qid", F.lit("range").alias("kind"), F.col("lo").alias("term"), "hi")
    return r.join(TM.count_matches(asked, ix, ["qid"]), "qid")


@register("fuzzy_match", sql=(f"WITH {_POST}, {_TS_SQL}, pt AS ({_PT_SQL}), {_FUZZY_CTES} SELECT q.qid, q.term, near.term AS variant, near.dist, "
                              "near.df FROM (SELECT DISTINCT qid, term FROM pt) q JOIN near ON near.word = q.term"))
def q_fuzzy_match(spark, sf):
    """Fuzzy query (edit distance <= 2) for every term of every passage: its
    vocabulary variants with their document frequency."""
    ix = I.open_index(spark, sf)
    t = TM.passage_terms(spark, sf).select("qid", "term").distinct()
    asked = t.select(F.lit("content").alias("field"), F.col("term").alias("word"), F.lit(D.MAX_EDITS).alias("edits")).distinct()
    found = D.variants(asked, ix).select(F.col("word").alias("term"), F.col("term").alias("variant"), "dist", "df")
    return found.join(small(t), "term").select("qid", "term", "variant", "dist", "df")


_SLOP_UNITS = ("SELECT item_id AS qid, 0 AS u, 'content' AS field, '\"' || array_to_string(regexp_extract_all(text, '" + O.TOK
               + "')[1:4], ' ') || '\"' AS text FROM benchmark")


@register("sloppy_topk", sql=O.topk_sql(_SLOP_UNITS, 10, slop=3))
def q_sloppy_topk(spark, sf):
    """Ranked hits of each passage's first four words as a phrase with slop 3."""
    b = T.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.slice(A.tokenize(F.col("text")), 1, 4).alias("w"))
    q = b.select("qid", F.concat(F.lit('"'), F.array_join("w", " "), F.lit('"')).alias("query"), F.lit(None).cast("map<string,string>").alias("adv"))
    return S.search(I.open_index(spark, sf), q, 10, slop=3)


@register("phrase_slop", sql=(
    f"WITH {_POST}, lv AS ({O.leaves_sql(QS.PHRASE_UNITS)}), "
    "pt AS (SELECT qid, ga, b, c, field, len(pterms) AS _nt, unnest(pterms) AS _pt, "
    "unnest(range(len(pterms))) AS k FROM lv WHERE kind = 'phrase'), "
    "m AS (SELECT pt.qid, pt.ga, pt.b, pt.c, p.doc_id, pt._nt, pt.k, pt._pt.qpos AS qpos, p.positions FROM pt "
    "JOIN post p ON p.field = pt.field AND p.term = pt._pt.term), "
    "m2 AS (SELECT * FROM m WHERE (qid, ga, b, c, doc_id) IN (SELECT (qid, ga, b, c, doc_id) FROM m "
    "GROUP BY qid, ga, b, c, doc_id HAVING count(*) = any_value(_nt))), "
    "x AS (SELECT qid, ga, b, c, doc_id, _nt, k, unnest(positions) - qpos AS x FROM m2), "
    "d AS (SELECT a.qid, a.ga, a.b, a.c, a.doc_id, a._nt, a.x AS a, o.k, min(abs(o.x - a.x)) AS d FROM x a JOIN x o "
    "ON a.k = 0 AND o.k > 0 AND o.qid = a.qid AND o.ga = a.ga AND o.b = a.b AND o.c = a.c AND o.doc_id = a.doc_id "
    "AND abs(o.x - a.x) <= 2 GROUP BY ALL), "
    "pa AS (SELECT qid, ga, b, c, doc_id, a, count(*) AS n, sum(d) AS dsum, any_value(_nt) AS _nt FROM d "
    "GROUP BY qid, ga, b, c, doc_id, a) "
    "SELECT qid, doc_id, round(sum(1.0 / (1.0 + dsum)), 6) AS freq FROM pa WHERE n = _nt - 1 AND dsum <= 2 "
    "GROUP BY qid, ga, b, c, doc_id"))
def q_phrase_slop(spark, sf):
    """Sloppy (slop 2) frequency of every passage phrase in every document."""
    ix = I.open_index(spark, sf)
    lv, n_lv = S.materialize(Q.leaves(QS.phrase(spark, sf)))
    f = S.sloppy_phrase_freq(lv, ix, n_lv, slop=2)
    return f.select("qid", "doc_id", F.round("freq", 6).alias("freq"))
