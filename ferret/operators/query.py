"""Queries as rows: decomposition of a table of queries into clause leaves.

Input ``queries(qid, query STRING, adv MAP<STRING,STRING>)``: free text on the
catch-all ``content`` field plus optional per-field text. The clause tree of
one query (three levels; a level with one clause scores like no level)::

    A: [MUST  PHRASES(content)]  [SHOULD KEYWORDS(content)]
       for each field f in adv:  [MUST PHRASES(f)]  [MUST KEYWORDS(f)]
    B: PHRASES(f)  = one MUST clause per quoted phrase
       KEYWORDS(f) = one SHOULD clause per whitespace word
    C: a phrase    = SHOULD each analyzed term, SHOULD the phrase (boost 5)
       a word      = SHOULD each analyzed term (a hyphenated word gives two)

With ``operators`` words outside quotes may carry the operators that users of
the search library type (column expressions on one word each)::

    -x         prohibited: removes what its group would match, does not score
    x^2.5      boost
    opti*      prefix         opt?m  *ing   wildcard, ``*`` any text, ``?`` a character
    [a TO b]   term range, both ends in it, ``*`` for an open end
    x~  x~1    fuzzy: terms within 2 (or the given number of) edits

The last four are constant-score clauses of the lower-cased, otherwise
unanalyzed text: a document that holds any of their terms gets the boost once.

Output ``leaves``: one row per C clause with the sizes of its enclosing
levels attached, so matched rows carry everything scoring needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import analyze as A

PHRASE_RE = '"([^"]*)"'
PHRASE_STRIP_RE = '"[^"]*"'
PHRASE_BOOST = 5.0


def units(queries: DataFrame) -> DataFrame:
    """``(qid, u, field, text, std)``: the free text (u = 0, on content) and
    each non-blank advanced field (u >= 1, fields in name order)."""
    std = queries.select("qid", F.lit(0).alias("u"), F.lit("content").alias("field"),
                         F.trim(F.col("query")).alias("text"), F.lit(True).alias("std"))
    std = std.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    adv = queries.select("qid", F.explode(F.map_filter(
        F.col("adv"), lambda k, v: F.trim(v) != "")).alias("field", "text"))
    w = Window.partitionBy("qid").orderBy("field")
    adv = adv.select("qid", F.row_number().over(w).alias("u"), "field", "text", F.lit(False).alias("std"))
    return std.unionByName(adv)


def _analyzed(df: DataFrame, text_col: str, keep: list[str], title_an: A.Analyzers) -> DataFrame:
    """Analyze ``text_col`` with the analyzer of the row's field (query side:
    every field, year included, is analyzed); positions keep stop holes."""
    tok = A.explode_tokens(df, text_col, keep + ["field"])
    return A.analyze_by_field(tok, title_an, untokenized=(), stem_all=True)


RANGE_RE = r"-?\[\S+ TO \S+\](?:\^\d+(?:\.\d+)?)?"
BOOST_RE = r"\^(\d+(?:\.\d+)?)$"
MULTI = ("prefix", "wildcard", "range", "fuzzy")


def parse(queries: DataFrame, text_col: str = "q") -> DataFrame:
    """``free text field:value field:value`` as ``query`` and ``adv`` (a
    repeated field keeps its last value, empty values go): what :func:`leaves`
    reads, other columns kept."""
    free, pairs = split_fields(F.col(text_col))
    last = F.filter(pairs, lambda p, i: (p["value"] != "") & (F.size(F.filter(pairs, lambda o, k: (k > i) & (o["field"] == p["field"]))) == 0))
    keep = [c for c in queries.columns if c != text_col]
    return queries.select(*keep, free.alias("query"), F.map_from_entries(last).alias("adv"))


def split_fields(q):
    """``free text field:value field:value`` -> (free text, [(field, value)])
    by the colons: a field name is the last word before a colon, its value
    runs to the word before the next colon."""
    parts = F.split(q, ":", -1)
    n = F.size(parts)
    free = F.when(n > 1, F.array_join(F.slice(F.split(parts[0], " ", -1), 1, F.size(F.split(parts[0], " ", -1)) - 1),
                                      " ")).otherwise(q)
    idx = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))

    def pair(i):
        prev = F.split(F.trim(F.element_at(parts, i)), " ", -1)
        key = F.element_at(prev, -1)
        cur = F.element_at(parts, i + 1)
        cw = F.split(F.trim(cur), " ", -1)
        val = F.when(i + 1 < n, F.array_join(F.slice(cw, 1, F.size(cw) - 1), " ")).otherwise(F.trim(cur))
        return F.struct(key.alias("field"), F.trim(val).alias("value"))

    pairs = F.when(n > 1, F.transform(idx, pair)).otherwise(F.array().cast("array<struct<field:string,value:string>>"))
    return free, pairs


def _operator(word):
    """Struct of one whitespace word: ``kind, piece, hi, edits, boost, no``."""
    no = word.rlike("^-.")
    x = F.when(no, F.substring(word, 2, 1 << 30)).otherwise(word)
    boost = F.regexp_extract(x, BOOST_RE, 1)
    x = F.regexp_replace(x, BOOST_RE, "")
    fuzzy, range_ = r"^(.+)~([0-2]?)$", r"^\[(\S+) TO (\S+)\]$"
    kind = (F.when(x.rlike(range_), "range").when(x.rlike(r"^[^*?]+\*$"), "prefix").when(x.rlike(r"[*?]"), "wildcard")
            .when(x.rlike(fuzzy), "fuzzy").otherwise("plain"))
    piece = (F.when(kind == "range", F.regexp_extract(x, range_, 1)).when(kind == "prefix", F.regexp_replace(x, r"\*$", ""))
             .when(kind == "fuzzy", F.regexp_extract(x, fuzzy, 1)).otherwise(x))
    edits = F.regexp_extract(x, fuzzy, 2)
    return F.struct(kind.alias("kind"), F.when(kind == "plain", piece).otherwise(F.lower(piece)).alias("piece"),
                    F.when(kind == "range", F.lower(F.regexp_extract(x, range_, 2))).alias("hi"),
                    F.when(kind == "fuzzy", F.when(edits == "", 2).otherwise(edits.cast("int"))).alias("edits"),
                    F.when(boost == "", 1.0).otherwise(boost.cast("double")).alias("boost"), no.alias("no"))


def _plain(word):
    return F.struct(F.lit("plain").alias("kind"), word.alias("piece"), F.lit(None).cast("string").alias("hi"),
                    F.lit(None).cast("int").alias("edits"), F.lit(1.0).alias("boost"), F.lit(False).alias("no"))


def leaves(queries: DataFrame, title_an: A.Analyzers = A.DEFAULT_TITLE, operators: bool = False, boost: float = PHRASE_BOOST) -> DataFrame:
    """Clause leaves of every query (see module doc).

    One pass: every unit fans out into its B-level pieces (each quoted
    phrase, each whitespace word of the rest), the pieces are tokenized and
    analyzed together, and all per-query windows run after a single
    exchange on ``qid``. With ``operators`` the leaves have the columns ``no``,
    ``hi`` and ``edits`` too."""
    u = units(queries)
    phrases = F.regexp_extract_all(F.col("text"), F.lit(PHRASE_RE), 1)
    rest = F.trim(F.regexp_replace(F.col("text"), PHRASE_STRIP_RE, ""))
    none = F.array().cast("array<string>")
    ranges = F.regexp_extract_all(rest, F.lit(RANGE_RE), 0) if operators else none
    rest = F.trim(F.regexp_replace(rest, RANGE_RE, "")) if operators else rest
    words = F.concat(F.when(rest != "", F.split(rest, r"\s+")).otherwise(none), ranges)
    pieces = F.concat(
        F.transform(phrases, lambda x, i: F.struct(F.lit("P").alias("grp"), i.alias("b"), _plain(x).alias("w"))),
        F.transform(words, lambda x, i: F.struct(F.lit("K").alias("grp"), i.alias("b"), (_operator(x) if operators else _plain(x)).alias("w"))))
    pc = u.select("qid", "u", "field", F.explode(pieces).alias("p")).select(
        "qid", "u", "field", "p.grp", "p.b", "p.w.*").filter(F.col("piece") != "")
    own = ["boost", "no"] if operators else []
    plain = pc.filter(F.col("kind") == "plain") if operators else pc
    tok = _analyzed(plain.select("qid", "u", "field", "grp", "b", "piece", *own), "piece", ["qid", "u", "grp", "b", *own], title_an).repartition("qid")
    w_b = Window.partitionBy("qid", "u", "grp", "b")
    tok = (tok.withColumn("c", F.row_number().over(w_b.orderBy("pos")) - 1)
           .withColumn("_n", F.count(F.lit(1)).over(w_b)))
    no_pterms = F.lit(None).cast("array<struct<term:string,qpos:int>>")
    multi = {"no": F.lit(False), "hi": F.lit(None).cast("string"), "edits": F.lit(None).cast("int")}
    ops = list(multi) if operators else []
    extra = [multi[c].alias(c) for c in ops]
    terms = tok.select("qid", "u", "field", "grp", "b", "c", F.lit("term").alias("kind"), "term",
                       no_pterms.alias("pterms"), F.col("boost") if operators else F.lit(1.0).alias("boost"),
                       *(["no", *extra[1:]] if operators else []))
    # each phrase (P piece) adds itself, boost 5: a phrase leaf, or a term
    # leaf when it analyzed to a single term
    ph = (tok.filter(F.col("grp") == "P").groupBy("qid", "u", "field", "grp", "b")
          .agg(F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("qpos"), "term"))).alias("_pl"),
               F.count(F.lit(1)).alias("_n")))
    ph = ph.select(
        "qid", "u", "field", "grp", "b", F.col("_n").cast("int").alias("c"),
        F.when(F.col("_n") == 1, F.lit("term")).otherwise(F.lit("phrase")).alias("kind"),
        F.when(F.col("_n") == 1, F.col("_pl")[0]["term"]).alias("term"),
        F.when(F.col("_n") > 1, F.transform("_pl", lambda s: F.struct(
            s["term"].alias("term"), s["qpos"].alias("qpos")))).alias("pterms"),
        F.lit(float(boost)).alias("boost"), *extra)
    lv = terms.unionByName(ph)
    if operators:
        lv = lv.unionByName(pc.filter(F.col("kind") != "plain").select(
            "qid", "u", "field", "grp", "b", F.lit(0).alias("c"), "kind", F.col("piece").alias("term"), no_pterms.alias("pterms"), "boost", "no", "hi", "edits"))
    lv = lv.repartition("qid")
    lv = lv.withColumn("ga", F.concat_ws(":", F.col("u").cast("string"), F.col("grp")))
    lv = lv.withColumn("must", ~((F.col("grp") == "K") & (F.col("u") == 0)))
    lv = lv.withColumn("b_all", F.col("grp") == "P")  # every phrase of a P group is required
    w_q = Window.partitionBy("qid")
    w_a = Window.partitionBy("qid", "ga")
    w_c = Window.partitionBy("qid", "ga", "b")
    counted = F.when(~F.col("no"), F.col("b")) if operators else F.col("b")  # prohibited clauses do not count
    lv = lv.select("*", F.count(F.lit(1)).over(w_c).alias("n_c"), F.size(F.collect_set(counted).over(w_a)).alias("n_b"),
                   F.size(F.collect_set("ga").over(w_q)).alias("n_a"),
                   F.size(F.collect_set(F.when(F.col("must"), F.col("ga"))).over(w_q)).alias("n_must"))
    return lv.select("qid", "ga", "must", "b", "b_all", "c", "field", "kind", "term", "pterms", "boost", *ops,
                     "n_a", "n_must", "n_b", "n_c")
