"""Popular topics: noun-phrase chunks of titles, counted per year facet.

Tagging is a lexicon lookup plus suffix rules (no trained tagger); a caller's
lexicon is a table. A tag is one character (``TAGS``), a title's tags are one
string, and the chunk grammar is a regular expression over it: an argument of
:func:`noun_phrases`. The default is ``JJ* (NN|NNS)* NN (NN|NNS)*`` (``CHUNK_RE``
says it over the ``word/TAG`` string, as the oracle runs it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_ROWS, materialize, small
from .ordinals import placed

# Word tokens (inner hyphen, apostrophe or dot kept) or single punctuation marks.
TAG_TOKEN_RE = r"[\p{L}\p{N}]+(?:[-'.][\p{L}\p{N}]+)*|[^\s\p{L}\p{N}]"
CHUNK_RE = r"(?:\S+/JJ )*(?:\S+/NNS? )*\S+/NN (?:\S+/NNS? )*"

# Closed-class English words and their tags.
LEXICON = {
    "DT": ["the", "a", "an", "this", "that", "these", "those", "each", "every", "some", "any", "no", "all",
           "both", "another"],
    "IN": ["of", "in", "on", "for", "with", "at", "by", "from", "to", "into", "over", "under", "about",
           "between", "through", "during", "without", "within", "against", "among", "via", "towards", "toward",
           "across", "after", "before", "upon", "than", "as"],
    "CC": ["and", "or", "but", "nor"],
    "PRP": ["it", "we", "they", "you", "he", "she", "i", "us", "them", "our", "their", "its", "his", "her",
            "your", "my"],
    "MD": ["can", "could", "may", "might", "must", "shall", "should", "will", "would"],
    "VB": ["be", "is", "are", "was", "were", "been", "being", "have", "has", "had", "do", "does", "did"],
    "WRB": ["what", "which", "who", "whom", "whose", "when", "where", "why", "how"],
    "RB": ["not", "very", "also"],
}
# Suffix rules for words outside the lexicon, first match wins.
SUFFIX_RULES = [
    (r"^\p{N}+(?:[.,]\p{N}+)*$", "CD"),
    (r"^[^\p{L}\p{N}]+$", "O"),
    (r"ly$", "RB"),
    (r"ing$", "VBG"),
    (r"ed$", "VBD"),
    (r"(?:ous|ive|al|ic|able|ible|ful|less|ary|ish)$", "JJ"),
    (r"[^s]s$", "NNS"),
]

# One character a tag; grammars are written with them.
TAGS = {"JJ": "J", "NN": "N", "NNS": "S", "DT": "D", "IN": "I", "CC": "C", "PRP": "P", "MD": "M", "VB": "V", "VBG": "G",
        "VBD": "E", "WRB": "W", "RB": "R", "CD": "9", "O": "O"}
GRAMMAR = "J*[NS]*N[NS]*"


def tag(w: Column) -> Column:
    """Tag of one (lowercased) token."""
    t = None
    for tg, words in LEXICON.items():
        t = F.when(w.isin(words), F.lit(tg)) if t is None else t.when(w.isin(words), F.lit(tg))
    return by_suffix(w, t)


def by_suffix(w: Column, known: Column | None = None) -> Column:
    """Tag by the suffix rules where ``known`` (a chain of ``when``) has none."""
    t = known
    for rx, tg in SUFFIX_RULES:
        t = F.when(w.rlike(rx), F.lit(tg)) if t is None else t.when(w.rlike(rx), F.lit(tg))
    return t.otherwise(F.lit("NN"))


def tag_sql(w: str) -> str:
    parts = []
    for tg, words in LEXICON.items():
        lst = ", ".join("'" + x + "'" for x in words)
        parts.append(f"WHEN {w} IN ({lst}) THEN '{tg}'")
    for rx, tg in SUFFIX_RULES:
        parts.append(f"WHEN regexp_matches({w}, '{rx}') THEN '{tg}'")
    return "CASE " + " ".join(parts) + " ELSE 'NN' END"


def _letter(tag_: Column) -> Column:
    """The character of a tag (unknown tags: ``O``)."""
    t = None
    for name, c in TAGS.items():
        t = F.when(tag_ == name, F.lit(c)) if t is None else t.when(tag_ == name, F.lit(c))
    return t.otherwise(F.lit("O"))


def tagged_words(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Distinct ``w`` with ``tag``: that of ``lexicon`` (``word, tag``; of a word
    that is in it twice the first by name), suffix rules for the rest."""
    lex = lexicon.groupBy(F.lower("word").alias("w")).agg(F.min("tag").alias("_known"))
    x = words.select("w").distinct().join(lex, "w", "left")
    return x.select("w", F.coalesce("_known", by_suffix(F.col("w"))).alias("tag"))


def noun_phrases(titles: DataFrame, keep: list[str], key: str = "doc_id", grammar: str = GRAMMAR, lexicon: DataFrame | None = None) -> DataFrame:
    """``keep + [idx, phrase, n_words]``: every chunk of every title, the
    leftmost matches of ``grammar`` in the title's tags.

    With the fixed lexicon everything happens in the row, and no token is
    exchanged. With a caller's ``lexicon`` (``word, tag``) the distinct tokens are
    tagged once, and the tags come back to their titles by ``key``."""
    toks = F.regexp_extract_all(F.lower(F.col("title")), F.lit(TAG_TOKEN_RE), 0)
    if lexicon is None:
        x = titles.select(*keep, toks.alias("_ws"))
        x = x.withColumn("_tags", F.array_join(F.transform("_ws", lambda w: _letter(tag(w))), ""))
    else:
        t = titles.select(*keep, F.posexplode(toks).alias("pos", "w"))
        tags, n = materialize(tagged_words(t, lexicon))
        t = t.join(F.broadcast(tags) if n <= MAX_BROADCAST_ROWS else tags, "w")
        g = t.groupBy(*dict.fromkeys([*keep, key])).agg(F.sort_array(F.collect_list(F.struct("pos", "w", _letter(F.col("tag")).alias("c")))).alias("_t"))
        x = g.select(*keep, F.transform("_t", lambda e: e["w"]).alias("_ws"), F.array_join(F.transform("_t", lambda e: e["c"]), "").alias("_tags"))
    # matches are put in brackets, and a fold over the bracketed parts gives their places
    parts = F.split(F.regexp_replace("_tags", f"((?:{grammar}))", "<$1>"), "<")

    def step(acc, p):
        inside = F.instr(p, ">") - 1  # length of the match, -1 for text before the first
        chunk = F.struct(acc["at"].alias("at"), inside.alias("n"))
        return F.struct((acc["at"] + F.length(p) - F.when(inside >= 0, 1).otherwise(0)).alias("at"),
                        F.when(inside > 0, F.concat(acc["out"], F.array(chunk))).otherwise(acc["out"]).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,n:int>>").alias("out"))
    chunks = F.aggregate(parts, none, step, lambda acc: acc["out"])
    x = x.select(*keep, "_ws", F.posexplode(chunks).alias("idx", "_c"))
    return x.select(*keep, "idx", F.array_join(F.slice("_ws", F.col("_c.at") + 1, F.col("_c.n")), " ").alias("phrase"), F.col("_c.n").alias("n_words"))


def popular(np_: DataFrame, facet: str = "year", top_k: int = 10) -> DataFrame:
    """Top-k phrases per facet value: unigrams skip their most frequent 1
    percent, the best k of each length 1 / 2 / 3 merge, longer chunks are
    counted but not reported. Ties by phrase.

    The cut comes from a histogram of counts (a row per facet, length and
    distinct count): only phrases whose count lies at the cut are placed in
    order, by a range partitioning, so no facet's list is ranked in one task."""
    # phrase counts are written once; the histogram and the ranking read them
    key = F.concat_ws("\u0001", F.coalesce(F.concat(F.lit("="), F.col(facet).cast("string")), F.lit("")), F.col("n_words").cast("string"))
    c = np_.groupBy(facet, "phrase", "n_words").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("n_words") <= 3)
    c, _ = materialize(c.withColumn("_key", key).withColumn("_less", -F.col("cnt")))
    hist = c.groupBy("_key", "n_words", "cnt").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_key")  # a row per distinct count: their sum is bounded by the titles
    above = F.coalesce(F.sum("_n").over(group.orderBy(F.col("cnt").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hist = hist.withColumn("_above", above).withColumn(
        "_lo", F.when(F.col("n_words") == 1, F.floor(F.sum("_n").over(group) * 0.01)).otherwise(0).cast("long"))
    levels = hist.filter((F.col("_above") < F.col("_lo") + top_k) & (F.col("_above") + F.col("_n") > F.col("_lo")))
    levels, _ = materialize(levels.select("_key", "cnt", "_lo", F.min("_above").over(group).alias("_base")))
    x = placed(c.join(small(levels), ["_key", "cnt"]), ["_less", "phrase"], "_key")
    rank = F.col("_base") + F.col("ord") + 1
    x = x.filter((rank > F.col("_lo")) & (rank <= F.col("_lo") + top_k))  # top_k rows per facet and length
    w2 = Window.partitionBy(facet).orderBy(F.col("cnt").desc(), F.col("phrase").asc())
    x = x.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= top_k)
    return x.select(facet, "phrase", "cnt", "rank")
