"""Text analysis as column expressions: tokenize, lowercase, Porter stem,
stop-word filter. Positions are numbered before the stop filter, so removed
words leave holes (phrase matching relies on them).

The chain runs on exploded token rows, which stay in the partition of their
document: no shuffle, no Python.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import porter

# Word pattern of the standard tokenizer (letters, digits, underscore; inner
# apostrophe or dot keeps a word whole: don't, 3.5). Runs unchanged in Java
# regex (Spark) and RE2 (DuckDB).
TOKEN_RE = r"[\p{L}\p{N}_]+(?:['.][\p{L}\p{N}_]+)*"

# The English stop set of the standard analyzer (33 words).
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
]


@dataclass(frozen=True)
class Analyzer:
    """One configurable chain: tokenize -> [lowercase] -> filters -> [stem] ->
    [stop]. A filter is a name (it is part of a stored index's key) and a
    function of the token column; a token that it makes null goes."""

    lowercase: bool = True
    stemming: bool = False
    stopwords: bool = True
    stop_list: tuple[str, ...] = tuple(ENGLISH_STOP_WORDS)
    filters: tuple[tuple[str, Callable[[Column], Column]], ...] = ()

    def cased(self, tok: Column) -> Column:
        """The token before stemming and the stop list."""
        return reduce(lambda c, f: f[1](c), self.filters, F.lower(tok) if self.lowercase else tok)

    @property
    def key(self) -> str:
        return f"lc{int(self.lowercase)}st{int(self.stemming)}sw{int(self.stopwords)}" + (
            f"-{'|'.join(self.stop_list)}" if self.stopwords else "") + "".join(f"+{name}" for name, _ in self.filters)


STANDARD = Analyzer(lowercase=True, stemming=False, stopwords=True)
DEFAULT_TITLE = Analyzer(lowercase=True, stemming=True, stopwords=True)

# an analyzer of the title, or one per field (fields that are not named: STANDARD)
Analyzers = Analyzer | Mapping[str, Analyzer]


def by_field(an: Analyzers) -> dict[str, Analyzer]:
    return {"title": an} if isinstance(an, Analyzer) else dict(an)


def key_of(an: Analyzers) -> str:
    return an.key if isinstance(an, Analyzer) else ";".join(f"{f}={a.key}" for f, a in sorted(an.items()))


# the 8 combinations of the vocabulary experiment, in the order of the grid
CONFIG_GRID = [Analyzer(lc, st, sw) for lc in (False, True) for st in (False, True) for sw in (False, True)]


def tokenize(col: Column) -> Column:
    """Array of raw word tokens."""
    return F.regexp_extract_all(col, F.lit(TOKEN_RE), 0)


def explode_tokens(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """One row per token: ``keep`` + ``pos`` (0-based, before filtering) + ``tok``."""
    return df.select(*keep, F.posexplode(tokenize(F.col(text_col))).alias("pos", "tok"))


def analyze_tokens(df: DataFrame, an: Analyzer, tok_col: str = "tok", out_col: str = "term") -> DataFrame:
    """Apply lowercase / stem / stop to exploded tokens (stop after stem)."""
    cur = df.withColumn(out_col, an.cased(F.col(tok_col)))
    if an.filters:
        cur = cur.filter(F.col(out_col).isNotNull())
    if an.stemming:
        cur = porter.stem_df(cur, out_col, out_col)
    if an.stopwords:
        cur = cur.filter(~F.col(out_col).isin(list(an.stop_list)))
    return cur


def analyze_by_field(tok: DataFrame, an: Analyzers, untokenized: tuple[str, ...] = ("year",),
                     tok_col: str = "tok", out_col: str = "term", stem_all: bool = False) -> DataFrame:
    """Per-field analyzer dispatch on token rows with a ``field`` column:
    fields of ``an`` (one analyzer: the title's) use theirs, fields in
    ``untokenized`` keep the raw value, every other field the standard chain
    (lowercase + stop words)."""
    own = by_field(an)
    is_raw = F.col("field").isin(list(untokenized)) if untokenized else F.lit(False)

    def each(f):
        chosen = f(STANDARD)
        for name, a in own.items():
            chosen = F.when(F.col("field") == name, f(a)).otherwise(chosen)
        return chosen

    cur = tok.withColumn(out_col, F.when(is_raw, F.col(tok_col)).otherwise(each(lambda a: a.cased(F.col(tok_col)))))
    if any(a.filters for a in own.values()):
        cur = cur.filter(F.col(out_col).isNotNull())
    stemmed = [name for name, a in own.items() if a.stemming and name not in untokenized]
    if stemmed:
        # the Porter chain only sees tokens of stemmed fields; other rows pass
        # NULL through (``field`` must be a real column here, not a constant).
        # Small inputs (query text) stem every token.
        here = F.col("field").isin(stemmed)
        cur = cur.withColumn("_stem_in", F.col(out_col) if stem_all else F.when(here, F.col(out_col)))
        cur = porter.stem_df(cur, "_stem_in", "_stem_out")
        cur = cur.withColumn(out_col, F.when(here, F.col("_stem_out")).otherwise(F.col(out_col))).drop("_stem_in", "_stem_out")
    keep = each(lambda a: ~F.col(out_col).isin(list(a.stop_list)) if a.stopwords else F.lit(True))
    return cur.filter(F.when(is_raw, F.lit(True)).otherwise(keep))


def tokens_sql(src: str, text_col: str, keep: str) -> str:
    """DuckDB SQL exploding ``text_col`` into ``pos`` / ``tok`` rows."""
    return (f"SELECT {keep}, unnest(_t) AS tok, generate_subscripts(_t, 1) - 1 AS pos "
            f"FROM (SELECT *, regexp_extract_all({text_col}, '{TOKEN_RE}') AS _t FROM ({src}) _x) _y")


# --- stop lists shipped with Spark ML (a parameter source, not a copy) -----

def _spark_jar_dirs() -> list[str]:
    """``jars`` folders of the Spark in use: SPARK_HOME, then every parent of
    the loaded pyspark (which may sit in ``python/lib/pyspark.zip``)."""
    import pyspark

    dirs = [os.path.join(os.environ["SPARK_HOME"], "jars")] if os.environ.get("SPARK_HOME") else []
    at = os.path.dirname(os.path.abspath(pyspark.__file__))
    while at != os.path.dirname(at):
        dirs.append(os.path.join(at, "jars"))
        at = os.path.dirname(at)
    return dirs


@functools.lru_cache(maxsize=None)
def spark_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's bundled stop list for ``language`` (the list of
    ``StopWordsRemover.loadDefaultStopWords``), read from Spark's own jar; no
    JVM is needed. Without the jar a running session is asked."""
    jars = [j for d in _spark_jar_dirs() for j in glob.glob(os.path.join(d, "spark-mllib_*.jar"))]
    if not jars:  # pragma: no cover - a client without Spark's jars
        from pyspark.ml.feature import StopWordsRemover

        return tuple(StopWordsRemover.loadDefaultStopWords(language))
    with zipfile.ZipFile(jars[0]) as z:
        txt = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode("utf-8")
    return tuple(w.strip() for w in txt.splitlines() if w.strip())


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
