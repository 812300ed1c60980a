"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document: its measurement goes into the
ledger and its failure sets one bit. A policy is a versioned mask of bits, so
trying another policy or taking a rule out reads the ledger and never the
texts again; ablations aggregate the distinct bit patterns.

Everything happens inside the row: no shuffle, so neither a hot source nor a
group of copies matters. Defined results: a null text counts as empty (all
measurements 0, fails ``few_words``); repeated rows get a ledger each; extra
columns are kept and never clash, since the ledger is one struct column under
a name the table does not have; an empty table gives an empty ledger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh, text_or_empty

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """``fails`` says on the measurements when a document fails the rule."""

    name: str
    fails: str


# The bit of a rule is its place in this list; append, never reorder.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("symbols", "10 * n_symbols > n_words AND n_symbols >= 10"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
]
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version number and the rules it enforces."""

    version: int
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule] = RULES) -> int:
        place = {r.name: k for k, r in enumerate(rules)}
        return sum(1 << place[n] for n in self.rules)


POLICY = Policy(1, tuple(r.name for r in RULES))


def _covered(places: Column) -> Column:
    """Words covered by 3-word windows that start at the ascending ``places``."""
    return F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"])


def ledger(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES, out: str = "ledger") -> DataFrame:
    """``docs`` plus one struct column ``out``: the measurements ``n_words,
    n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) and
    ``fail_bits`` (long, bit k set when rule k fails)."""
    t, w, g, s, m = (fresh(docs, f"__{x}") for x in ("text", "words", "grams", "sorted", "measured"))
    has_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    cur = docs.withColumn(t, text_or_empty(text_col))
    cur = cur.withColumn(w, F.array_remove(F.split(F.col(t), f"{SPACE_CLASS}+"), ""))
    n = F.size(F.col(w))
    cur = cur.withColumn(g, F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    # Only texts with a repeated window sort their windows with their places;
    # equal neighbours in that order are the repeated ones. Each step is a
    # column of its own: inside a lambda an expression is evaluated anew for
    # every element.
    cur = cur.withColumn(s, F.when(F.size(F.array_distinct(F.col(g))) < F.size(F.col(g)), F.array_sort(
        F.transform(F.col(g), lambda x, i: F.struct(x.alias("g"), i.alias("i"))))))
    at = lambda k: F.get(F.col(s), k)["g"]
    twice = F.filter(F.col(s), lambda x, k: (k > 0) & (at(k - 1) == x["g"]) | F.coalesce(at(k + 1) == x["g"], F.lit(False)))
    repeats = F.coalesce(_covered(F.array_sort(F.transform(twice, lambda x: x["i"]))), F.lit(0))
    lines = F.filter(F.split(F.col(t), "\n"), has_word)
    cur = cur.withColumn(m, F.struct(
        n.cast("long").alias("n_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.length(F.translate(F.col(t), SPACES, "")).cast("long").alias("word_chars"),
        (F.length(F.col(t)) - F.length(F.translate(F.col(t), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words")))
    names = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        said = rule.fails
        for name in names:
            said = _qualified(said, name, m)
        bits = bits.bitwiseOR(F.when(F.expr(said), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    led = F.struct(*[F.col(m)[x].alias(x) for x in names], bits.alias("fail_bits"))
    return cur.select(*[F.col(f"`{c}`") for c in docs.columns], led.alias(out))


def _qualified(expr: str, name: str, struct: str) -> str:
    return re.sub(rf"(?<![\w.`]){name}(?!\w)", f"`{struct}`.{name}", expr)


def passes(led: str, policy: Policy = POLICY, rules: list[Rule] = RULES) -> Column:
    """True where the ledger column ``led`` breaks no rule of ``policy``."""
    return F.col(f"`{led}`.fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablation(ledgers: DataFrame, led: str = "ledger", policy: Policy = POLICY, rules: list[Rule] = RULES) -> DataFrame:
    """One row per rule of ``policy``: documents that fail it, that fail it
    alone (kept if the rule were taken out), and that the policy rejects.
    Partial aggregation leaves one row per distinct bit pattern and task."""
    mask = F.lit(policy.mask(rules)).cast("long")
    bits = ledgers.select(F.col(f"`{led}`.fail_bits").bitwiseAND(mask).alias("bits")).groupBy("bits").agg(
        F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                               for k, r in enumerate(rules) if r.name in policy.rules]))
    x = bits.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")
    cnt = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return x.groupBy("rule").agg(
        cnt(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_fail"),
        cnt(F.col("bits") == F.col("bit")).alias("n_alone"),
        cnt(F.col("bits") != 0).alias("n_rejected"),
        F.lit(policy.version).alias("policy_version"))


def keep_clean(docs: DataFrame, text_col: str = "text", policy: Policy = POLICY) -> DataFrame:
    """The rows of ``docs`` whose text passes ``policy``, columns unchanged.

    A filter on the ledger would be pushed below its columns, and the rules'
    expressions evaluated within each other; a column that is not
    deterministic keeps it above them."""
    led, above = fresh(docs, "__ledger"), fresh(docs, "__above")
    x = ledger(docs, text_col, out=led).withColumn(above, F.monotonically_increasing_id())
    return x.filter(passes(led, policy) & (F.col(above) >= 0)).drop(led, above)
