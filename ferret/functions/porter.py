"""Porter stemming as plain column expressions (no UDF).

The algorithm (M. F. Porter, 1980, with the two departures of the widely used
C / Java implementations: ``bli -> ble`` and ``logi -> log``) is written as
five steps of ``CASE`` expressions over suffix tests and regex conditions on
the stem. Conditions on the measure ``m`` and on vowels are regexes over the
whole word: since a letter's class only depends on the letters before it, a
condition on the stem is a prefix pattern followed by the literal suffix.

One renderer produces SQL text for Spark (``F.expr``) and for DuckDB (the
oracle), so both engines run the very same rules. Each step reads the
previous step's column, which keeps every expression small.

Letters other than ``a e i o u`` count as consonants, ``y`` is a vowel after
a consonant, as the algorithm defines. Words of length 1 or 2 are unchanged.
Known simplifications: a ``y`` two places before the end counts as a
consonant only at the start or after a plain vowel, and ``yy`` never counts as
a double consonant.
"""

from __future__ import annotations

from functools import lru_cache

# ---------------------------------------------------------------------------
# Suffix rules of the Porter algorithm (suffix, replacement).
STEP2_RULES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP3_RULES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP4_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
# ---------------------------------------------------------------------------

# Regex building blocks (no backslashes, so they read the same in both SQL
# dialects and need no escaping).
_P = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])[aeiou]*"  # [C] + first vowel run
_C = "[^aeiou][^aeiouy]*"                               # a consonant run
_V = "[aeiouy][aeiou]*"                                 # a vowel run after a consonant
_CVC = "(?:[^aeiouy]|(?:^|[aeiou]|[^aeiouy]y)y)[aeiouy][^aeiouwxy]"
# double consonants, built from the consonant letters (lower and upper case)
_DOUBLES = "(?:" + "|".join(
    c + c for c in "bcdfghjklmnpqrstvwxzABCDEFGHIJKLMNOPQRSTUVWXYZ") + ")$"


def _m_gt0(s: str) -> str:
    return f"{_P}[^aeiou].*{s}$"


def _m_gt1(s: str) -> str:
    return f"{_P}{_C}{_V}[^aeiou].*{s}$"


def _m_eq1(s: str) -> str:
    return f"{_P}{_C}(?:{_V})?{s}$"


def _vowel_in(s: str) -> str:
    return f"^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou]).*{s}$"


class _Sql:
    def __init__(self, dialect: str):
        self.d = dialect

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def rx(self, col: str, pattern: str) -> str:
        if self.d == "spark":
            return f"({col} RLIKE {self.lit(pattern)})"
        return f"regexp_matches({col}, {self.lit(pattern)})"

    def ends(self, col: str, suffix: str) -> str:
        return f"({col} LIKE {self.lit('%' + suffix)})"

    def swap(self, col: str, n: int, app: str) -> str:
        """Drop the last ``n`` characters and append ``app``."""
        base = f"substring({col}, 1, length({col}) - {n})" if n else col
        return f"({base} || {self.lit(app)})" if app else f"({base})"


def _rule_step(q: _Sql, w: str, rules, cond) -> str:
    """Longest matching suffix decides; its condition failing ends the step."""
    branches = []
    for suf, rep in sorted(rules, key=lambda r: -len(r[0])):
        conds = cond(suf)
        test = " AND ".join(q.rx(w, c) for c in conds)
        branches.append(
            f"WHEN {q.ends(w, suf)} THEN CASE WHEN {test} THEN {q.swap(w, len(suf), rep)} ELSE {w} END")
    return "CASE " + " ".join(branches) + f" ELSE {w} END"


def steps(dialect: str) -> list[tuple[str, str]]:
    """Ordered ``(output_column, sql_expr)`` pairs; step i reads column ``_p{i}``."""
    return list(_steps(dialect))


@lru_cache(maxsize=4)
def _steps(dialect: str) -> tuple[tuple[str, str], ...]:
    q = _Sql(dialect)
    out = []
    # step 1a: plurals
    w = "_p0"
    s1a = (f"CASE WHEN length({w}) <= 2 THEN {w} "
           f"WHEN {q.ends(w, 'sses')} THEN {q.swap(w, 2, '')} "
           f"WHEN {q.ends(w, 'ies')} THEN {q.swap(w, 3, 'i')} "
           f"WHEN {q.ends(w, 'ss')} THEN {w} "
           f"WHEN {q.ends(w, 's')} THEN {q.swap(w, 1, '')} ELSE {w} END")
    out.append(("_p1", s1a))
    # step 1b, first half: -eed / -ed / -ing; `_f1` flags a removed -ed/-ing
    w = "_p1"
    s1b = (f"CASE WHEN length(_p0) <= 2 THEN {w} "
           f"WHEN {q.ends(w, 'eed')} THEN CASE WHEN {q.rx(w, _m_gt0('eed'))} THEN {q.swap(w, 1, '')} ELSE {w} END "
           f"WHEN {q.ends(w, 'ed')} AND {q.rx(w, _vowel_in('ed'))} THEN {q.swap(w, 2, '')} "
           f"WHEN {q.ends(w, 'ing')} AND {q.rx(w, _vowel_in('ing'))} THEN {q.swap(w, 3, '')} "
           f"ELSE {w} END")
    out.append(("_p2", s1b))
    # step 1b, second half (only when -ed/-ing was removed), then step 1c
    w = "_p2"
    flag = (f"(length(_p0) > 2 AND NOT {q.ends('_p1', 'eed')} AND length(_p2) < length(_p1))")
    fix = (f"CASE WHEN {q.ends(w, 'at')} OR {q.ends(w, 'bl')} OR {q.ends(w, 'iz')} THEN {q.swap(w, 0, 'e')} "
           f"WHEN {q.rx(w, _DOUBLES)} AND NOT ({q.ends(w, 'l')} OR {q.ends(w, 's')} OR {q.ends(w, 'z')}) "
           f"THEN {q.swap(w, 1, '')} "
           f"WHEN {q.rx(w, _m_eq1(''))} AND {q.rx(w, _CVC + '$')} THEN {q.swap(w, 0, 'e')} "
           f"ELSE {w} END")
    out.append(("_p3", f"CASE WHEN {flag} THEN {fix} ELSE {w} END"))
    w = "_p3"
    s1c = (f"CASE WHEN length(_p0) > 2 AND {q.ends(w, 'y')} AND {q.rx(w, _vowel_in('y'))} "
           f"THEN {q.swap(w, 1, 'i')} ELSE {w} END")
    out.append(("_p4", s1c))
    # steps 2 and 3: m > 0
    gate = "CASE WHEN length(_p0) <= 2 THEN {w} ELSE {e} END"
    w = "_p4"
    out.append(("_p5", gate.format(w=w, e=_rule_step(q, w, STEP2_RULES, lambda s: [_m_gt0(s)]))))
    w = "_p5"
    out.append(("_p6", gate.format(w=w, e=_rule_step(q, w, STEP3_RULES, lambda s: [_m_gt0(s)]))))
    # step 4: m > 1, -ion only after s or t
    w = "_p6"

    def c4(s):
        return [_m_gt1(s), "[st]ion$"] if s == "ion" else [_m_gt1(s)]

    out.append(("_p7", gate.format(w=w, e=_rule_step(q, w, [(s, "") for s in STEP4_SUFFIXES], c4))))
    # step 5a: final e; step 5b: -ll with m > 1
    w = "_p7"
    s5a = (f"CASE WHEN length(_p0) > 2 AND {q.ends(w, 'e')} AND ({q.rx(w, _m_gt1('e'))} "
           f"OR ({q.rx(w, _m_eq1('e'))} AND NOT {q.rx(w, _CVC + 'e$')})) THEN {q.swap(w, 1, '')} ELSE {w} END")
    out.append(("_p8", s5a))
    w = "_p8"
    s5b = (f"CASE WHEN length(_p0) > 2 AND {q.ends(w, 'll')} AND {q.rx(w, f'{_P}{_C}{_V}[^aeiou]')} "
           f"THEN {q.swap(w, 1, '')} ELSE {w} END")
    out.append(("_p9", s5b))
    return tuple(out)


def stem_df(df, in_col: str, out_col: str):
    """Replace/add ``out_col`` = Porter stem of ``in_col``: a chain of
    projections, each step reading the previous column.

    The stem leaves the chain through a one-element ``explode``: predicates
    on the stem (stop filter, join keys) then stay above the generator
    instead of being pushed down through the projections, which would
    substitute each step into the next and grow the expression exponentially.
    """
    from pyspark.sql import functions as F

    base = [c for c in df.columns if c != out_col]
    cur = df.withColumn("_p0", F.col(in_col))
    for name, expr in steps("spark"):
        cur = cur.withColumn(name, F.expr(expr))
    return cur.select(*base, F.explode(F.array(F.col("_p9"))).alias(out_col))


def stem_sql(source_sql: str, in_col: str, out_col: str) -> str:
    """DuckDB SQL text: rows of ``source_sql`` plus ``out_col`` = stem of
    ``in_col``; one nested select per step."""
    cur = f"SELECT *, {in_col} AS _p0 FROM ({source_sql}) _s0"
    for i, (name, expr) in enumerate(steps("duckdb"), start=1):
        cur = f"SELECT *, {expr} AS {name} FROM ({cur}) _s{i}"
    tmp = ", ".join(f"_p{i}" for i in range(10))
    return f"SELECT * EXCLUDE ({tmp}), _p9 AS {out_col} FROM ({cur}) _sf"
