"""TF-IDF pieces as SQL text shared by Spark (``F.expr``) and the DuckDB
oracle, so both engines compute bit-for-bit the same arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idf_sql(df: str, n_docs: str) -> str:
    """``1 + ln(n_docs / (df + 1))``."""
    return f"(1.0 + ln(CAST({n_docs} AS DOUBLE) / (CAST({df} AS DOUBLE) + 1.0)))"


def _octave_sql(flen: str) -> str:
    """k with 4^(k-1) < flen <= 4^k, i.e. 1/sqrt(flen) in [2^-k, 2^(1-k))."""
    branches = " ".join(f"WHEN {flen} <= {4 ** k} THEN {k}" for k in range(0, 17))
    return f"(CASE {branches} ELSE 17 END)"


def norm_sql(field: str, flen: str, mode: str = "lossy") -> str:
    """Field-length norm. ``exact``: 1/sqrt(len). ``lossy``: the one-byte form
    of the classic similarity (two mantissa bits: 1, .625, .5, .4375, ...).
    The untokenized ``year`` field has no norm (1.0)."""
    x = f"(1.0 / sqrt(CAST({flen} AS DOUBLE)))"
    if mode == "exact":
        v = x
    else:
        k = _octave_sql(flen)
        v = f"(floor({x} * power(2.0, {k}) * 4.0) / 4.0 / power(2.0, {k}))"
    return f"(CASE WHEN {field} = 'year' THEN 1.0 ELSE {v} END)"


def idf_col(df: Column, n_docs: Column) -> Column:
    return 1.0 + F.ln(n_docs.cast("double") / (df.cast("double") + 1.0))


def norm_col(field: Column, flen: Column, mode: str = "lossy") -> Column:
    """Column form of :func:`norm_sql` (same arithmetic)."""
    x = 1.0 / F.sqrt(flen.cast("double"))
    if mode == "exact":
        v = x
    else:
        k = F.lit(17)
        for kk in range(16, -1, -1):
            k = F.when(flen <= 4 ** kk, F.lit(kk)).otherwise(k)
        p = F.pow(F.lit(2.0), k)
        v = F.floor(x * p * 4.0) / 4.0 / p
    return F.when(field == "year", F.lit(1.0)).otherwise(v)
