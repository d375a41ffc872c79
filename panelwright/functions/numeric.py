"""Numeric expressions: weighted index, safe ratio, z-score, numeric parsing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions._util import as_col

# A number as pandas' to_numeric accepts it: optional sign, digits with an
# optional fraction or a bare fraction, optional exponent, or inf/infinity.
# Spark's try_cast would also take suffixes like ``1d``; the guard rejects them.
NUMERIC_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def weighted_sum(weights: dict) -> Column:
    """sum(w * col); any null input makes the result null."""
    terms = [F.lit(float(w)) * as_col(c) for c, w in weights.items()]
    return reduce(add, terms)


def safe_ratio(num, den) -> Column:
    """num / den with a zero denominator giving null (ANSI-safe)."""
    return as_col(num) / F.nullif(as_col(den), F.lit(0))


def to_number(c) -> Column:
    """Text -> double when it looks like a number, else null (``1,000``, ``1d``, ``nan`` -> null)."""
    s = as_col(c).cast("string")
    parsed = F.when(s.rlike(NUMERIC_PATTERN), F.trim(s).try_cast("double"))
    return F.nanvl(parsed, F.lit(None).cast("double"))


def nan_to_null(c) -> Column:
    """Turn NaN into SQL null (Spark treats NaN as a value that poisons sums)."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))


def zscore(x, mean, sd) -> Column:
    """(x - mean) / sd with sd 0 or null giving null."""
    return (as_col(x) - as_col(mean)) / F.nullif(as_col(sd), F.lit(0.0))


def truncate_to_int(x) -> Column:
    """Truncate toward zero; null counts as 0 (``int(x) if notna else 0``)."""
    return F.coalesce(as_col(x).cast("double").cast("long"), F.lit(0))
