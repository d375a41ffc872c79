"""Period-label functions (labels like ``2011-12``).

All are Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions._util import as_col

# The shape of a period label and the invalid-year sentinel.
PERIOD_LABEL_PATTERN = r"^[0-9]{4}-[0-9]{2}$"
INVALID_YEAR = -1


def start_year(label, invalid: int = INVALID_YEAR) -> Column:
    """First four characters of the stripped label as an int; ``invalid`` otherwise.

    ``' 2011-12'`` -> 2011, ``'abc'`` / ``'201'`` / null -> ``invalid``.
    """
    digits = F.regexp_extract(as_col(label).cast("string"), r"^\s*([0-9]{4})", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(invalid))


def is_period_label(label) -> Column:
    """True for ``YYYY-YY`` labels, false for Career/summary rows and null."""
    return F.coalesce(as_col(label).cast("string").rlike(PERIOD_LABEL_PATTERN), F.lit(False))


def period_label(year) -> Column:
    """Build ``YYYY-YY`` from a start year (1995 -> ``1995-96``)."""
    y = as_col(year).cast("int")
    return F.format_string("%d-%02d", y, F.pmod(y + 1, F.lit(100)))


def between_years(year, lo, hi) -> Column:
    """Inclusive range test; null years give false."""
    return F.coalesce(as_col(year).between(lo, hi), F.lit(False))


def opportunity_periods(debut, window_end, min_year: int) -> Column:
    """Periods from debut through window end, at least 1; null outside range."""
    d = as_col(debut)
    e = as_col(window_end)
    return F.when(d.between(F.lit(min_year), e), F.greatest(F.lit(1), e - d + 1))


def season_urls(start_year_col, end_year_col, template: str) -> Column:
    """Array of request urls, one per year in the inclusive range.

    ``template`` is a ``format_string`` pattern with one ``%d`` for the year.
    """
    years = F.sequence(as_col(start_year_col).cast("int"), as_col(end_year_col).cast("int"))
    return F.transform(years, lambda y: F.format_string(template, y))
