"""Per-key row selection and ordering (dedupe, latest/earliest row, top-n).

Spark has no file order, so every order-dependent operator takes an explicit
``order_by`` list (column names or Columns, ascending unless a Column says
otherwise).  ``row_number() == 1`` is planned with a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per key: a key holding a third of the data never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import is_period_label, start_year
from panelwright.functions._util import qcol

_RN = "__rn"


def _sort_cols(order_by) -> list[Column]:
    out = []
    for c in order_by or []:
        if isinstance(c, Column):
            out.append(c)
        else:
            out.append(qcol(c).asc_nulls_first())
    return out


def _reverse(order_by) -> list[Column]:
    out = []
    for c in order_by or []:
        if isinstance(c, Column):
            raise ValueError("keep_last needs column names so the order can be reversed")
        out.append(qcol(c).desc_nulls_last())
    return out


def first_per_key(df: DataFrame, keys, order_cols: list[Column]) -> DataFrame:
    """The first row of each key group under ``order_cols`` (a total order gives a deterministic result)."""
    if not order_cols:
        # Any row is "first"; still deterministic enough only with a total order.
        order_cols = [F.lit(0)]
    w = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """``drop_duplicates(keys, keep='first')``: null keys equal each other; no-op when a key column is missing."""
    if any(k not in df.columns for k in keys):
        return df
    return first_per_key(df, keys, _sort_cols(order_by))


def keep_last(df: DataFrame, keys, order_by) -> DataFrame:
    """``drop_duplicates(keys, keep='last')``."""
    if any(k not in df.columns for k in keys):
        return df
    return first_per_key(df, keys, _reverse(order_by))


def prefer_flagged(df: DataFrame, keys, flag: Column, order_by, drop_null_keys: bool = True) -> DataFrame:
    """One row per key: the first flagged row if the group has one, else its first row.

    ``flag`` is a boolean Column (null counts as false).  Rows with a null key
    part are dropped, as a grouped pass would drop them.
    """
    out = df
    if drop_null_keys:
        out = out.dropna(subset=list(keys))
    order = [F.coalesce(flag, F.lit(False)).desc()] + _sort_cols(order_by)
    return first_per_key(out, keys, order)


def latest_per_key(
    df: DataFrame,
    key: str,
    period: str,
    order_by,
    career_label: str = "career",
    groups=(),
) -> DataFrame:
    """One row per key from its latest ``YYYY-YY`` period (ties: last in ``order_by``).

    Fallbacks apply to a whole frame (one-row flag aggregate, then only the
    chosen branch is planned) or to each ``groups`` slice, e.g. one per table
    tag (a small per-slice flag aggregate joined back, all lazy):
    * no period rows in the slice -> every row whose label is ``career`` (not deduped);
    * neither -> first row per key;
    * no period column at all -> last row per key.
    A key that only has a Career row is dropped when others in its slice have periods.
    """
    if key not in df.columns:
        return df
    groups = list(groups)
    keyed = df.filter(qcol(key).isNotNull())
    if period not in df.columns:
        return keep_last(keyed, [*groups, key], order_by)
    is_label = is_period_label(period)
    is_career = F.coalesce(F.lower(qcol(period).cast("string")) == F.lit(career_label), F.lit(False))
    flag_aggs = [F.max(is_label.cast("int")).alias("__has_period"), F.max(is_career.cast("int")).alias("__has_career")]
    if groups:
        # One row per slice: joined back on the slice key (AQE sizes the join at run time).
        flags = df.groupBy(*[qcol(g) for g in groups]).agg(*flag_aggs)
        marked = df.join(flags, groups, "left")
        has_period = F.coalesce(F.col("__has_period"), F.lit(0)) == 1
        has_career = F.coalesce(F.col("__has_career"), F.lit(0)) == 1
    else:
        # One whole-frame decision: a one-row aggregate picks the branch, so
        # only that branch is planned.
        f = df.agg(*flag_aggs).first()
        if (f["__has_period"] or 0) == 1:
            return first_per_key(keyed.filter(is_label), [key], [start_year(period).desc()] + _reverse(order_by))
        if (f["__has_career"] or 0) == 1:
            return df.filter(is_career)
        return first_per_key(keyed, [key], _sort_cols(order_by))
    keyed = marked.filter(qcol(key).isNotNull())
    # Three branches; per slice only one is non-empty.  Each keeps its
    # row_number()==1 shape so the partial group limit runs before the shuffle.
    latest = first_per_key(
        keyed.filter(has_period & is_label), [*groups, key],
        [start_year(period).desc()] + _reverse(order_by),
    )
    career_rows = marked.filter(~has_period & has_career & is_career)
    first_rows = first_per_key(
        keyed.filter(~has_period & ~has_career), [*groups, key], _sort_cols(order_by)
    )
    out = latest.unionByName(career_rows).unionByName(first_rows)
    return out.drop("__has_period", "__has_career") if groups else out


def earliest_value_per_key(
    df: DataFrame,
    key: str,
    year: Column,
    value: str,
    order_by,
    min_year: int | None = None,
    alias: str | None = None,
) -> DataFrame:
    """``(key, value)`` at the smallest year per key (first in ``order_by`` on ties).

    A declarative ``min_by`` with a struct ordering: partial aggregation on the
    map side, so skewed keys are pre-reduced before the shuffle.
    """
    out = df.withColumn("__y", year)
    if min_year is not None:
        out = out.filter(F.col("__y") >= min_year)
    ordering = F.struct(F.col("__y"), *[qcol(c) for c in order_by])
    return out.groupBy(qcol(key)).agg(F.min_by(qcol(value), ordering).alias(alias or value))


def first_seen(df: DataFrame, key: str, period: str, order_by=()) -> DataFrame:
    """Whole first row per key by smallest ``period`` (ties by ``order_by``)."""
    return first_per_key(df, [key], _sort_cols([period, *order_by]))


def top_n(df: DataFrame, order_cols: list[Column], n: int) -> DataFrame:
    """``ORDER BY ... LIMIT n`` (planned as TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.orderBy(*order_cols).limit(n)


def argmax_row(df: DataFrame, score: str, tiebreak: str) -> DataFrame:
    """Row with the largest ``score``; ties go to the smallest ``tiebreak``."""
    return df.orderBy(qcol(score).desc_nulls_last(), qcol(tiebreak).asc()).limit(1)


__all__ = [
    "argmax_row", "earliest_value_per_key", "first_per_key", "first_seen", "keep_first",
    "keep_last", "latest_per_key", "prefer_flagged", "top_n",
]
