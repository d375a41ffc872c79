"""Modeling cohort: mask, complete cases, demographics, feature selection and projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import dummies, position_code, start_year, to_number
from panelwright.functions._util import qcol
from panelwright.operators.assemble import checked_left_join
from panelwright.operators.clean import require_non_null
from panelwright.operators.outcomes import OutcomeSpec, dedupe_periods
from panelwright.operators.select import earliest_value_per_key, keep_first

# The missing-share limit for data-driven feature selection.
MAX_MISSING_SHARE = 0.5


def cohort_mask(tier: str, cohort: str, link: str, target: str, tier_value: str = "D"):
    """tier == D, cohort flag (null -> false), link id present and non-empty, target present."""
    return (
        (qcol(tier) == F.lit(tier_value))
        & F.coalesce(qcol(cohort), F.lit(False))
        & qcol(link).isNotNull()
        & (F.length(qcol(link).cast("string")) > 0)
        & qcol(target).isNotNull()
    )


def feature_projection(df: DataFrame, id_col: str, features, target: str) -> DataFrame:
    """id + features + target; raises ``KeyError`` naming every missing column."""
    missing = [c for c in [id_col, *features, target] if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(qcol(id_col), *[qcol(c) for c in features], qcol(target))


def feature_candidates(df: DataFrame, prefixes=(), extra=(), exclude=()) -> list[str]:
    return sorted({c for c in df.columns
                   if c not in exclude and (any(c.startswith(p) for p in prefixes) or c in extra)})


def feature_stats(df: DataFrame, prefixes=(), extra=(), exclude=(), max_missing: float = MAX_MISSING_SHARE) -> DataFrame:
    """Per candidate column: missing share after numeric coercion and the keep decision (P20).

    Candidates are prefixed or listed columns; a column is kept when its
    missing share is <= ``max_missing`` and it has at least two distinct
    numeric values (min < max).  One aggregation pass over all candidates.
    """
    cands = feature_candidates(df, prefixes, extra, exclude)
    aggs = []
    for i, c in enumerate(cands):
        x = to_number(qcol(c))
        aggs += [F.avg(x.isNull().cast("double")).alias(f"m{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("missing_share"),
                     ((F.col(f"m{i}") <= max_missing) & (F.col(f"lo{i}") < F.col(f"hi{i}"))).alias("kept"))
            for i, c in enumerate(cands)]
    out = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.feature", "s.missing_share", "s.kept")
    return out.withColumn("kept", F.coalesce(F.col("kept"), F.lit(False)))


def select_features(df: DataFrame, prefixes=(), extra=(), exclude=(), max_missing: float = MAX_MISSING_SHARE) -> list[str]:
    """Kept feature names, sorted (the list has one entry per candidate column, so it is small)."""
    if not feature_candidates(df, prefixes, extra, exclude):
        return []
    stats = feature_stats(df, prefixes, extra, exclude, max_missing).filter("kept").collect()
    return sorted(r["feature"] for r in stats)


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Every listed column as double; unparsable text -> null."""
    return df.select(*[to_number(qcol(c)).alias(c) if c in cols else qcol(c) for c in df.columns])


def debut_age(first_year: str, birth: str):
    """first start year - birth year, null when the birth text is not a date."""
    return (qcol(first_year) - F.year(F.try_to_date(qcol(birth).cast("string")))).cast("double")


def rookie_position(deduped: DataFrame, spec: OutcomeSpec, pos_col: str, valid, min_year: int) -> DataFrame:
    """``(entity, __position)``: position code on the earliest deduped period >= ``min_year``."""
    first = earliest_value_per_key(
        deduped, spec.entity, start_year(spec.period), pos_col, [spec.period, *spec.order_by],
        min_year=min_year, alias="__pos",
    )
    return first.select(qcol(spec.entity), position_code(F.col("__pos"), valid).alias("__position"))


def attach_demographics(df: DataFrame, panel: DataFrame, spec: OutcomeSpec, *, birth: str, pos_col: str,
                        valid, dummy_levels, prefix: str = "pos_is_", min_year: int = 1990,
                        deduped: bool = False) -> DataFrame:
    """Add debut age and position dummies (C5); unknown positions share the baseline."""
    rook = rookie_position(panel if deduped else dedupe_periods(panel, spec), spec, pos_col, valid, min_year)
    out = df.withColumn("debut_age", debut_age("first_period_start_year", birth)).join(rook, spec.entity, "left")
    return out.select("*", *dummies(F.col("__position"), dummy_levels, prefix)).drop("__position")


def modeling_cohort(panel: DataFrame, summary: DataFrame, spec: OutcomeSpec, *, link: str,
                    target: str = "composite", require=(), birth: str, pos_col: str, valid,
                    dummy_levels, min_year: int = 1990, deduped: bool = False) -> DataFrame:
    """Eligible entities with every panel column plus demographics (C4).

    First deduped row per entity, one-to-one join with the summary, cohort
    mask, complete cases on ``require``, then demographics.  ``deduped`` says
    ``panel`` is already one row per (entity, period).
    """
    ded = panel if deduped else dedupe_periods(panel, spec)
    first_rows = keep_first(ded, [spec.entity], [spec.period, *spec.order_by])
    base = checked_left_join(first_rows, summary, [spec.entity])
    masked = base.filter(cohort_mask("tier", "entry_cohort", link, target))
    masked = require_non_null(masked, list(require))
    return attach_demographics(masked, ded, spec, birth=birth, pos_col=pos_col, valid=valid,
                               dummy_levels=dummy_levels, min_year=min_year, deduped=True)


__all__ = [
    "MAX_MISSING_SHARE", "attach_demographics", "coerce_numeric", "cohort_mask", "debut_age",
    "feature_candidates", "feature_projection", "feature_stats", "modeling_cohort", "rookie_position", "select_features",
]
