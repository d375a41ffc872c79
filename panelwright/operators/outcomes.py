"""Entity outcome summary: dedupe, per-entity rollup, tiers, opportunity, z-scores.

Plan shape: one window (prefer-flagged dedupe, pre-limited before its
shuffle), one hash aggregation per entity (partial aggregation on the map
side), and two global one-row aggregates evaluated as scalar subqueries (the
window end and the eligible-set moments).  No cross join, no global window,
no collect.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import (
    between_years,
    opportunity_periods,
    safe_ratio,
    start_year,
    truncate_to_int,
    weighted_sum,
    zscore,
)
from panelwright.functions._util import qcol
from panelwright.operators.select import prefer_flagged
from panelwright.session import materialize

# The combined-stint label pattern and the default thresholds of
# the outcome definition (qualifying games/minutes, entry window, first valid
# year, nominal games per period, composite weights).
COMBINED_STINT_PATTERN = r"^[0-9]+TM$"
DEFAULT_MIN_GAMES = 10
DEFAULT_MIN_MINUTES = 100
DEFAULT_ENTRY_MIN = 2011
DEFAULT_ENTRY_MAX = 2022
DEFAULT_MIN_VALID_YEAR = 1990
DEFAULT_GAMES_PER_PERIOD = 82
DEFAULT_W_RATE = 0.70
DEFAULT_W_LONGEVITY = 0.30

SUMMARY_COLUMNS = [
    "first_period_start_year", "first_period", "career_games", "n_qualifying",
    "mean_rate_qual", "entry_cohort", "tier", "window_end_year", "eligible_periods",
    "nominal_max_games", "games_vs_opportunity", "z_rate", "z_longevity", "composite",
]


@dataclass
class OutcomeSpec:
    """Column names and parameters of an entity x period panel."""

    entity: str
    period: str
    stint: str
    games: str
    minutes: str
    weights: dict
    order_by: list = field(default_factory=list)
    flag_pattern: str = COMBINED_STINT_PATTERN
    min_games: float = DEFAULT_MIN_GAMES
    min_minutes: float = DEFAULT_MIN_MINUTES
    entry_min: int = DEFAULT_ENTRY_MIN
    entry_max: int = DEFAULT_ENTRY_MAX
    min_valid_year: int = DEFAULT_MIN_VALID_YEAR
    games_per_period: float = DEFAULT_GAMES_PER_PERIOD
    w_rate: float = DEFAULT_W_RATE
    w_longevity: float = DEFAULT_W_LONGEVITY


def combined_stint_flag(stint_col: str, pattern: str = COMBINED_STINT_PATTERN):
    return F.coalesce(qcol(stint_col).cast("string").rlike(pattern), F.lit(False))


def dedupe_periods(panel: DataFrame, spec: OutcomeSpec) -> DataFrame:
    """One row per (entity, period), preferring the combined-stint row."""
    return prefer_flagged(
        panel, [spec.entity, spec.period],
        combined_stint_flag(spec.stint, spec.flag_pattern), spec.order_by,
    )


def with_rate(df: DataFrame, spec: OutcomeSpec, index_col: str = "index_value", rate_col: str = "rate") -> DataFrame:
    """Weighted box-score index (F3) and its per-game rate."""
    return df.withColumn(index_col, weighted_sum(spec.weights)).withColumn(
        rate_col, safe_ratio(F.col(index_col), qcol(spec.games))
    )


def qualifying(spec: OutcomeSpec):
    """G >= min_games and MP >= min_minutes; null counts as not qualifying (A2)."""
    return F.coalesce(
        (qcol(spec.games) >= spec.min_games) & (qcol(spec.minutes) >= spec.min_minutes), F.lit(False)
    )


def tier_label(n_qual, career_games):
    """A: truncated games <= 0; B: none qualifying; C: one; D: two or more."""
    cg = truncate_to_int(career_games)
    return (
        F.when(cg <= 0, F.lit("A"))
        .when(n_qual == 0, F.lit("B"))
        .when(n_qual == 1, F.lit("C"))
        .otherwise(F.lit("D"))
    )


def entity_rollup(deduped: DataFrame, spec: OutcomeSpec) -> DataFrame:
    """Per-entity aggregate (A1) over deduped rows carrying ``rate``.

    Also carries each entity's latest valid and latest overall start year so
    the global window end (A3) is a reduction over entities, not rows.
    """
    y0 = start_year(spec.period)
    q = qualifying(spec)
    rows = deduped.select(
        qcol(spec.entity).alias("__e"),
        qcol(spec.period).alias("__p"),
        y0.alias("__y0"),
        qcol(spec.games).cast("double").alias("__g"),
        q.alias("__q"),
        F.col("rate"),
        *[qcol(c).alias(f"__o{i}") for i, c in enumerate(spec.order_by)],
    )
    ordering = F.struct(F.col("__y0"), *[F.col(f"__o{i}") for i in range(len(spec.order_by))])
    return rows.groupBy("__e").agg(
        F.min("__y0").alias("first_period_start_year"),
        F.min_by("__p", ordering).alias("first_period"),
        F.coalesce(F.sum("__g"), F.lit(0.0)).alias("career_games"),
        F.count_if(F.col("__q")).cast("int").alias("n_qualifying"),
        F.avg(F.when(F.col("__q"), F.col("rate"))).alias("mean_rate_qual"),
        F.max(F.when(F.col("__y0") >= spec.min_valid_year, F.col("__y0"))).alias("__ymax_valid"),
        F.max("__y0").alias("__ymax"),
    ).withColumnRenamed("__e", spec.entity)


def window_end_year(rollup: DataFrame):
    """Latest start year among valid years, else the latest of all (A3), as a scalar subquery."""
    return rollup.agg(F.coalesce(F.max("__ymax_valid"), F.max("__ymax")).alias("end")).scalar()


def career_summary(panel: DataFrame, spec: OutcomeSpec, materialize_rows: bool = True,
                   deduped: bool = False) -> DataFrame:
    """One row per entity with tier, cohort flag, opportunity share, z-scores and composite.

    With ``materialize_rows`` the per-entity rollup is written once to the
    shared checkpoint folder, so the summary and its two scalar reductions
    (window end, eligible moments) read a short plan instead of re-running
    the panel's joins and dedupe three times.  ``deduped`` says the panel is
    already one row per (entity, period), e.g. a stored deduped panel.
    """
    rows = with_rate(panel if deduped else dedupe_periods(panel, spec), spec)
    rollup = entity_rollup(rows, spec)
    if materialize_rows:
        rollup = materialize(rollup, "entity-rollup")
    end = window_end_year(rollup)
    summ = rollup.drop("__ymax_valid", "__ymax")
    summ = (
        summ.withColumn("entry_cohort", between_years("first_period_start_year", spec.entry_min, spec.entry_max))
        .withColumn("tier", tier_label(F.col("n_qualifying"), F.col("career_games")))
        .withColumn("window_end_year", end.cast("int"))
        .withColumn(
            "eligible_periods",
            opportunity_periods("first_period_start_year", F.col("window_end_year"), spec.min_valid_year).cast("double"),
        )
        .withColumn("nominal_max_games", F.col("eligible_periods") * F.lit(float(spec.games_per_period)))
        .withColumn("games_vs_opportunity", F.col("career_games") / F.col("nominal_max_games"))
    )
    return add_composite(summ, spec)


def add_composite(summ: DataFrame, spec: OutcomeSpec, restrict=None, suffix: str = "") -> DataFrame:
    """z-scores on the eligible subset (tier D and cohort) and the weighted composite.

    ``restrict`` narrows the eligible set further and ``suffix`` names the
    outputs, which re-standardises within a sub-cohort (M23).
    """
    eligible = (F.col("tier") == "D") & F.col("entry_cohort")
    if restrict is not None:
        eligible = eligible & F.coalesce(restrict, F.lit(False))
    longevity = F.log1p(F.col("games_vs_opportunity"))
    moments = (
        summ.filter(eligible)
        .agg(
            F.struct(
                F.avg("mean_rate_qual").alias("mr"),
                F.stddev_pop("mean_rate_qual").alias("sr"),
                F.avg(longevity).alias("ml"),
                F.stddev_pop(longevity).alias("sl"),
            ).alias("m")
        )
        .scalar()
    )
    z_rate = F.when(eligible, zscore("mean_rate_qual", moments.getField("mr"), moments.getField("sr")))
    z_long = F.when(eligible, zscore(longevity, moments.getField("ml"), moments.getField("sl")))
    return (
        summ.withColumn(f"z_rate{suffix}", z_rate)
        .withColumn(f"z_longevity{suffix}", z_long)
        .withColumn(
            f"composite{suffix}",
            F.when(eligible, F.lit(spec.w_rate) * F.col(f"z_rate{suffix}")
                   + F.lit(spec.w_longevity) * F.col(f"z_longevity{suffix}")),
        )
    )


def quartile_label(summ: DataFrame, value: str = "composite") -> DataFrame:
    """'top' at or above the 75th percentile, 'bottom' at or below the 25th, else 'middle' (M21, spec item).

    The two cut points are exact interpolated quantiles from the distributed
    quantile job, used as one scalar subquery.
    """
    from panelwright.operators.quantiles import quantile_columns

    cuts = quantile_columns(summ, value, (0.25, 0.75), ["q25", "q75"]).select(F.struct("q25", "q75")).scalar()
    v = qcol(value)
    return summ.withColumn(
        "quartile",
        F.when(v >= cuts.getField("q75"), F.lit("top")).when(v <= cuts.getField("q25"), F.lit("bottom"))
        .when(v.isNotNull(), F.lit("middle")),
    )


def prime_rate(panel: DataFrame, spec: OutcomeSpec, best: int = 3) -> DataFrame:
    """Mean of each entity's ``best`` highest qualifying per-game rates (M22, spec item).

    ``row_number() <= best`` keeps the partial group limit before the shuffle.
    """
    from pyspark.sql import Window

    rated = with_rate(dedupe_periods(panel, spec), spec).filter(qualifying(spec) & F.col("rate").isNotNull())
    w = Window.partitionBy(qcol(spec.entity)).orderBy(F.col("rate").desc(), qcol(spec.period).asc())
    top = rated.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= best)
    return top.groupBy(qcol(spec.entity)).agg(F.avg("rate").alias("prime_rate"), F.count(F.lit(1)).alias("n_prime"))


__all__ = [
    "OutcomeSpec", "SUMMARY_COLUMNS", "add_composite", "career_summary", "combined_stint_flag",
    "dedupe_periods", "entity_rollup", "prime_rate", "quartile_label", "qualifying", "tier_label",
    "window_end_year", "with_rate",
]
