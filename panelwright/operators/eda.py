"""Profiling and exploratory summaries (counts, null rates, describe, correlation, histogram, box stats).

Every summary is one or two aggregation passes whose output is small
(per column or per group).  Wide inputs are unpivoted to ``(column, value)``
so many columns share one quantile job.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.quantiles import column_quantiles, exact_quantiles, quantile_columns
from panelwright.session import materialize

DESCRIBE_PROBS = (0.25, 0.5, 0.75)
#: Columns up to which correlations are aggregates of their own for each pair.
PAIR_COLUMNS = 16


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value; null is its own category."""
    return df.groupBy(qcol(col)).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, conditions: dict) -> DataFrame:
    """One row of ``count_if`` per named condition."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def max_group_size(df: DataFrame, keys) -> Column:
    """Largest group size for ``keys`` as a scalar Column (A5 grain check)."""
    return df.groupBy(*[qcol(k) for k in keys]).count().agg(F.max("count")).scalar()


def top_groups(df: DataFrame, col: str, n: int = 3) -> DataFrame:
    """The ``n`` largest groups by size, ties by key."""
    return value_counts(df, col).orderBy(F.col("n").desc(), qcol(col).asc_nulls_first()).limit(n)


def null_rates(df: DataFrame, cols=None) -> DataFrame:
    """``(column, pct_missing)`` for every column from one pass, sorted by share desc (A10, K7)."""
    cols = list(cols or df.columns)
    wide = df.agg(
        *[(F.count_if(qcol(c).isNull()) * 100.0 / F.count(F.lit(1))).alias(f"c{i}") for i, c in enumerate(cols)]
    )
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("pct_missing"))
                                for i, c in enumerate(cols)]))
    return wide.select(stack.alias("s")).select("s.column", "s.pct_missing").orderBy(F.col("pct_missing").desc(), "column")


def unpivot_values(df: DataFrame, cols, ids=()) -> DataFrame:
    """Long ``(*ids, column, value)`` with values cast to double."""
    return df.select(*[qcol(i) for i in ids], *[qcol(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), "column", "value"
    )


def describe(df: DataFrame, cols, probs=DESCRIBE_PROBS) -> DataFrame:
    """One row per column: count, mean, sample std, min, quartiles, max."""
    cols = list(cols)
    x = [qcol(c).cast("double") for c in cols]
    wide = df.agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(x) for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    each = [F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in ("count", "mean", "std", "min", "max")]) for i, c in enumerate(cols)]
    moments = wide.select(F.explode(F.array(*each)).alias("s")).select("s.*")
    names = [f"p{int(round(p * 100))}" for p in probs]
    q = column_quantiles(df, {c: qcol(c) for c in cols}, probs)
    q = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for p, n in zip(probs, names)])
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation for every column pair, pairwise-complete, long form.

    One aggregation holds p(p+1)/2 ``corr`` accumulators; each skips rows
    where either value is null.
    """
    if len(cols) > PAIR_COLUMNS:
        return corr_by_gram(df, cols)
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(qcol(a).cast("double"), qcol(b).cast("double")).alias(f"r{i}")
                   for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("r")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"r{i}").alias("r")))
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.col_a", "s.col_b", "s.r")


def corr_by_gram(df: DataFrame, cols) -> DataFrame:
    """:func:`corr_matrix` for many columns: sums of products, of values where the other is null, and of nulls, in NumPy blocks.

    A pair's rows are those where both have a value, so its sums are the whole
    ones less those over the other column's nulls.  Values are taken from
    their column's minimum, which keeps the differences exact enough.
    """
    from panelwright.operators.modeling import masked_gram

    cols, p = list(cols), len(cols)
    low = df.agg(*[F.min(F.nanvl(qcol(c).cast("double"), F.lit(None))).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    g = masked_gram(df, cols, shift={c: low[f"c{i}"] for i, c in enumerate(cols)}, squares=True).get(0, np.zeros((3 * p + 1, 3 * p + 1)))
    x, m, s = slice(1, p + 1), slice(p + 1, 2 * p + 1), slice(2 * p + 1, 3 * p + 1)
    n = g[0, 0] - g[0, m][:, None] - g[0, m][None, :] + g[m, m]
    sx = g[0, x][:, None] - g[x, m]  # of the first column, over the pair's rows
    sxx = g[0, s][:, None] - g[s, m]
    with np.errstate(invalid="ignore", divide="ignore"):
        cov = g[x, x] - sx * sx.T / n
        var = np.maximum(sxx - sx * sx / n, 0.0)
        flat = var <= 1e-13 * sxx
        r = np.where(flat | flat.T | (n < 2), np.nan, cov / np.sqrt(var * var.T))
    rows = [(a, b, None if np.isnan(r[i, j]) else float(np.clip(r[i, j], -1.0, 1.0))) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def histogram(df: DataFrame, value: str, bins: int, group: str | None = None) -> DataFrame:
    """Equal-width bins from min to max (last bin closed), zero-filled.

    Rows ``(group?, bin, lo, hi, n)``.  A constant column puts all values in
    the middle bin, as NumPy does.
    """
    gcols = [qcol(group)] if group else []
    v = qcol(value).cast("double")
    data = df.select(*gcols, v.alias("__x")).filter(F.col("__x").isNotNull())
    keys = [group] if group else []
    rng = data.groupBy(*keys).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    width = F.col("__mx") - F.col("__mn")
    b = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__mn")) / width * bins), F.lit(bins - 1))
    ).cast("int")
    if keys:
        joined = data.join(rng, keys)  # rng: one row per group, sized at run time by AQE
    else:
        bounds = rng.select(F.struct("__mn", "__mx").alias("b")).scalar()
        joined = data.withColumn("__mn", bounds.getField("__mn")).withColumn("__mx", bounds.getField("__mx"))
    counts = joined.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = grid.join(counts, [*keys, "bin"], "left").select(
        *[qcol(k) for k in keys], "bin",
        (F.col("__mn") + F.col("bin") * (F.col("__mx") - F.col("__mn")) / bins).alias("lo"),
        (F.col("__mn") + (F.col("bin") + 1) * (F.col("__mx") - F.col("__mn")) / bins).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )
    return out


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Per group: quartiles, 1.5 IQR fences, whisker ends inside the fences, outlier count."""
    q = quantile_columns(df, value, (0.25, 0.5, 0.75), ["q1", "median", "q3"], groups=[group])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "lo_fence", F.col("q1") - 1.5 * F.col("iqr")
    ).withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = qcol(value).cast("double")
    # q has one row per group; the join is planned by AQE on its runtime size.
    j = df.select(qcol(group), x.alias("__x")).filter(F.col("__x").isNotNull()).join(q, group)
    inside = (F.col("__x") >= F.col("lo_fence")) & (F.col("__x") <= F.col("hi_fence"))
    agg = j.groupBy(group).agg(
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )
    return q.join(agg, group).select(group, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "n_outliers")


def first_non_null(df: DataFrame, key: str, cols, order_by) -> DataFrame:
    """Per key, the first non-null value of each column independently."""
    ordering = F.struct(*[qcol(c) for c in order_by])
    return df.groupBy(qcol(key)).agg(
        *[F.min_by(qcol(c), F.when(qcol(c).isNotNull(), ordering)).alias(c) for c in cols]
    )


def scatter_pairs(df: DataFrame, x: str, y: str, extra=()) -> DataFrame:
    """Non-null ``(x, y)`` pairs for a scatter plot."""
    return df.select(*[qcol(c) for c in extra], qcol(x), qcol(y)).dropna(subset=[x, y])


def pivot_report(df: DataFrame, index: str, columns: str, values: str, levels) -> DataFrame:
    """Long -> wide with declared levels (P24); one value per cell expected."""
    return df.groupBy(qcol(index)).pivot(columns, list(levels)).agg(F.first(qcol(values)))


def cumulative_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share and running share of ``value`` ordered by value desc then key.

    Two passes: rows are range partitioned and written in order; the running
    sum of a row is its partition's running sum plus the total of the
    partitions before, of which the driver holds one number each.
    """
    spark = df.sparkSession
    order = [qcol(value).desc(), qcol(key).asc()]
    placed = df.select(qcol(key), qcol(value)).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("__pid", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()), "running-share")
    sums = placed.groupBy("__pid").agg(F.sum(qcol(value)).alias("s")).orderBy("__pid").collect()  # one row a partition
    ends = np.cumsum([float(r["s"] or 0.0) for r in sums])
    offsets = spark.createDataFrame([(r["__pid"], float(e - (r["s"] or 0.0))) for r, e in zip(sums, ends, strict=True)], "__pid int, __before double")
    total = F.lit(float(ends[-1]) if len(ends) else None).cast("double")
    w = Window.partitionBy("__pid").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(offsets), "__pid").select(
        qcol(key), qcol(value), (qcol(value) / total).alias("share"),
        ((F.col("__before") + F.coalesce(F.sum(qcol(value)).over(w), F.lit(0.0))) / total).alias("cum_share"),
    )


#: Most frequent values that a profile names.
PROFILE_TOP = 3


def profile_columns(df: DataFrame, cols=None, top: int = PROFILE_TOP) -> DataFrame:
    """One row per column: rows, nulls and their share, distinct values, mean, sd, range, most frequent values.

    The table is read once and counted by (column, value); everything else
    comes from these counts.  Equal values combine before the shuffle, so a
    value that most rows share costs no more than others.  Numbers of columns
    that are not numeric are null; their range is that of the text.
    """
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal")}
    cells = F.array(*[F.struct(F.lit(i).alias("c"), qcol(c).cast("string").alias("v"), (qcol(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("x")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(cells).alias("s")).groupBy("s.c", "s.v", "s.x").agg(F.count(F.lit(1)).alias("n"))
    there = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)
    mean = F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))
    moments = counts.groupBy("c").agg(
        F.sum("n").alias("n_rows"), (F.sum("n") - F.sum(there)).alias("n_null"), F.count("v").alias("n_distinct"), mean.alias("mean"),
        F.sum(F.when(F.col("x").isNotNull(), F.col("n"))).alias("m"), F.min("x").alias("min"), F.max("x").alias("max"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    far = counts.where("x is not null").join(moments.select("c", F.col("mean").alias("mu")), "c").groupBy("c").agg(F.sum((F.col("x") - F.col("mu")) ** 2 * F.col("n")).alias("ss"))
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.col("n").desc(), F.col("v").asc()))
    first = counts.where("v is not null").withColumn("r", rank).where(F.col("r") <= top)
    named = first.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("r", F.concat("v", F.lit(":"), F.col("n").cast("string")).alias("t")))).alias("t"))  # ``top`` values a column
    names = F.array(*[F.lit(c) for c in cols])
    return moments.join(far, "c", "left").join(named, "c", "left").select(
        names[F.col("c")].alias("column"), "n_rows", "n_null", (F.col("n_null") / F.col("n_rows")).alias("null_share"), "n_distinct", "mean",
        F.when(F.col("m") > 1, F.sqrt(F.col("ss") / (F.col("m") - 1))).alias("std"), "min", "max",
        "least", "greatest", F.array_join("t.t", "|").alias("top_values"))


__all__ = [
    "box_stats", "conditional_counts", "corr_by_gram", "corr_matrix", "cumulative_share", "describe",
    "exact_quantiles", "first_non_null", "histogram", "max_group_size", "null_rates",
    "pivot_report", "profile_columns", "scatter_pairs", "top_groups", "unpivot_values", "value_counts",
]
