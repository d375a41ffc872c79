"""Joins and set operations that assemble the panel.

All joins are equi-joins left to Catalyst: AQE turns a join into a broadcast
only when the runtime size of a side is under the threshold (a checked size),
otherwise sort-merge with skew splitting.  Patch and block joins follow the
null-equals-null matching of a pandas merge via null-safe equality.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.select import keep_first


class DuplicateKeyError(ValueError):
    """A join declared one-to-one found a repeated key."""


def left_join(df: DataFrame, dim: DataFrame, on, fill: dict | None = None) -> DataFrame:
    """Left join keeping every row of ``df``; ``fill`` replaces nulls from missing matches."""
    out = df.join(dim, on=on, how="left")
    for c, v in (fill or {}).items():
        out = out.withColumn(c, F.coalesce(qcol(c), F.lit(v)))
    return out


def patch_join(base: DataFrame, patch: DataFrame, keys, columns, order_by=(), no_null_keys: bool = False) -> DataFrame:
    """Fill ``columns`` on ``base`` from ``patch``, preferring non-null patch values.

    The patch is reduced to its first row per key, absent base columns are
    created as null, and every base row sharing the key gets the same values.
    ``no_null_keys`` says that ``base`` has none: both sides then join where
    their own passes by these keys have left them.
    """
    if any(k not in patch.columns or k not in base.columns for k in keys):
        return base
    present = [c for c in columns if c in patch.columns]
    if not present:
        return base
    order_cols = [c for c in order_by if c in patch.columns]
    p = keep_first(patch.select(*dict.fromkeys([*keys, *present, *order_cols])), keys, order_cols)
    p = p.select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                 *[qcol(c).alias(f"__p_{c}") for c in present])
    out = base
    types = dict(patch.dtypes)
    for c in present:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(types[c]))
    cond = reduce(lambda a, b: a & b, [out[k] == p[f"__k{i}"] if no_null_keys else out[k].eqNullSafe(p[f"__k{i}"]) for i, k in enumerate(keys)])
    joined = out.join(p, cond, "left")
    cols = [F.coalesce(F.col(f"__p_{c}"), out[c]).alias(c) if c in present else out[c] for c in out.columns]
    return joined.select(*cols)


def assert_unique(df: DataFrame, keys, side: str) -> None:
    """Raise ``DuplicateKeyError`` if any key repeats (one bounded aggregation)."""
    dup = df.groupBy(*[qcol(k) for k in keys]).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{side} side has a repeated key {keys}: {dup[0].asDict()}")


def validated_left_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left join declared one-to-one: a repeated key on either side raises."""
    assert_unique(left, keys, "left")
    assert_unique(right, keys, "right")
    return left.join(right, on=list(keys), how="left")


def once_per_key(df: DataFrame, keys, side: str) -> DataFrame:
    """``df`` with a check in its plan: a key on two rows ends the query with an error."""
    keys = list(keys)
    rows = df.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*[qcol(k) for k in keys])))
    said = F.concat(F.lit(f"{side} side has a repeated key {keys}: "), F.to_json(F.struct(*[qcol(k) for k in keys])))
    return rows.where(F.when(F.col("__rows") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))).drop("__rows")


def checked_left_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left join declared one-to-one, checked while it runs.

    The rows of a key are counted where the join's own exchange and sort have
    brought them, so the check reads no input again; a repeated key
    on either side fails the query.  Null keys count on the left; on the right
    they match nothing and are left out before the check.
    """
    return once_per_key(left, keys, "left").join(once_per_key(right, keys, "right"), on=list(keys), how="left")


def left_join_spread(df: DataFrame, dim: DataFrame, key: str, spread_by) -> DataFrame:
    """Left join on a text key in which rows without a key match nothing and spread over all tasks.

    ``spread_by`` names the columns whose hash spreads them.
    """
    salt = F.concat(F.lit("\u0001"), F.xxhash64(*[qcol(c) for c in spread_by]).cast("string"))
    right = dim.where(qcol(key).isNotNull()).withColumnRenamed(key, "__right")
    joined = df.withColumn("__left", F.coalesce(qcol(key).cast("string"), salt))
    joined = joined.join(right, F.col("__left") == F.col("__right").cast("string"), "left")
    return joined.drop("__left", "__right")


def anti_join(df: DataFrame, key_set: DataFrame, key: str, set_key: str | None = None,
              as_text: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is not in ``key_set``.

    Keys compare as text when ``as_text``; a null key never matches, so the
    row is kept (the ``~isin`` behaviour).
    """
    set_key = set_key or key
    k = qcol(key).cast("string") if as_text else qcol(key)
    s = key_set.select((qcol(set_key).cast("string") if as_text else qcol(set_key)).alias("__sk")).distinct()
    return df.join(s, k == F.col("__sk"), "left_anti")


def key_set_diff(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """One row: distinct non-null keys in ``a`` missing from ``b`` and in ``b`` missing from ``a``."""
    ka = a.select(qcol(key_a).cast("string").alias("k")).dropna().distinct()
    kb = b.select(qcol(key_b).cast("string").alias("k")).dropna().distinct()
    # One full outer join on the distinct keys gives both directions in one shuffle.
    j = ka.withColumn("in_a", F.lit(True)).join(kb.withColumn("in_b", F.lit(True)), "k", "full")
    return j.agg(
        F.count_if(F.col("in_b").isNull()).alias("missing_in_b"),
        F.count_if(F.col("in_a").isNull()).alias("extra_in_b"),
    )


def union_by_name(frames) -> DataFrame:
    """Union of frames with differing columns; absent columns are null."""
    frames = [f.toDF(*f.columns) for f in frames]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def replace_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` whose key is absent from ``new``, plus all of ``new``."""
    return union_by_name([anti_join(existing, new, key), new])


def backfill(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the ``candidates`` rows for keys ``existing`` lacks."""
    return union_by_name([existing, anti_join(candidates, existing, key)])


def outer_blocks(blocks: list[DataFrame], key: str) -> DataFrame:
    """Full outer assembly of per-key blocks with disjoint column sets.

    A chain of full outer joins would re-shuffle after every join (the merged
    key loses its partitioning).  Instead the blocks are unioned and reduced
    per key in one shuffle; each column comes from exactly one block with at
    most one row per key, so ``max`` returns that value (nulls group together,
    like a pandas outer merge).
    """
    u = union_by_name(blocks)
    others = [c for c in u.columns if c != key]
    return u.groupBy(qcol(key)).agg(*[F.max(qcol(c)).alias(c) for c in others])


__all__ = [
    "DuplicateKeyError", "anti_join", "assert_unique", "backfill", "checked_left_join", "key_set_diff", "left_join",
    "left_join_spread", "once_per_key", "outer_blocks", "patch_join", "replace_by_key", "union_by_name", "validated_left_join",
]
