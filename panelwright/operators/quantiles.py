"""Exact, linearly interpolated quantiles and global ranks without gathering a group into one task.

``percentile()`` keeps a value->count map per group in one buffer, which is
unbounded for a continuous column or a hot group.  Here a sketch first
brackets each quantile, and the exact aggregate sees the values outside the
brackets as one value each: two passes of aggregates that combine on the map
side, no sort and no shuffle of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.session import materialize

#: Accuracy of the sketches (rank error at most one part in so many), steps of a narrowing sketch, and
#: values that the exact aggregate may hold per bracket.
ACCURACY, ACCURACY_STEPS, BRACKET_VALUES = 2_000, 1_000, 1_000_000


def global_rank(df: DataFrame, order, groups=(), num_partitions: int | None = None, label: str = "ranked") -> DataFrame:
    """``df`` plus ``__r`` (0-based rank within its group) and ``__n`` (rows of the group).

    Rows are range partitioned by group and order, so no group meets in one
    task, and written once.  The offsets are counted on the written table: both
    sides of the join see the same partitions whatever the planner reuses.
    ``order`` must end in a tiebreak that tells rows apart if ranks are to be
    the same in every run.
    """
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__id", F.monotonically_increasing_id())
    )
    placed = materialize(placed, label)
    # Per (partition, group): first id and row count (rows: partitions x groups).
    blocks = placed.groupBy("__pid", *groups).agg(F.min("__id").alias("__id0"), F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__c").over(w), F.lit(0))
    total = F.sum("__c").over(Window.partitionBy(*groups))
    names = ["__pid", *groups]
    offsets = blocks.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(names)], "__id0", before.alias("__off"), total.alias("__n"))
    # A null group is a group of its own; offsets are small for a few groups, but
    # not bounded in general, so AQE picks broadcast or shuffle from their run-time size.
    on = F.lit(True)
    for i, c in enumerate(names):
        on = on & F.col(c).eqNullSafe(F.col(f"__o{i}"))
    return placed.join(offsets, on).select(*df.columns, (F.col("__off") + F.col("__id") - F.col("__id0")).alias("__r"), "__n")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs,
    groups=(),
    num_partitions: int | None = None,
) -> DataFrame:
    """Rows ``(*groups, prob, quantile)`` with pandas/NumPy ``linear`` interpolation.

    Null and NaN values are ignored; a group with no values has no rows.
    ``num_partitions`` spreads the values before they are aggregated (default:
    as they lie).
    """
    if num_partitions:
        df = df.repartition(num_partitions)
    return column_quantiles(df, {"value": qcol(value)}, probs, groups, "__column").drop("__column")


class _Brackets:
    """Per column and probability a value range that holds the wanted ranks.

    Aggregates are SQL text, since a search asks for hundreds of them at once.
    ``text`` gives the two edges of a bracket: literals where all rows are one
    group, else columns that :meth:`rows` joins to the values.
    """

    def __init__(self, vals: DataFrame, names: list[str], probs: list[float], groups: list[str]):
        self.vals, self.names, self.probs, self.groups = vals, names, probs, groups
        self.cells = [(v, k) for v in names for k in range(len(probs))]
        self.text: dict[tuple, tuple[str, str]] = {}
        self.table: DataFrame | None = None

    def small(self, df: DataFrame) -> DataFrame | dict:
        """A small aggregate that is read more than once: groups go to a written table, one row to the driver."""
        return materialize(df, "quantile-groups") if self.groups else df.first().asDict()

    def largest(self, small: DataFrame | dict, column) -> float:
        values = [column(v) for v in self.names]
        if self.groups:
            values = small.agg(*[F.max(c) for c in values]).first()
            return max((x or 0 for x in values), default=0)
        return max(small[c] for c in values)

    def take(self, small: DataFrame | dict, low, high) -> None:
        """New edges; ``low`` and ``high`` give for a cell an array column and the place in it (a number, or text by group)."""
        if self.groups:
            picks = [f"get({c}, {i}) AS {v}_{side}{k}" for v, k in self.cells for side, (c, i) in (("lo", low(v, k)), ("hi", high(v, k)))]
            self.table = small.selectExpr(*[f"{g} AS {g}_e" for g in self.groups], *picks)
            self.text = {(v, k): (f"{v}_lo{k}", f"{v}_hi{k}") for v, k in self.cells}
            return
        edges = {cell: [(small[c] or [])[i : i + 1] for c, i in (low(*cell), high(*cell))] for cell in self.cells}
        self.text = {cell: tuple(f"CAST('{x[0]!r}' AS DOUBLE)" if x else "CAST(NULL AS DOUBLE)" for x in pair) for cell, pair in edges.items()}

    def rows(self) -> DataFrame:
        if self.table is None:
            return self.vals
        on = F.lit(True)
        for g in self.groups:
            on = on & F.col(g).eqNullSafe(F.col(f"{g}_e"))
        return self.vals.join(self.table, on)  # one row a group, planned by its run-time size

    def aggregate(self, rows: DataFrame, texts: list[str]) -> DataFrame:
        return rows.groupBy(*self.groups).agg(*[F.expr(t) for t in texts])

    def clamped(self, v: str) -> str:
        """A rising function of the value that keeps what lies in a bracket and folds all between two brackets into one."""
        by = sorted(range(len(self.probs)), key=lambda k: self.probs[k])
        out = f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} < {self.text[v, by[0]][0]} THEN {self.text[v, by[0]][0]}"
        for a, b in zip(by, [*by[1:], None], strict=True):
            out += f" WHEN {v} <= {self.text[v, a][1]} THEN {v}"
            if b is not None:
                out += f" WHEN {v} < {self.text[v, b][0]} THEN {self.text[v, a][1]}"
        return f"{out} ELSE {self.text[v, by[-1]][1]} END"

    def inside(self, v: str, k: int) -> str:
        return f"CASE WHEN {v} >= {self.text[v, k][0]} AND {v} <= {self.text[v, k][1]} THEN {v} END"

    def start(self, width: float) -> float:
        """First edges, ``width`` of all ranks to each side; the most values of any column and group."""
        n = len(self.probs)
        shares = ", ".join(f"{x!r}D" for x in [*(max(0.0, p - width) for p in self.probs), *(min(1.0, p + width) for p in self.probs)])
        got = self.small(self.aggregate(self.vals, [t for v in self.names for t in (f"percentile_approx({v}, array({shares}), {ACCURACY}) AS {v}_s", f"count({v}) AS {v}_n")]))
        self.take(got, lambda v, k: (f"{v}_s", k), lambda v, k: (f"{v}_s", n + k))
        return self.largest(got, lambda v: f"{v}_n")

    def narrow(self) -> None:
        """Narrower edges, from the ranks that the present ones leave and a sketch of the values inside each."""
        steps = ACCURACY_STEPS
        shares = "array(" + ", ".join(f"{i / steps!r}D" for i in range(steps + 1)) + ")"
        texts = [f"count({v}) AS {v}_n" for v in self.names]
        for v, k in self.cells:
            texts += [f"count_if({v} < {self.text[v, k][0]}) AS {v}_b{k}", f"count({self.inside(v, k)}) AS {v}_i{k}"]
            texts.append(f"percentile_approx({self.inside(v, k)}, {shares}, {ACCURACY}) AS {v}_c{k}")
        got = self.small(self.aggregate(self.rows(), texts))
        if self.groups:
            spot = lambda v, k: f"({self.probs[k]!r}D * ({v}_n - 1) - {v}_b{k}) / greatest({v}_i{k}, 1) * {steps}"
            self.take(got, lambda v, k: (f"{v}_c{k}", f"CAST(greatest(0, floor({spot(v, k)}) - 1) AS INT)"), lambda v, k: (f"{v}_c{k}", f"CAST(least({steps}, ceil({spot(v, k)}) + 2) AS INT)"))
        else:
            spot = lambda v, k: (self.probs[k] * (got[f"{v}_n"] - 1) - got[f"{v}_b{k}"]) / max(got[f"{v}_i{k}"], 1) * steps
            self.take(got, lambda v, k: (f"{v}_c{k}", max(0, math.floor(spot(v, k)) - 1)), lambda v, k: (f"{v}_c{k}", min(steps, math.ceil(spot(v, k)) + 2)))

    def exact(self) -> tuple[DataFrame | dict, bool]:
        """The quantiles as arrays ``<column>_q``, and whether all wanted ranks lay inside their brackets."""
        probs = ", ".join(f"{p!r}D" for p in self.probs)
        texts = [t for v in self.names for t in (f"percentile({self.clamped(v)}, array({probs})) AS {v}_q", f"count({v}) AS {v}_n")]
        texts += [t for v, k in self.cells for t in (f"count_if({v} < {self.text[v, k][0]}) AS {v}_b{k}", f"count_if({v} <= {self.text[v, k][1]}) AS {v}_u{k}")]
        got = self.small(self.aggregate(self.rows(), texts))
        if not self.groups:
            spots = [(p * (got[f"{v}_n"] - 1), got[f"{v}_b{k}"], got[f"{v}_u{k}"]) for v, k in self.cells for p in [self.probs[k]] if got[f"{v}_n"]]
            return got, all(math.floor(x) >= below and math.ceil(x) < upto for x, below, upto in spots)
        missed = [f"({v}_n > 0 AND (floor({self.probs[k]!r}D * ({v}_n - 1)) < {v}_b{k} OR ceil({self.probs[k]!r}D * ({v}_n - 1)) >= {v}_u{k}))" for v, k in self.cells]
        return got, not got.where(" OR ".join(missed)).limit(1).count()


def column_quantiles(df: DataFrame, columns: dict[str, Column], probs, groups=(), name: str = "column") -> DataFrame:
    """Rows ``(*groups, <name>, prob, quantile)`` for several columns at once, exact and without sorting or moving rows.

    A sketch (``percentile_approx``) brackets each quantile; in a second pass
    every value outside the brackets is folded onto a bracket's edge, which
    changes no wanted rank, so the exact ``percentile`` buffers hold the
    values inside the brackets only.  The same pass counts the values below
    and up to each bracket; if a rank lies outside, the brackets are widened and
    the pass repeated.  Where a bracket would hold more than ``BRACKET_VALUES``
    values, it is narrowed by sketches of the values inside it first.
    """
    probs = [float(p) for p in probs]
    gcols = [f"__g{i}" for i in range(len(groups))]
    names = [f"__v{i}" for i in range(len(columns))]
    cells = [F.nanvl(c.cast("double"), F.lit(None)).alias(v) for v, c in zip(names, columns.values(), strict=True)]
    vals = df.select(*[qcol(g).alias(a) for g, a in zip(groups, gcols, strict=True)], *cells)
    b = _Brackets(vals, names, probs, gcols)
    width = 2.0 / ACCURACY
    while True:
        held = b.start(width) * 2 * width
        turns = 0
        while held > BRACKET_VALUES and turns < 6:
            b.narrow()
            held, turns = held * 4.0 / ACCURACY_STEPS, turns + 1
        found, good = b.exact()
        if good or width >= 1:
            break
        width *= 16
    if not gcols:
        rows = [(c, p, q) for v, c in zip(names, columns, strict=True) for p, q in zip(probs, found[f"{v}_q"] or [], strict=False) if q is not None]
        return df.sparkSession.createDataFrame(rows, f"{name} string, prob double, quantile double")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.lit(probs[k]).alias("prob"), F.col(f"{v}_q")[k].alias("quantile")) for v, c in zip(names, columns, strict=True) for k in range(len(probs))]))
    rows = found.select(*[F.col(a).alias(g) for g, a in zip(groups, gcols, strict=True)], each.alias("__s"))
    return rows.select(*[qcol(g) for g in groups], f"__s.{name}", "__s.prob", "__s.quantile").where("quantile is not null")


def quantile_columns(df: DataFrame, value: str, probs, names, groups=(), **kw) -> DataFrame:
    """Quantiles as one row per group with one column per probability."""
    q = exact_quantiles(df, value, probs, groups, **kw)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for p, n in zip(probs, names)]
    if groups:
        return q.groupBy(*[qcol(c) for c in groups]).agg(*aggs)
    return q.agg(*aggs)


__all__ = ["column_quantiles", "exact_quantiles", "global_rank", "quantile_columns"]
