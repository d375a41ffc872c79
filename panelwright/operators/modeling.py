"""Supervised modeling on Spark: splits, folds, preprocessing, ridge/lasso, trees, metrics, importance.

Data-sized work is always a Spark job: exact medians (distributed quantiles),
moments, Gram sums (one aggregation with p(p+1)/2 accumulators per fold and
role), tree ensembles (trees.py), predictions and permutation scoring.  The
driver only solves p x p systems and orchestrates fits.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.quantiles import column_quantiles, exact_quantiles, global_rank
from panelwright.operators.trees import Binned, search_trees

# Fixed values of the evaluation protocol: test share, seed, folds, grids.
TEST_SHARE = 0.2
SEED = 42
N_FOLDS = 5
RIDGE_ALPHAS = tuple(float(a) for a in np.logspace(-2, 3, 24))
LASSO_N_ALPHAS = 100
LASSO_EPS = 1e-3
FOREST_GRID = {
    "n_trees": [200, 400, 600],
    "max_depth": [4, 6, 8, 12, None],
    "min_leaf": [1, 3, 6, 12],
    "feature_share": ["sqrt", 0.3, 0.6],
}
FOREST_DRAWS = 24
BOOST_GRID = {
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "n_rounds": [100, 200, 400],
    "max_depth": [3, 5, 8, None],
    "min_leaf": [5, 10, 20],
    "l2": [0.0, 0.1, 1.0],
}
BOOST_DRAWS = 30
PERM_REPEATS = 25
# Rows of the two importance reports (chart and table).
TOP_IMPORTANCES, TOP_IMPORTANCES_TABLE = 10, 12


# ------------------------------------------------------------- split / folds

def _threshold(share: float) -> str:
    return format(int(share * (16 ** 32)), "032x")


def key_hash(id_col, salt: str) -> Column:
    """md5 of ``id|salt`` as 32 hex digits (the same in DuckDB)."""
    return F.md5(F.concat(qcol(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string"),
                          F.lit(f"|{salt}")))


def split_label(id_col, test_share: float = TEST_SHARE, seed: int = SEED) -> Column:
    """'test' for about ``test_share`` of keys, else 'train' (M1); stable per key."""
    return F.when(key_hash(id_col, str(seed)) < F.lit(_threshold(test_share)), F.lit("test")).otherwise(F.lit("train"))


def fold_id(id_col, k: int = N_FOLDS, seed: int = SEED) -> Column:
    """Fold 0..k-1 from md5 thresholds (M2)."""
    h = key_hash(id_col, f"fold{seed}")
    expr = None
    for i in range(k - 1):
        cond = h < F.lit(_threshold((i + 1) / k))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(k - 1)) if expr is not None else F.lit(0)


# ---------------------------------------------------------- preprocessing

def fit_imputer_scaler(train: DataFrame, cols, scale: bool = True) -> DataFrame:
    """Per column: exact median, then mean and population sd of the imputed values (M3, M4), one row each.

    A zero sd becomes 1 (the column is only centred).  Without ``scale`` the
    mean is 0 and the sd 1.
    """
    cols = list(cols)
    med = {r["column"]: r["quantile"] for r in column_quantiles(train, {c: qcol(c) for c in cols}, [0.5]).collect()}
    schema = "column string, median double, mean double, sd double"
    if not scale:
        return train.sparkSession.createDataFrame([(c, med.get(c), 0.0, 1.0) for c in cols], schema)
    filled = [F.coalesce(F.nanvl(qcol(c).cast("double"), F.lit(None)), F.lit(med.get(c)).cast("double")) for c in cols]
    row = train.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).first()
    return train.sparkSession.createDataFrame([(c, med.get(c), row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols)], schema)


def fit_imputer_scaler_long(long: DataFrame, group=(), scale: bool = True) -> DataFrame:
    """:func:`fit_imputer_scaler` on a long ``(*group, column, value)`` frame (e.g. an exploded vector), per group."""
    med = exact_quantiles(long, "value", [0.5], groups=[*group, "column"]).select(
        *[qcol(g) for g in group], "column", F.col("quantile").alias("median")
    )
    if not scale:
        return med.withColumn("mean", F.lit(0.0)).withColumn("sd", F.lit(1.0))
    imputed = long.join(med, [*group, "column"], "left").withColumn("x", F.coalesce("value", "median"))
    mom = imputed.groupBy(*[qcol(g) for g in group], "column").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd")
    )
    out = med.join(mom, [*group, "column"], "left")
    return out.withColumn("sd", F.when((F.col("sd") == 0) | F.col("sd").isNull(), F.lit(1.0)).otherwise(F.col("sd")))


def params_table(params: DataFrame, group=()) -> dict:
    """Collect the fitted parameters (one row per group and column: p x folds rows)."""
    out = {}
    for r in params.collect():
        key = tuple(r[g] for g in group)
        out.setdefault(key, {})[r["column"]] = (r["median"], r["mean"], r["sd"])
    return out


def transform_expr(col: str, median: float | None, mean: float, sd: float) -> Column:
    x = qcol(col).cast("double")
    if median is not None:
        x = F.coalesce(x, F.lit(float(median)))
    return (x - F.lit(float(mean))) / F.lit(float(sd))


def apply_imputer_scaler(df: DataFrame, params: dict, cols, keep=()) -> DataFrame:
    """Impute with the fitted medians and standardise with the fitted moments (M5)."""
    return df.select(*[qcol(k) for k in keep], *[transform_expr(c, *params[c]).alias(c) for c in cols])


# -------------------------------------------------------------- Gram sums

@dataclass
class GramStats:
    n: float
    sx: np.ndarray
    sy: float
    xtx: np.ndarray
    xty: np.ndarray
    yy: float

    def centred(self):
        mx, my = self.sx / self.n, self.sy / self.n
        sxx = self.xtx - self.n * np.outer(mx, mx)
        sxy = self.xty - self.n * mx * my
        return mx, my, sxx, sxy

    def sse(self, b0: float, beta: np.ndarray) -> float:
        """Sum of squared errors of ``b0 + x.beta`` on these rows, from the sums alone."""
        return float(self.yy - 2 * (b0 * self.sy + beta @ self.xty) + self.n * b0 * b0
                     + 2 * b0 * (beta @ self.sx) + beta @ self.xtx @ beta)

    def sst(self) -> float:
        return float(self.yy - self.sy * self.sy / self.n)


def gram_sums(df: DataFrame, xcols, ycol: str, group=()) -> dict:
    """Per group: n, sum x, sum y, X'X, X'y, y'y from one aggregation (p(p+1)/2 products)."""
    p = len(xcols)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(qcol(ycol)).alias("sy"),
            F.sum(qcol(ycol) * qcol(ycol)).alias("yy")]
    aggs += [F.sum(qcol(c)).alias(f"sx{i}") for i, c in enumerate(xcols)]
    aggs += [F.sum(qcol(c) * qcol(ycol)).alias(f"xy{i}") for i, c in enumerate(xcols)]
    aggs += [F.sum(qcol(a) * qcol(b)).alias(f"xx{i}_{j}")
             for i, a in enumerate(xcols) for j, b in enumerate(xcols) if j >= i]
    rows = df.groupBy(*[qcol(g) for g in group]).agg(*aggs).collect() if group else [df.agg(*aggs).first()]
    out = {}
    for r in rows:
        xtx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                xtx[i, j] = xtx[j, i] = r[f"xx{i}_{j}"]
        key = tuple(r[g] for g in group)
        out[key] = GramStats(float(r["n"]), np.array([r[f"sx{i}"] for i in range(p)], dtype=float), float(r["sy"]),
                             xtx, np.array([r[f"xy{i}"] for i in range(p)], dtype=float), float(r["yy"]))
    return out


def ridge_solve(stats: GramStats, alpha: float):
    """Ridge with intercept on centred sums: (Sxx + alpha I) beta = Sxy."""
    mx, my, sxx, sxy = stats.centred()
    beta = np.linalg.solve(sxx + alpha * np.eye(len(mx)), sxy)
    return my - mx @ beta, beta


def lasso_solve(stats: GramStats, alpha: float, max_iter: int = 50_000, tol: float = 1e-4, beta0=None):
    """Coordinate descent for (1/2n)|y - b0 - X beta|^2 + alpha |beta|_1 on centred sums."""
    mx, my, sxx, sxy = stats.centred()
    n, p = stats.n, len(mx)
    beta = np.zeros(p) if beta0 is None else beta0.copy()
    diag = np.diag(sxx) / n
    for _ in range(max_iter):
        change = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = (sxy[j] - sxx[j] @ beta + sxx[j, j] * beta[j]) / n
            new = math.copysign(max(abs(rho) - alpha, 0.0), rho) / diag[j]
            change = max(change, abs(new - beta[j]))
            beta[j] = new
        if change <= tol * 1e-6 * max(1.0, float(np.max(np.abs(beta)))):
            break
    return my - mx @ beta, beta


def selected_features(cols, beta: np.ndarray) -> list[tuple[str, float]]:
    """Features with a coefficient other than zero, the largest in magnitude first (M8)."""
    kept = [(c, float(b)) for c, b in zip(cols, beta, strict=True) if b != 0.0]
    return sorted(kept, key=lambda cb: (-abs(cb[1]), cb[0]))


def lasso_gradient(stats: GramStats, beta: np.ndarray) -> np.ndarray:
    """Per feature, its mean product with the residual.

    At the optimum for alpha this is ``alpha * sign(beta)`` where beta is not
    zero, and at most alpha in magnitude where it is.
    """
    _, _, sxx, sxy = stats.centred()
    return (sxy - sxx @ beta) / stats.n


def lasso_alphas(stats: GramStats, n_alphas: int = LASSO_N_ALPHAS, eps: float = LASSO_EPS) -> list[float]:
    _, _, _, sxy = stats.centred()
    amax = float(np.max(np.abs(sxy))) / stats.n
    if amax <= 0:
        return [0.0]
    return [float(a) for a in np.logspace(math.log10(amax * eps), math.log10(amax), n_alphas)[::-1]]


# ------------------------------------------------------- CV with fold stats

def masked_gram(df: DataFrame, cols, group: str | None = None, shift: dict | None = None, squares: bool = False) -> dict:
    """Per value of ``group``: Z'Z of Z = [1, x, m], with m = 1 where a value is null or NaN and x = value - shift, 0 there.

    ``squares`` adds the columns x * x to Z.

    Each task folds its Arrow batches into one partial matrix a group with
    NumPy; cells are summed in one small aggregation, so the driver receives
    (2p + 1 or 3p + 1) squared numbers a group whatever the row count.  ``group`` must have few
    values, null excluded.
    """
    cols = list(cols)
    p = len(cols)
    base = np.array([(shift or {}).get(c) or 0.0 for c in cols])
    key = qcol(group).cast("int") if group else F.lit(0)

    def partials(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            which = batch.column(0).to_numpy()
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float) for i in range(p)])
            gone = np.isnan(x)
            x = np.where(gone, 0.0, x - base)
            z = np.hstack([np.ones((len(x), 1)), x, gone, *([x * x] if squares else [])])
            for k in np.unique(which).tolist():
                part = z[which == k]
                held[k] = held.get(k, 0.0) + part.T @ part
        for k, g in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(g.size, k, np.int32)), pa.array(np.arange(g.size, dtype=np.int32)), pa.array(g.ravel())], ["k", "idx", "value"])

    sums = df.select(key.alias("__k"), *[qcol(c).cast("double") for c in cols]).mapInArrow(partials, "k int, idx int, value double")
    out: dict = {}
    size = (3 if squares else 2) * p + 1
    for r in sums.groupBy("k", "idx").agg(F.sum("value").alias("value")).toLocalIterator():
        out.setdefault(r["k"], np.zeros(size**2))[r["idx"]] = r["value"]
    return {k: v.reshape(size, size) for k, v in out.items()}


def imputed_stats(gram: np.ndarray, fill: np.ndarray) -> np.ndarray:
    """[1, x, y]'[1, x, y] with the nulls of x filled, from :func:`masked_gram` (y the last column, never null)."""
    p = (len(gram) - 1) // 2
    keep = np.zeros((len(gram), p + 1))
    keep[np.arange(p + 1), np.arange(p + 1)] = 1.0
    keep[p + 1 + np.arange(p - 1), 1 + np.arange(p - 1)] = fill
    return keep.T @ gram @ keep


def scaled_stats(sums: np.ndarray, mean: np.ndarray, sd: np.ndarray, y_shift: float) -> GramStats:
    """Sums of the standardised columns and the outcome, from sums of the plain ones."""
    p = len(mean)
    turn = np.zeros((p + 2, p + 2))
    turn[0, 0] = turn[-1, -1] = 1.0
    turn[0, 1:-1], turn[0, -1] = -mean / sd, y_shift
    turn[np.arange(1, p + 1), np.arange(1, p + 1)] = 1.0 / sd
    g = turn.T @ sums @ turn
    return GramStats(float(g[0, 0]), g[0, 1:-1], float(g[0, -1]), g[1:-1, 1:-1], g[1:-1, -1], float(g[-1, -1]))


def fold_medians(base: DataFrame, fold: str, cols, k: int) -> dict:
    """(fold, column) -> exact median over the rows of all other folds; rows are neither copied nor moved."""
    masked = {f"{f}|{c}": F.when(qcol(fold) != f, qcol(c).cast("double")) for f in range(k) for c in cols}
    return {(int(r["column"].split("|", 1)[0]), r["column"].split("|", 1)[1]): r["quantile"] for r in column_quantiles(base, masked, [0.5]).collect()}


def cv_frame(df: DataFrame, id_col: str, xcols, ycol: str, k: int = N_FOLDS, seed: int = SEED):
    """Per-fold preprocessing fitted on the fold's training rows, and Gram sums per (fit fold, role).

    One pass sums each fold's rows; the training sums of a fold are the whole
    sums less its own, and medians, means and scales are applied to the sums.
    """
    xcols = list(xcols)
    base = df.select(*[qcol(c) for c in xcols], qcol(ycol).cast("double").alias("__y"), fold_id(id_col, k, seed).alias("__fold")).where("__y is not null and not isnan(__y)")
    cols = [*xcols, "__y"]
    low = base.agg(*[F.min(F.nanvl(qcol(c).cast("double"), F.lit(None))).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    shift = {c: low[f"c{i}"] or 0.0 for i, c in enumerate(cols)}
    grams = masked_gram(base, cols, "__fold", shift)
    if not grams:
        return {}, {}
    medians = fold_medians(base, "__fold", xcols, k)
    whole = sum(grams.values())
    params, stats = {}, {}
    for f in range(k):
        val = grams.get(f, np.zeros_like(whole))
        fill = np.array([(medians.get((f, c)) if medians.get((f, c)) is not None else shift[c]) - shift[c] for c in xcols])
        train = imputed_stats(whole - val, fill)
        if train[0, 0] < 0.5:
            continue
        mean = train[0, 1:-1] / train[0, 0]
        var = np.diag(train)[1:-1] / train[0, 0] - mean * mean
        sd = np.sqrt(np.where(var > 1e-14 * np.maximum(mean * mean, 1e-300), var, 1.0))
        params[(f,)] = {c: (medians.get((f, c)), float(mean[i] + shift[c]), float(sd[i])) for i, c in enumerate(xcols)}
        stats[(f, "train")] = scaled_stats(train, mean, sd, shift["__y"])
        if val[0, 0] > 0.5:
            stats[(f, "val")] = scaled_stats(imputed_stats(val, fill), mean, sd, shift["__y"])
    return params, stats


def ridge_cv(stats: dict, alphas=RIDGE_ALPHAS, k: int = N_FOLDS) -> list[dict]:
    """Mean over folds of the validation RMSE for each alpha (M6)."""
    out = []
    for a in alphas:
        rmses = []
        for f in range(k):
            tr, va = stats.get((f, "train")), stats.get((f, "val"))
            if tr is None or va is None:
                continue
            b0, beta = ridge_solve(tr, a)
            rmses.append(math.sqrt(max(va.sse(b0, beta), 0.0) / va.n))
        out.append({"alpha": a, "cv_rmse": float(np.mean(rmses))})
    return out


def lasso_cv(stats: dict, all_train: GramStats, k: int = N_FOLDS) -> list[dict]:
    """Alpha path from the full training data; mean validation MSE per alpha (M7)."""
    alphas = lasso_alphas(all_train)
    mse = np.zeros((len(alphas), k))
    for f in range(k):
        tr, va = stats[(f, "train")], stats[(f, "val")]
        beta = None
        for i, a in enumerate(alphas):
            b0, beta = lasso_solve(tr, a, beta0=beta)
            mse[i, f] = max(va.sse(b0, beta), 0.0) / va.n
    return [{"alpha": a, "cv_mse": float(mse[i].mean())} for i, a in enumerate(alphas)]


# ------------------------------------------------------------------ metrics

def regression_metrics(df: DataFrame, y: str, yhat: str, group=()) -> DataFrame:
    """RMSE, MAE and R^2 as SQL aggregates."""
    e = qcol(y) - qcol(yhat)
    mean_y = F.avg(qcol(y))
    return df.groupBy(*[qcol(g) for g in group]).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / (F.var_pop(qcol(y)) * F.count(qcol(y)))).alias("r2"),
    )


def linear_prediction(cols, b0: float, beta) -> Column:
    expr = F.lit(float(b0))
    for c, b in zip(cols, beta):
        expr = expr + F.lit(float(b)) * qcol(c)
    return expr


# ----------------------------------------------------------- random search

def sample_grid(grid: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """``n_iter`` distinct parameter maps, ordered by md5 of (seed, params)."""
    keys = sorted(grid)
    combos = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]
    combos.sort(key=lambda d: hashlib.md5(f"{seed}|{json.dumps(d, sort_keys=True)}".encode()).hexdigest())
    return combos[:n_iter]


def tree_search(train: DataFrame, id_col: str, xcols, ycol: str, kind: str, grid: dict, n_iter: int,
                k: int = N_FOLDS, seed: int = SEED, binned: Binned | None = None) -> list[dict]:
    """Random search with k-fold CV for a ``forest`` or ``boost`` (M9, M10, M11): every draw with its score on each fold.

    Folds impute with medians of their own training rows (no scaling, as for
    trees); all draws and folds share one binned table and one plan.  ``binned``:
    that table, where several searches share it.
    """
    return search_trees(train, id_col, xcols, ycol, kind, sample_grid(grid, n_iter, seed), fold_id(id_col, k, seed), k, seed, binned)


# ------------------------------------------------------ permutation scoring

def permutation_importance(test: DataFrame, id_col: str, xcols, ycol: str, predict, repeats: int = PERM_REPEATS,
                           seed: int = SEED) -> DataFrame:
    """Mean and population sd over repeats of the R^2 drop when one feature is permuted (M14), largest first (K6).

    ``predict(df)`` must return ``df`` plus a ``prediction`` column.  Every
    repeat draws one permutation of the whole test set: the row of rank i by
    id takes its donor from rank i by a seeded hash.  All features of a repeat
    share the donors, so the rows are copied once per repeat and a single
    column is swapped when scoring.
    """
    base = test.select(qcol(id_col).alias("__key"), *[qcol(c).cast("double").alias(c) for c in xcols], qcol(ycol))
    rows = global_rank(base, ["__key"], label="permutation-rows").drop("__n")
    donors = base.select("__key", *[F.col(f"`{c}`").alias(f"__d{i}") for i, c in enumerate(xcols)],
                         F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__rep"))
    donors = donors.withColumn("__h", F.xxhash64(F.lit(seed), "__rep", "__key"))
    donors = global_rank(donors, ["__h", "__key"], ["__rep"], label="permutation-donors").drop("__n", "__h", "__key")
    joined = rows.join(donors, "__r").withColumn("__feat", F.explode(F.array(*[F.lit(i) for i in range(len(xcols))])))
    permuted = joined.select(
        "__feat", "__rep", qcol(ycol),
        *[F.when(F.col("__feat") == i, F.col(f"__d{i}")).otherwise(qcol(c)).alias(c) for i, c in enumerate(xcols)],
    )
    r2 = regression_metrics(predict(permuted), ycol, "prediction", group=["__feat", "__rep"])
    base_r2 = regression_metrics(predict(base), ycol, "prediction").select("r2").scalar()
    drops = r2.select("__feat", (base_r2 - F.col("r2")).alias("drop"))
    names = F.array(*[F.lit(c) for c in xcols])
    return drops.groupBy("__feat").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")
    ).select(names[F.col("__feat")].alias("feature"), "importance_mean", "importance_std").orderBy(F.col("importance_mean").desc(), "feature")


__all__ = [
    "GramStats", "apply_imputer_scaler", "cv_frame", "fit_imputer_scaler", "fit_imputer_scaler_long",
    "fold_id", "fold_medians", "gram_sums", "masked_gram",
    "key_hash", "lasso_alphas", "lasso_cv", "lasso_solve", "linear_prediction", "params_table",
    "permutation_importance", "regression_metrics", "ridge_cv", "ridge_solve", "sample_grid", "split_label",
    "transform_expr", "tree_search",
]
