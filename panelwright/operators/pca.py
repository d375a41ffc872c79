"""PCA on standardised features: covariance from one distributed Gram pass, eigh on the driver (p x p).

Wide row algebra (p x p cross products, scores) runs as NumPy on Arrow
batches inside tasks: thousands of generated SQL terms would exceed the JVM's
64 KB method limit and fall back to interpreted evaluation.  Only the p x p
covariance and the p x k loading matrix (model parameters) live on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.functions import strip_prefixes
from panelwright.functions._util import qcol
from panelwright.operators.cohort import coerce_numeric, select_features
from panelwright.operators.modeling import apply_imputer_scaler, fit_imputer_scaler, params_table, split_label
from panelwright.session import materialize

# The share of training variance the kept components must reach,
# the size of the loading report, and the minimum feature count.
PCA_VARIANCE = 0.90
TOP_LOADINGS = 12
MIN_FEATURES = 3


def cross_moments(df: DataFrame, cols) -> tuple[float, np.ndarray, np.ndarray]:
    """n, column sums and X'X of ``cols`` (rows with a null are skipped).

    Each task folds its Arrow batches into one partial (n, sums, X'X) with
    NumPy; the partials are summed by cell index in one small aggregation, so
    the driver receives p*p + p + 1 numbers whatever the row count.
    """
    p = len(cols)

    def partials(batches):
        n, s, xtx = 0.0, np.zeros(p), np.zeros((p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            x = x[~np.isnan(x).any(axis=1)]
            n += x.shape[0]
            s += x.sum(axis=0)
            xtx += x.T @ x
        vals = np.concatenate([[n], s, xtx.ravel()])
        yield pd.DataFrame({"idx": np.arange(vals.size, dtype=np.int32), "value": vals})

    sums = (
        df.select(*[qcol(c).cast("double") for c in cols])
        .mapInPandas(partials, "idx int, value double")
        .groupBy("idx").agg(F.sum("value").alias("value"))
        .collect()
    )
    vals = np.zeros(1 + p + p * p)
    for r in sums:
        vals[r["idx"]] = r["value"]
    return float(vals[0]), vals[1:1 + p], vals[1 + p:].reshape(p, p)


def covariance_matrix(df: DataFrame, cols) -> tuple[np.ndarray, np.ndarray, float]:
    """Population covariance and means of ``cols``."""
    n, s, xtx = cross_moments(df, cols)
    mean = s / n
    return xtx / n - np.outer(mean, mean), mean, n


def covariance_frame(spark: SparkSession, cols, cov: np.ndarray) -> DataFrame:
    """Long ``(col_a, col_b, cov)`` from the p x p matrix."""
    rows = [(a, b, float(cov[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return spark.createDataFrame(rows, "col_a string, col_b string, cov double")


class PCAModel:
    """Components kept to reach the variance share; signs fixed so each
    component's largest-magnitude loading is positive."""

    def __init__(self, cols, mean, components, evr):
        self.cols = list(cols)
        self.mean = mean
        self.components = components      # p x k
        self.explained_variance_ratio = evr  # all p ratios, descending

    @property
    def k(self) -> int:
        return self.components.shape[1]

    def scores(self, df: DataFrame, keep=()) -> DataFrame:
        """``PC1..PCk`` = (x - train mean) . components (M16), one NumPy matmul per Arrow batch."""
        cols, keep = list(self.cols), list(keep)
        mean, comp, k = self.mean, self.components, self.k
        fields = [f for f in df.select(*[qcol(c) for c in keep]).schema.fields]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"PC{j + 1} double" for j in range(k)])

        def project(batches):
            for pdf in batches:
                z = (pdf[cols].to_numpy(dtype=float) - mean) @ comp
                out = pdf[keep].copy()
                for j in range(k):
                    out[f"PC{j + 1}"] = z[:, j]
                yield out

        return df.select(*[qcol(c) for c in keep], *[qcol(c).cast("double") for c in cols]).mapInPandas(project, schema)

    def loadings(self, spark: SparkSession) -> DataFrame:
        """Long ``(feature, pc, loading)``."""
        rows = [(c, f"PC{j + 1}", float(self.components[i, j])) for i, c in enumerate(self.cols) for j in range(self.k)]
        return spark.createDataFrame(rows, "feature string, pc string, loading double")

    def scree(self, spark: SparkSession, target: float = PCA_VARIANCE) -> DataFrame:
        """``(pc, ratio, cumulative, kept)`` for every component."""
        cum = np.cumsum(self.explained_variance_ratio)
        rows = [(i + 1, float(r), float(cum[i]), i < self.k) for i, r in enumerate(self.explained_variance_ratio)]
        return spark.createDataFrame(rows, "pc int, ratio double, cumulative double, kept boolean").withColumn(
            "target", F.lit(float(target)))


def fit_pca(train_z: DataFrame, cols, variance: float = PCA_VARIANCE) -> PCAModel:
    """Smallest k whose cumulative explained variance reaches ``variance``."""
    if len(cols) < MIN_FEATURES:
        raise ValueError(f"components need {MIN_FEATURES} columns or more, got {list(cols)}")
    cov, mean, _ = covariance_matrix(train_z, cols)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0.0, None), vecs[:, order]
    evr = vals / vals.sum()
    k = int(np.searchsorted(np.cumsum(evr), variance - 1e-12) + 1)
    comp = vecs[:, :k].copy()
    for j in range(k):
        if comp[np.argmax(np.abs(comp[:, j])), j] < 0:
            comp[:, j] = -comp[:, j]
    return PCAModel(cols, mean, comp, evr)


def standardise(train: DataFrame, test: DataFrame, cols, keep=()):
    """Impute + scale fitted on train only, applied to both (M3-M5)."""
    params = params_table(fit_imputer_scaler(train, cols))[()]
    return (apply_imputer_scaler(train, params, cols, keep), apply_imputer_scaler(test, params, cols, keep), params)


def pc_outcome_corr(scored: DataFrame, split: str, outcome: str, k: int) -> DataFrame:
    """``(split, pc, r_success)``: Pearson r of each component with the outcome per split."""
    wide = scored.groupBy(qcol(split)).agg(*[F.corr(f"PC{j + 1}", qcol(outcome)).alias(f"PC{j + 1}") for j in range(k)])
    return wide.unpivot([split], [f"PC{j + 1}" for j in range(k)], "pc", "r_success")


@dataclass
class PCARun:
    """What one analysis gives."""

    cols: list
    model: PCAModel
    scores: DataFrame
    correlations: DataFrame
    summary: DataFrame


def pca_analysis(frame: DataFrame, id_col: str, outcome: str, prefixes=(), extra=(), exclude=()) -> PCARun:
    """Columns chosen by the data (P20), imputed and scaled on the training split, PCA, scores and correlations (C11).

    The chosen columns are written once; every pass reads that table.
    """
    spark = frame.sparkSession
    frame = materialize(frame, "pca-frame")
    cols = select_features(frame, prefixes, extra, (*exclude, id_col, outcome))
    if len(cols) < MIN_FEATURES:
        raise ValueError(f"only {len(cols)} usable columns for components: {cols}")
    numeric = coerce_numeric(frame.select(qcol(id_col), qcol(outcome), *map(qcol, cols)), cols)
    numeric = materialize(numeric.withColumn("split", split_label(id_col)), "pca-numeric")
    train, test, _ = standardise(numeric.filter("split = 'train'"), numeric.filter("split = 'test'"), cols, [id_col, outcome, "split"])
    model = fit_pca(train, cols)
    scores = model.scores(train.unionByName(test), keep=[id_col, outcome, "split"])
    cum = float(np.sum(model.explained_variance_ratio[: model.k]))
    counts = numeric.agg(F.count(F.lit(1)).alias("n_entities"), F.count_if(F.col("split") == "train").alias("n_train"))
    summary = counts.select(
        "n_entities", "n_train", F.lit(len(cols)).alias("n_features"), F.lit(",".join(cols)).alias("feature_columns"),
        F.lit(model.k).alias("n_components"), F.lit(cum).alias("cumulative_variance"), F.lit(PCA_VARIANCE).alias("target_variance"))
    return PCARun(cols, model, scores, pc_outcome_corr(scores, "split", outcome, model.k), summary)


def pca_checks(run: PCARun, tol: float = 1e-8) -> dict[str, bool]:
    """Whether the fit has what a PCA must have: ratios that sum to 1 and fall, the smallest k, orthonormal
    loadings, and uncorrelated training scores whose variances are in proportion to the ratios."""
    ratios, k, comp = run.model.explained_variance_ratio, run.model.k, run.model.components
    names = [f"PC{j + 1}" for j in range(k)]
    cov, _, _ = covariance_matrix(run.scores.filter("split = 'train'"), names)
    expected = np.diag(ratios[:k] / ratios[0] * cov[0, 0])
    cum = np.cumsum(ratios)
    return {
        "ratios_sum_to_one": bool(abs(cum[-1] - 1) < tol),
        "ratios_fall": bool(np.all(np.diff(ratios) <= tol)),
        "smallest_k": bool(cum[k - 1] >= PCA_VARIANCE - tol and (k == 1 or cum[k - 2] < PCA_VARIANCE)),
        "loadings_orthonormal": bool(np.allclose(comp.T @ comp, np.eye(k), atol=tol)),
        "scores_uncorrelated": bool(np.allclose(cov, expected, atol=tol * 100 * cov[0, 0])),
    }


def best_variant_per_base(loadings: DataFrame, pc: str, prefixes, top_k: int = TOP_LOADINGS) -> DataFrame:
    """Per base statistic (prefix stripped) the variant with the largest |loading|, then the top ``top_k``."""
    one = loadings.filter(F.col("pc") == pc).withColumn("base", strip_prefixes(F.col("feature"), prefixes))
    w = Window.partitionBy("base").orderBy(F.abs("loading").desc(), F.col("feature"))
    best = one.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return best.orderBy(F.abs("loading").desc(), F.col("base")).limit(top_k).select("base", "feature", "loading")


__all__ = [
    "PCAModel", "PCARun", "PCA_VARIANCE", "best_variant_per_base", "covariance_frame", "covariance_matrix",
    "cross_moments", "fit_pca", "pc_outcome_corr", "pca_analysis", "pca_checks", "standardise",
]
