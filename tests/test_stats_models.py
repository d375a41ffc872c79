"""Quantiles, preprocessing, linear models, permutation importance and PCA against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators.eda import box_stats, describe, histogram, null_rates
from panelwright.operators.modeling import (
    apply_imputer_scaler,
    fit_imputer_scaler,
    fold_id,
    gram_sums,
    lasso_solve,
    linear_prediction,
    params_table,
    permutation_importance,
    regression_metrics,
    ridge_solve,
    split_label,
)
from panelwright.operators.pca import covariance_matrix, fit_pca
from panelwright.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(0)
    data = [("hot", float(v)) for v in rng.normal(size=3000)] + [("cold", float(v)) for v in rng.normal(size=7)]
    data += [("hot", 0.5)] * 1000  # a hot value inside the hot group
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"], num_partitions=6).collect()}
    for g in ("hot", "cold"):
        arr = np.array([v for k, v in data if k == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(arr, p), abs=1e-12)


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).first()["quantile"] == 3.0


def test_describe_null_rates_box_and_histogram(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=200)
    df = spark.createDataFrame([(float(v), "a" if i % 2 else "b", None if i % 4 == 0 else 1.0) for i, v in enumerate(vals)],
                               "x double, g string, s double")
    d = describe(df, ["x"]).first()
    assert d["count"] == 200 and d["std"] == pytest.approx(np.std(vals, ddof=1))
    assert d["p25"] == pytest.approx(np.quantile(vals, 0.25)) and d["max"] == pytest.approx(vals.max())
    nr = {r["column"]: r["pct_missing"] for r in null_rates(df).collect()}
    assert nr == {"x": 0.0, "g": 0.0, "s": 25.0}
    b = {r["g"]: r for r in box_stats(df, "x", "g").collect()}
    a = vals[1::2]
    q1, q3 = np.quantile(a, [0.25, 0.75])
    inside = a[(a >= q1 - 1.5 * (q3 - q1)) & (a <= q3 + 1.5 * (q3 - q1))]
    assert b["a"]["whisker_lo"] == pytest.approx(inside.min()) and b["a"]["n_outliers"] == len(a) - len(inside)
    h = histogram(df, "x", 10).orderBy("bin").collect()
    counts, _ = np.histogram(vals, bins=10)
    assert [r["n"] for r in h] == list(counts)


def test_split_and_folds_partition_rows(spark):
    df = spark.range(5000).withColumn("s", split_label("id")).withColumn("f", fold_id("id"))
    test_share = df.filter("s = 'test'").count() / 5000
    assert 0.17 < test_share < 0.23
    sizes = [r["count"] for r in df.groupBy("f").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 5000 and min(sizes) > 850


def _linear_data(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2.0 + x @ np.array([1.5, -2.0, 0.0]) + rng.normal(scale=0.1, size=n)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double"), x, y


def test_ridge_and_lasso_closed_form(spark):
    df, x, y = _linear_data(spark)
    stats = gram_sums(df, ["a", "b", "c"], "y")[()]
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.0, 5.0):
        b0, beta = ridge_solve(stats, alpha)
        expect = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert beta == pytest.approx(expect, rel=1e-8)
        assert b0 == pytest.approx(y.mean() - x.mean(0) @ expect, rel=1e-8)
    b0, beta = lasso_solve(stats, 0.0)
    assert beta == pytest.approx(np.linalg.lstsq(xc, yc, rcond=None)[0], rel=1e-6)
    _, sparse = lasso_solve(stats, 0.5)
    assert sparse[2] == 0.0 and abs(sparse[0]) > 0.5
    m = regression_metrics(df.select("y", linear_prediction(["a", "b", "c"], b0, beta).alias("prediction")),
                           "y", "prediction").first()
    assert m["r2"] > 0.99 and m["rmse"] == pytest.approx(0.1, rel=0.2)


def test_imputer_scaler_fit_on_train(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, None), (10.0, 5.0), (None, 5.0)], "a double, b double")
    params = params_table(fit_imputer_scaler(df, ["a", "b"]))[()]
    assert params["a"][0] == 3.0  # even-count median
    assert params["b"][2] == 1.0  # zero sd -> 1
    out = apply_imputer_scaler(df, params, ["a", "b"]).collect()
    imputed = np.array([1.0, 2.0, 4.0, 10.0, 3.0])
    assert [r["a"] for r in out] == pytest.approx(list((imputed - imputed.mean()) / imputed.std()))


def test_permutation_importance_target_vs_noise(spark):
    df, x, y = _linear_data(spark, n=300)
    stats = gram_sums(df, ["a", "b", "c"], "y")[()]
    b0, beta = ridge_solve(stats, 0.0)

    def predict(frame):
        return frame.withColumn("prediction", linear_prediction(["a", "b", "c"], b0, beta))

    imp = {r["feature"]: r for r in permutation_importance(df, "id", ["a", "b", "c"], "y", predict, repeats=5).collect()}
    assert imp["b"]["importance_mean"] > 1.0 and imp["a"]["importance_mean"] > 0.5
    assert abs(imp["c"]["importance_mean"]) < 0.01


def test_permutation_importance_of_one_feature(spark):
    df, _, _ = _linear_data(spark, n=300)

    def predict(frame):
        return frame.withColumn("prediction", F.col("a"))

    small = permutation_importance(df, "id", ["a"], "y", predict, repeats=3).collect()
    assert len(small) == 1 and small[0]["importance_mean"] is not None


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 2))
    x = np.column_stack([base[:, 0], base[:, 0] * 2 + rng.normal(scale=0.1, size=300), base[:, 1], rng.normal(size=300)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    cov, mean, n = covariance_matrix(df, ["a", "b", "c", "d"])
    assert cov == pytest.approx(np.cov(x.T, ddof=0), abs=1e-10)
    model = fit_pca(df, ["a", "b", "c", "d"], variance=0.9)
    vals = np.sort(np.linalg.eigvalsh(np.cov(x.T, ddof=0)))[::-1]
    assert model.explained_variance_ratio == pytest.approx(vals / vals.sum())
    comp = model.components
    assert comp.T @ comp == pytest.approx(np.eye(model.k), abs=1e-10)
    assert all(comp[np.argmax(np.abs(comp[:, j])), j] > 0 for j in range(model.k))
    scores = np.array([[r[f"PC{j + 1}"] for j in range(model.k)] for r in model.scores(df).collect()])
    assert scores == pytest.approx((x - x.mean(0)) @ comp, abs=1e-9)
    with pytest.raises(ValueError):
        fit_pca(df, ["a", "b"])


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_exact_quantiles_do_not_hang_on_exchange_reuse(spark, reuse):
    from panelwright.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=700), np.full(500, 1.25)])
    rows_ = [(int(i % 3), float(v)) for i, v in enumerate(x)] + [(0, float("nan")), (1, None)]
    before = spark.conf.get("spark.sql.exchange.reuse")
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        df = spark.createDataFrame(rows_, "g int, v double").repartition(7)
        got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    for g in range(3):
        for p in (0.1, 0.5, 0.9):
            assert got[(g, p)] == pytest.approx(np.quantile([v for i, v in rows_[:1200] if i == g], p))
