"""Supervised evaluation: four regressors fitted on the training split, compared on both splits."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.assemble import union_by_name
from panelwright.operators.modeling import (
    N_FOLDS,
    SEED,
    apply_imputer_scaler,
    cv_frame,
    fit_imputer_scaler,
    fold_id,
    gram_sums,
    lasso_cv,
    lasso_solve,
    linear_prediction,
    params_table,
    regression_metrics,
    ridge_cv,
    ridge_solve,
    selected_features,
    transform_expr,
    tree_search,
)
from panelwright.operators.trees import bin_rows, fit_trees

#: Model names by tree kind, in the order of the report.
TREES = {"forest": "random_forest", "boost": "gradient_boosting"}


@dataclass
class FittedModel:
    """A model refitted on all training rows with its best parameters."""

    name: str
    params: dict
    cv_score: float
    predict: Callable[[DataFrame], DataFrame]  # adds the column ``prediction``


@dataclass
class Evaluation:
    """The fitted models, what the linear fits are made of, and every draw of the searches by tree kind."""

    models: dict[str, FittedModel]
    l1_features: list[tuple[str, float]]
    searches: dict[str, list[dict]]


def evaluate_supervised(train: DataFrame, id_col: str, features, outcome: str, grids: dict, draws: dict) -> Evaluation:
    """Fit ridge, lasso, forest and boosting, each tuned by cross-validation on ``train``.

    ``grids`` and ``draws`` give, by tree kind, the parameter grid and how many
    of its combinations are tried.  Preprocessing is fitted on training rows
    alone.  Only parameters and scores reach the driver.
    """
    features = list(features)

    def sums():
        params = params_table(fit_imputer_scaler(train, features))[()]
        scaled = apply_imputer_scaler(train, params, features, keep=[id_col, outcome])
        return params, gram_sums(scaled, features, outcome)[()], cv_frame(train, id_col, features, outcome)[1]

    def trees(kind, binned):
        search = tree_search(train, id_col, features, outcome, kind, grids[kind], draws[kind], binned=binned)
        best = min(search, key=lambda r: r["cv_rmse"])
        return search, best, fit_trees(train, id_col, features, outcome, kind, best["params"], SEED, binned)

    # The three do not wait for each other; tables that stay distributed are searched one after the other.
    with ThreadPoolExecutor(1 + len(TREES)) as pool:
        run = lambda f, *a: pool.submit(inheritable_thread_target(train.sparkSession)(f), *a)
        linear_sums = run(sums)
        binned = bin_rows(train, id_col, features, outcome, fold_id(id_col), N_FOLDS)
        if binned.small:
            binned.sent  # noqa: B018 - once, before both searches ask for it
        found = {}
        for kind in TREES:
            found[kind] = run(trees, kind, binned)
            if not binned.small:
                found[kind].result()
        params, whole, stats = linear_sums.result()
        found = {kind: x.result() for kind, x in found.items()}

    def linear(solution):
        b0, beta = solution

        def predict(df: DataFrame) -> DataFrame:
            z = df.select("*", *[transform_expr(c, *params[c]).alias(f"__z_{c}") for c in features])
            return z.withColumn("prediction", linear_prediction([f"__z_{c}" for c in features], b0, beta)).drop(*[f"__z_{c}" for c in features])

        return predict

    ridge = min(ridge_cv(stats), key=lambda r: r["cv_rmse"])
    lasso = min(lasso_cv(stats, whole), key=lambda r: r["cv_mse"])
    lasso_fit = lasso_solve(whole, lasso["alpha"])
    models = {
        "ridge": FittedModel("ridge", {"alpha": ridge["alpha"]}, ridge["cv_rmse"], linear(ridge_solve(whole, ridge["alpha"]))),
        "lasso_cv": FittedModel("lasso_cv", {"alpha": lasso["alpha"]}, float(np.sqrt(lasso["cv_mse"])), linear(lasso_fit)),
    }

    for kind, name in TREES.items():
        _, best, fitted = found[kind]
        models[name] = FittedModel(name, best["params"], best["cv_rmse"], lambda df, m=fitted: m.predict(df, features))
    searches = {kind: x[0] for kind, x in found.items()}
    return Evaluation(models, selected_features(features, lasso_fit[1]), searches)


def model_report(evaluation: Evaluation, splits: dict[str, DataFrame], outcome: str) -> DataFrame:
    """One row per (model, split): RMSE, MAE, R2, the cross-validated score and the parameters."""
    parts = []
    for model in evaluation.models.values():
        for split, df in splits.items():
            scored = regression_metrics(model.predict(df).select(qcol(outcome), "prediction"), outcome, "prediction")
            parts.append(scored.select(
                F.lit(model.name).alias("model"), F.lit(split).alias("split"), "rmse", "mae", "r2",
                F.lit(float(model.cv_score)).alias("cv_score"), F.lit(json.dumps(model.params, sort_keys=True)).alias("params")))
    return union_by_name(parts)


__all__ = ["TREES", "Evaluation", "FittedModel", "evaluate_supervised", "model_report"]
