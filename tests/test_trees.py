"""Histogram trees: both ways to the same trees, cuts against brute force, limits, nulls, searches."""

import numpy as np
import pytest
from pyspark import cloudpickle

from panelwright.operators import quantiles, trees
from panelwright.operators.modeling import BOOST_GRID, FOREST_GRID, cv_frame, fold_id, fold_medians, masked_gram, sample_grid, tree_search

FEATURES = ["a", "b", "c", "d"]
FOREST = [{"n_trees": 6, "max_depth": 4, "min_leaf": 2, "feature_share": 0.6}, {"n_trees": 3, "max_depth": None, "min_leaf": 5, "feature_share": "sqrt"}]
BOOST = [{"n_rounds": 13, "learning_rate": 0.2, "max_depth": 3, "min_leaf": 5, "l2": 0.1}, {"n_rounds": 4, "learning_rate": 0.1, "max_depth": None, "min_leaf": 5, "l2": 0.0}]


def table(spark, n=500):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 4))
    y = np.where(x[:, 2] > 0.3, 2.0, -1.0) + x[:, 0] ** 2 + rng.normal(scale=0.3, size=n)
    rows = [(i, *[None if rng.random() < 0.1 else float(v) for v in x[i]], float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double").repartition(3), y


@pytest.mark.parametrize("kind, fits", [("forest", FOREST), ("boost", BOOST)])
def test_both_ways_give_the_same_trees(spark, monkeypatch, kind, fits):
    df, y = table(spark)

    def run():
        found = trees.search_trees(df, "id", FEATURES, "y", kind, fits, fold_id("id"), 5, 42)
        model = trees.fit_trees(df, "id", FEATURES, "y", kind, fits[0], 42)
        return found, np.array([r[0] for r in model.predict(df, FEATURES).orderBy("id").select("prediction").collect()])

    here, fitted = run()
    monkeypatch.setattr(trees, "LOCAL_BYTES", 0)
    cloudpickle.register_pickle_by_value(trees)
    try:
        far, far_fitted = run()
    finally:
        cloudpickle.unregister_pickle_by_value(trees)
    assert [r["fold_rmse"] for r in far] == [pytest.approx(r["fold_rmse"], rel=1e-12) for r in here]
    assert far_fitted == pytest.approx(fitted, abs=1e-12)
    assert np.mean((fitted - y) ** 2) < 0.5 * y.var()
    assert all(len(r["fold_rmse"]) == 5 for r in here)


def test_best_cut_against_brute_force():
    rng = np.random.default_rng(2)
    for trial in range(20):
        bins = rng.integers(0, 9, size=(60, 3)).astype(np.uint8)
        target = rng.integers(-1000, 1000, size=60).astype(float)
        weight = rng.integers(0, 4, size=60).astype(float)
        least, l2 = 1 + trial % 7, [0.0, 2.5][trial % 2]
        g = trees.Growth(3, [7], [1], [least], [3], [l2], [1 << 40])
        node, _, _, slot, cut, gl, hl, gain = g.cuts(*g.sums(bins, g.walk(bins), target, weight))
        best = (0.0, None)
        score = lambda s, h: s * s / (h + l2) if h + l2 else 0.0
        for j in range(3):
            for b in range(9):
                left = bins[:, j] <= b
                hs, ss = [weight[m].sum() for m in (left, ~left)], [(weight * target)[m].sum() for m in (left, ~left)]
                if min(hs) >= least:
                    now = score(ss[0], hs[0]) + score(ss[1], hs[1]) - score(sum(ss), sum(hs))
                    if now > best[0] * (1 + 1e-12):
                        best = (now, (j, b, ss[0], hs[0]))
        assert (slot[0], cut[0], gl[0], hl[0]) == (best[1][0], cut[0], best[1][2], best[1][3]) and gain[0] == pytest.approx(best[0])
        assert ((bins[:, slot[0]] <= cut[0]) & (weight > 0)).sum() == ((bins[:, best[1][0]] <= best[1][1]) & (weight > 0)).sum()


def test_limits_of_trees():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 200, size=(900, 5)).astype(np.uint8)
    target = np.rint(1e6 * rng.normal(size=900))
    depths, least, leaves = [2, None, None, 3], [1, 40, 1, 1], [1 << 40, 1 << 40, 31, 5]
    g = trees.Growth(5, [1, 2, 3, 4], depths, least, [5, 2, 3, 1], [0.0] * 4, leaves)
    nodes = g.grow(bins, target, np.ones((4, 900)))
    sizes = [np.unique(nodes[t], return_counts=True)[1] for t in range(4)]
    assert len(sizes[0]) == 4 and sizes[1].min() >= 40 and len(sizes[1]) > 10 and len(sizes[2]) == 31 and len(sizes[3]) == 5
    values = g.values(1.0)
    for t in range(4):
        for leaf in np.unique(nodes[t]):
            assert values[leaf] == pytest.approx(target[nodes[t] == leaf].mean())


def test_trees_of_a_constant_outcome_and_of_nulls(spark):
    rows = [(i, None if i % 2 else float(i), None, 3.0, None if i % 5 == 0 else 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double, z double")
    for kind, fits in (("forest", FOREST), ("boost", BOOST)):
        assert all(max(r["fold_rmse"]) < 1e-6 for r in trees.search_trees(df, "id", ["a", "b"], "y", kind, fits, fold_id("id"), 5, 42))
        model = trees.fit_trees(df, "id", ["a", "b"], "z", kind, fits[0], 42)  # rows without an outcome don't count
        assert [r["prediction"] for r in model.predict(df, ["a", "b"]).collect()] == pytest.approx([1.0] * 60)


def test_the_searches_draw_from_the_whole_grids(spark):
    for grid, n in ((FOREST_GRID, 24), (BOOST_GRID, 30)):
        draws = sample_grid(grid, n)
        assert len({repr(sorted(d.items(), key=str)) for d in draws}) == n and all(d[k] in grid[k] for d in draws for k in grid)
        assert all({d[k] for d in draws} == set(grid[k]) for k in grid)
    df, _ = table(spark, 200)
    small = {"n_rounds": [3, 6], "learning_rate": [0.1, 0.3], "max_depth": [2], "min_leaf": [5], "l2": [0.0, 1.0]}
    found = tree_search(df, "id", FEATURES, "y", "boost", small, 4)
    assert [r["draw"] for r in found] == [0, 1, 2, 3] and all(r["cv_rmse"] == pytest.approx(np.mean(r["fold_rmse"])) for r in found)


@pytest.mark.parametrize("knobs", [{}, {"ACCURACY": 20}, {"ACCURACY": 100, "BRACKET_VALUES": 50, "ACCURACY_STEPS": 50}])
def test_quantiles_by_brackets(spark, monkeypatch, knobs):
    """Narrowing, widening and ties change no result."""
    for name, value in knobs.items():
        monkeypatch.setattr(quantiles, name, value)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), np.full(900, 1.25), rng.integers(0, 5, 900).astype(float)])
    rows = [(None if i % 7 == 0 else int(i % 3), float(v), float(-v * v)) for i, v in enumerate(x)] + [(0, float("nan"), None), (1, None, 2.0), (9, None, None)]
    df = spark.createDataFrame(rows, "g int, v double, w double").repartition(5)
    probs = [0.9, 0.1, 0.5, 0.0, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert len(got) == 20
    for g in (None, 0, 1, 2):
        values = [v for a, v, _ in rows if a == g and v is not None and v == v]
        assert [got[g, p] for p in probs] == pytest.approx(np.quantile(values, probs).tolist())
    both = {(r["column"], r["prob"]): r["quantile"] for r in quantiles.column_quantiles(df, {"v": df.v, "w": df.w}, probs).collect()}
    for c, i in (("v", 1), ("w", 2)):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        assert [both[c, p] for p in probs] == pytest.approx(np.quantile(values, probs).tolist())
    assert quantiles.exact_quantiles(df.where("false"), "v", probs).collect() == []
    assert quantiles.exact_quantiles(df.where("false"), "v", probs, ["g"]).collect() == []


def test_fold_sums_by_subtraction(spark):
    """Training sums of every fold against NumPy on the imputed, standardised rows of the other folds."""
    df, _ = table(spark, 300)
    params, stats = cv_frame(df, "id", FEATURES, "y")
    rows = df.withColumn("f", fold_id("id")).toPandas()
    medians = fold_medians(df.withColumn("f", fold_id("id")), "f", FEATURES, 5)
    for f in range(5):
        train, val = rows[rows.f != f], rows[rows.f == f]
        med = train[FEATURES].median()
        assert [medians[f, c] for c in FEATURES] == pytest.approx(med.tolist())
        filled = train[FEATURES].fillna(med)
        mean, sd = filled.mean(), filled.std(ddof=0)
        assert [params[(f,)][c] for c in FEATURES] == [pytest.approx((med[c], mean[c], sd[c])) for c in FEATURES]
        for role, part in (("train", train), ("val", val)):
            z, y, s = ((part[FEATURES].fillna(med) - mean) / sd).to_numpy(), part.y.to_numpy(), stats[f, role]
            assert (s.n, s.sy, s.yy) == (len(part), pytest.approx(y.sum()), pytest.approx((y * y).sum()))
            assert s.xtx == pytest.approx(z.T @ z, abs=1e-8) and s.xty == pytest.approx(z.T @ y, abs=1e-8) and s.sx == pytest.approx(z.sum(axis=0), abs=1e-8)
    assert masked_gram(df.where("false"), FEATURES) == {}


def test_only_rows_in_open_nodes_are_summed(monkeypatch):
    """Rows held out, and rows whose node is closed, cost the search nothing; sums match a plain count."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, [40, 2, 1, 200], size=(700, 4)).astype(np.uint8)
    y = np.rint(1e5 * rng.normal(size=700))
    seen = []
    cells = trees.Growth.cells

    def counted(self, columns, node, row, w, wg):
        assert self.open[node].all()
        idx, g, h = cells(self, columns, node, row, w, wg)
        plain = {}
        for n, r, a, b in zip(node, row, np.ones(len(row)) if w is None else w, wg, strict=True):
            for slot, j in enumerate(self.chosen[n]):
                if j >= 0:
                    key = (int(n) * self.chosen.shape[1] + slot << 8) + int(bins[block[1] != 0][r, j] if forest else bins[r, j])
                    plain[key] = tuple(x + y for x, y in zip(plain.get(key, (0, 0)), (b, a), strict=True))
        assert idx.tolist() == sorted(plain) and [(a, b) for a, b in zip(g, h, strict=True)] == [plain[k] for k in sorted(plain)]
        seen.append(len(row))
        return idx, g, h

    monkeypatch.setattr(trees.Growth, "cells", counted)
    block = (np.arange(700), np.arange(700) % 5, y, bins)
    fill = np.zeros(4, np.uint8)
    forest = True
    list(trees.forest_here(block, fill, 1.0, {"n_trees": 1, "max_depth": None, "min_leaf": 30, "feature_share": 0.5}, 0, 42, 0, 1))
    assert seen[0] <= 560 and seen[-1] < seen[0] / 2
    forest = False
    two = [{"n_rounds": 2, "learning_rate": 0.1, "max_depth": d, "min_leaf": 30, "l2": 0.0} for d in (2, None)]
    list(trees.boost_here(block, fill, 1.0, 0.0, two, 0, 42))


def test_searches_share_one_binned_table(spark, monkeypatch):
    """F16: each kind of tree binned all lines anew."""
    from panelwright.plans import catalogue

    rng = np.random.default_rng(4)
    rows = [(i, j, float(rng.integers(1, 50)), float(rng.integers(0, 11)) / 100, float(rng.integers(900, 90000))) for i in range(60) for j in range(5)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_extendedprice double")
    monkeypatch.setattr(catalogue, "read", lambda *_: lines)
    made, make = [], trees.bin_rows
    for module in (trees, catalogue):
        monkeypatch.setattr(module, "bin_rows", lambda *a: made.append(1) or make(*a), raising=False)
    got = {(r["kind"], r["l2"], r["fold"]): r["rmse"] for r in catalogue.q_stump_cv(spark, "none").collect()}
    assert len(made) == 1 and len(got) == 15
    apart = trees.search_trees(catalogue.line_model(spark, "none").withColumn("l_discount", catalogue.F.expr("if(l_quantity % 7 <> 0, l_discount, null)")), "line_id", ["l_quantity", "l_discount"], "price", "forest",
                               [{"n_trees": 1, "max_depth": 1, "min_leaf": 20, "feature_share": 1.0, "bootstrap": False}], fold_id("line_id"), 5, 42)
    assert [got["forest", 0.0, f] for f in range(5)] == pytest.approx(apart[0]["fold_rmse"], abs=1e-4)


def test_draws_of_a_search_share_trees_and_sums(spark, monkeypatch):
    """Draws that differ in depth and number of trees only grew their trees anew, and both of two children were summed."""
    base = {"min_leaf": 3, "feature_share": 0.6}
    fits = [{"n_trees": 5, "max_depth": 3, **base}, {"n_trees": 4, "max_depth": None, **base}, {"n_trees": 5, "max_depth": 6, **base}, {"n_trees": 4, "max_depth": 3, "min_leaf": 9, "feature_share": 0.6}]
    assert trees.nested(fits) == [[0, 1, 2], [3]]
    df, _ = table(spark)
    together = trees.search_trees(df, "id", FEATURES, "y", "forest", fits, fold_id("id"), 5, 42)
    for fit, r in zip(fits, together, strict=True):
        alone = trees.search_trees(df, "id", FEATURES, "y", "forest", [fit], fold_id("id"), 5, 42)
        assert r["params"] == fit and r["fold_rmse"] == alone[0]["fold_rmse"]

    rng = np.random.default_rng(6)
    bins = np.column_stack([rng.integers(0, k, 4000) for k in (40, 2, 9, 1, 30)]).astype(np.uint8)
    target = np.rint(np.where(bins[:, 0] > 5, 900, -100) + 30 * bins[:, 4] + rng.normal(scale=50, size=4000))
    summed, sums = [], trees.Columns.sums
    monkeypatch.setattr(trees.Columns, "sums", lambda self, node, row, *a: summed.append(len(row)) or sums(self, node, row, *a))

    def grown(weight, rows):
        g = trees.Growth(5, [7, 8], [3, None], [5, 5], [5, 2], [0.0, 1.0], [31, 31])
        ends = g.fit(trees.Columns(bins), np.stack([target, -target])[:, : len(bins) if rows is None else len(rows)], weight, rows)
        return g, ends, [x.tolist() for x in (g.feature, g.cut, g.child, g.g, g.h)]

    weight = trees.bootstrap(np.arange(4000), trees.seeds_of(2, 42), {})
    dense, _, found = grown(weight, None)
    assert len(summed) > 1 and summed[0] == np.count_nonzero(weight) and all(x <= summed[0] / 2 for x in summed[1:])
    part, ends, _ = grown(None, np.arange(3000))
    assert (ends == part.walk(bins[:3000])).all()
    monkeypatch.setattr(trees, "DENSE", 0)
    monkeypatch.setattr(trees, "SPARSE", 0)
    assert found == grown(weight, None)[2]
    monkeypatch.setattr(trees, "SPARSE", 1 << 40)
    assert found == grown(weight, None)[2]
    top, _, end = dense.walk(bins, [1, 2, None])
    flat = trees.Growth(5, [7, 8], [1, 1], [5, 5], [5, 2], [0.0, 1.0], [31, 31])
    flat.fit(trees.Columns(bins), np.stack([target, -target]), weight)
    assert (dense.values(1.0)[top] == flat.values(1.0)[flat.walk(bins)]).all() and (end == dense.walk(bins)).all()
    draws = trees.bootstrap(np.arange(200_000), trees.seeds_of(1, 3), {})[0]
    share = (trees.mix(np.arange(200_000).astype(np.uint64) ^ trees.mix(trees.seeds_of(1, 3))) >> np.uint64(11)) * 2.0**-53
    assert (draws == np.searchsorted(trees.POISSON, share, side="right")).all()


def test_forests_of_other_limits_share_their_rows(spark, monkeypatch):
    """Forests that differ in their least leaf only summed the same rows for each of them, and binned the table four times."""
    rng = np.random.default_rng(8)
    bins = np.column_stack([rng.integers(0, k, 3000) for k in (60, 2, 9, 1, 200)]).astype(np.uint8)
    y = np.rint(np.where(bins[:, 0] > 25, 900, -100) + 5 * bins[:, 4] + rng.normal(scale=200, size=3000))
    block, fill = (np.arange(3000), np.arange(3000) % 5, y, bins), np.zeros(5, np.uint8)
    seen, cells, sums = [], trees.Growth.cells, trees.Columns.sums
    monkeypatch.setattr(trees.Growth, "cells", lambda self, columns, node, row, *a: seen.append(len(row)) or cells(self, columns, node, row, *a))
    monkeypatch.setattr(trees.Columns, "sums", lambda self, node, row, *a: seen.append(len(row)) or sums(self, node, row, *a))

    def grown(fit, shape, limits=None):
        seen.clear()
        found = [g.values(1.0)[trees.walk(bins, np.arange(i, len(g.limit), shape), g.feature, g.cut, g.child)]
                 for g in trees.forest_here(block, fill, 1.0, fit, 0, 42, 0, 5, limits) for i in range(shape)]
        return [np.concatenate(found[i::shape]) for i in range(shape)], sum(seen)

    for share in ("sqrt", 0.6, 1.0):
        limits = [{"n_trees": 5, "max_depth": d, "min_leaf": m, "feature_share": share} for d, m in ((4, 1), (None, 12), (7, 30), (None, 1))]
        together, rows = grown(limits[0], 4, limits)
        alone = [grown(x, 1) for x in limits]
        assert all((a == b[0][0]).all() for a, b in zip(together, alone, strict=True))
        assert rows < 0.8 * sum(n for _, n in alone)

    from panelwright.operators import supervised

    df, _ = table(spark, 200)
    made, make = [], trees.bin_rows
    for module in (trees, supervised):
        monkeypatch.setattr(module, "bin_rows", lambda *a: made.append(1) or make(*a), raising=False)
    grids = {"forest": {"n_trees": [3, 5], "max_depth": [2, None], "min_leaf": [3, 9], "feature_share": [0.6]}, "boost": {"n_rounds": [3], "learning_rate": [0.1, 0.3], "max_depth": [2], "min_leaf": [5], "l2": [0.0]}}
    found = supervised.evaluate_supervised(df, "id", FEATURES, "y", grids, {"forest": 8, "boost": 2})
    assert len(made) == 1 and [len(found.searches[k]) for k in ("forest", "boost")] == [8, 2]
    for r in found.searches["forest"]:
        alone = trees.search_trees(df, "id", FEATURES, "y", "forest", [r["params"]], fold_id("id"), 5, 42)
        assert r["fold_rmse"] == alone[0]["fold_rmse"]
    best = min(found.searches["forest"], key=lambda r: r["cv_rmse"])["params"]
    apart = trees.fit_trees(df, "id", FEATURES, "y", "forest", best, 42)
    got, same = ([r["prediction"] for r in m(df).orderBy("id").collect()] for m in (found.models["random_forest"].predict, lambda x: apart.predict(x, FEATURES)))
    assert got == pytest.approx(same, abs=1e-12)


def test_compiled_loops_grow_the_same_trees(spark, monkeypatch):
    """NumPy grew every tree, and from 4 MB on every level of every tree was a job; the compiled loops give the same errors and trees bit for bit."""
    assert trees.Binned(None, [None] * 9, {}, {}, 1.0, 700_000).small
    rng = np.random.default_rng(11)
    n, cols = 3000, [f"c{i}" for i in range(17)]
    x = np.column_stack([rng.integers(0, k, n).astype(float) for k in (300, 2, 1, 40, 11, 25, 7, 255, 3, 5, 2, 90, 4, 6, 8, 12, 30)])
    x[rng.random(x.shape) < 0.05] = np.nan
    y = np.where(np.nan_to_num(x[:, 0]) > 90, 5.0, -1.0) + np.nan_to_num(x[:, 7]) / 100 + rng.normal(size=n)
    wide = spark.createDataFrame([(i, *[None if v != v else float(v) for v in x[i]], float(y[i])) for i in range(n)], ", ".join(["id long", *[f"{c} double" for c in cols], "y double"]))
    forests = [{"n_trees": t, "max_depth": d, "min_leaf": m, "feature_share": s} for s in ("sqrt", 0.3, 0.6, 1.0) for t, d, m in ((4, 3, 1), (5, None, 1), (5, None, 6), (3, 8, 30))]
    boosts = [{"n_rounds": r, "learning_rate": 0.2, "max_depth": d, "min_leaf": m, "l2": l2} for d, m, l2 in ((3, 5, 0.0), (8, 10, 0.1), (None, 20, 1.0)) for r in (4, 9)]
    monkeypatch.setattr(trees, "TASK_TREES", 3)
    narrow = table(spark, 400)[0]
    for df, features in ((wide, cols), (narrow, FEATURES)):
        binned = trees.bin_rows(df, "id", features, "y", fold_id("id"), 5)
        assert binned.sent is not None
        for kind, fits in (("forest", forests), ("boost", boosts)):
            def run():
                errors = sorted(map(tuple, trees.fold_errors(binned, kind, fits, 5, 42).collect()))
                return errors, [trees.fit_trees(df, "id", features, "y", kind, f, 42, binned).score(x[:, : len(features)]) for f in fits[1:3]]

            with monkeypatch.context() as m:
                m.setattr(trees.Growth, "fit", None)
                m.setattr(trees, "shared_out", None)
                compiled, scores = run()
            with monkeypatch.context() as m:
                m.setattr(trees.Binned, "sent", None)
                plain, same = run()
            assert compiled == plain and len(compiled) == 5 * len(fits)
            assert all(np.allclose(a, b, rtol=1e-12, atol=0) for a, b in zip(scores, same, strict=True))


def test_a_session_without_the_compiled_loops_goes_on(spark, monkeypatch):
    """Where the class cannot be made, the search is NumPy's."""
    from panelwright.operators import kernels

    monkeypatch.setattr(kernels, "SOURCE", "no class")
    monkeypatch.setattr(kernels, "_CLASSES", {})
    df, _ = table(spark, 200)
    with pytest.warns(UserWarning, match="by NumPy"):
        found = trees.search_trees(df, "id", FEATURES, "y", "forest", FOREST, fold_id("id"), 5, 42)
    assert [len(r["fold_rmse"]) for r in found] == [5, 5]


def test_compiled_scores_are_those_of_the_model(spark, monkeypatch):
    """every row of every repeat was walked through all trees by NumPy."""
    df, _ = table(spark, 400)
    df = df.withColumn("a", trees.F.when(trees.F.col("id") % 9 == 0, float("nan")).otherwise(trees.F.col("a")))
    df = df.unionByName(df).repartition(3)
    for kind, fits in (("forest", FOREST), ("boost", BOOST)):
        for fit in fits:
            model = trees.fit_trees(df, "id", FEATURES, "y", kind, fit, 42)
            walked, walk = [], trees.walk
            with monkeypatch.context() as m:
                m.setattr(trees, "walk", lambda *a: walked.append(1) or walk(*a))
                got = model.predict(df, FEATURES).toPandas().sort_values("id")
            assert model.sent[1] is not None and not walked
            assert got["prediction"].to_numpy() == pytest.approx(model.score(got[FEATURES].to_numpy(dtype=float)), rel=1e-12)
            assert "Python" not in model.predict(df, FEATURES)._jdf.queryExecution().executedPlan().toString()
