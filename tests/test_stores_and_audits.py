"""Checked joins, running shares, wide correlations, file order, audits of a set, profiles, entity stores."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.operators.assemble import checked_left_join, left_join_spread
from panelwright.operators.audit import KeyRule, TableRules, audit_set
from panelwright.operators.eda import corr_by_gram, cumulative_share, profile_columns
from panelwright.sources.files import read_csv_text, read_optional
from panelwright.streaming.entity_store import EntityStore
from panelwright.streaming.refresh import latest_version, refresh


def test_checked_join_fails_in_its_plan(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (3, 30)], "k int, y int")
    assert sorted(map(tuple, checked_left_join(left, right, ["k"]).collect()), key=str) == [(1, "a", 10), (2, "b", None), (None, "c", None)]
    nulls = spark.createDataFrame([(None, "n")], "k int, x string")
    for a, b in ((left.unionByName(left), right), (left, right.unionByName(right)), (left.unionByName(nulls), right)):
        joined = checked_left_join(a, b, ["k"])  # planned without a job
        with pytest.raises(Exception, match="repeated key"):
            joined.collect()


def test_rows_without_a_link_match_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "z")], "e int, link string")
    dim = spark.createDataFrame([("a", 1), (None, 2)], "link string, v int")
    assert sorted(tuple(r) for r in left_join_spread(df, dim, "link", ["e"]).select("e", "v").collect()) == [(1, 1), (2, None), (3, None), (4, None)]


def test_running_share_over_many_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(f"k{i:04d}", int(v)) for i, v in enumerate(rng.integers(0, 40, 3000))]
    got = cumulative_share(spark.createDataFrame(rows, "k string, v long").repartition(6), "k", "v").collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    run, total = np.cumsum([v for _, v in want]), sum(v for _, v in want)
    assert {r["k"]: r["cum_share"] for r in got} == {k: pytest.approx(c / total) for (k, _), c in zip(want, run, strict=True)}
    assert cumulative_share(spark.createDataFrame([], "k string, v long"), "k", "v").collect() == []


def test_wide_correlations_against_pandas(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 6)) + 1e5
    x[:, 1] += 3 * x[:, 0]
    x[:, 4] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = np.nan
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in names)).repartition(4)
    want = pd.DataFrame(x, columns=names).corr()
    for r in corr_by_gram(df, names).collect():
        w = want.loc[r["col_a"], r["col_b"]]
        constant = {"c4", "c5"} & {r["col_a"], r["col_b"]}
        assert r["r"] is None if constant else r["r"] == pytest.approx(w, abs=1e-6)


def test_file_order_of_equal_names_and_splits(spark, tmp_path):
    for folder, base in (("b", 0), ("a", 5000)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.csv").write_text("x\n" + "\n".join(str(base + 7 * i % 3001) for i in range(3001)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        rows = read_csv_text(spark, str(tmp_path / "*")).orderBy("_row_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [int(r["x"]) for r in rows] == [base + 7 * i % 3001 for base in (5000, 0) for i in range(3001)]


def test_optional_csv_has_the_declared_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,x\nno,y\n")
    got = read_optional(spark, str(tmp_path / "t.csv"), "a string, b int, c date", "csv")
    assert got.dtypes == [("a", "string"), ("b", "int"), ("c", "date")]
    assert sorted(tuple(r) for r in got.collect()) == [("x", 1, None), ("y", None, None)]


def test_audit_of_a_set_scans_each_table_once(spark, tmp_path):
    rows = [(1, "a", None), (1, "a", None), (2, None, "p"), (2, "", "p"), (None, None, None), (None, " ", None)]
    spark.createDataFrame(rows, "k int, t string, period string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def broken():
        raise OSError("no")

    registry = {
        "t": TableRules([KeyRule(["k"], "note"), KeyRule(["k", "t"], where=F.col("period").isNotNull()), KeyRule(["gone"])], period="period"),
        "empty": TableRules([KeyRule(["id"])], allow_empty=True),
        "broken": TableRules(),
    }
    out = audit_set(spark, {"t": df, "empty": spark.range(0), "broken": broken}, registry)
    got = {(r["table"], r["check"], r["detail"]): (r["severity"], r["n_rows"]) for r in out.collect()}
    assert got["t", "row_count", None] == ("ok", 6) and got["t", "empty_rows", None] == ("issue", 2) and got["t", "no_period", "period"] == ("note", 4)
    assert got["t", "key_duplicates", "k"] == ("note", 6) and got["t", "key_duplicates", "k,t"] == ("ok", 0)
    assert got["t", "full_row_duplicates", None] == ("issue", 2)
    assert got["t", "key_duplicates", "missing columns gone"] == ("issue", 0)
    assert got["empty", "row_count", None] == ("ok", 0) and got["broken", "readable", "OSError"] == ("issue", 0)
    alone = audit_set(spark, {"t": df}, {"t": TableRules([KeyRule(["k"]), KeyRule(["t"])])})
    assert alone._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_profile_from_value_counts(spark):
    rng = np.random.default_rng(4)
    x = [None if v < 1 else float(v) for v in rng.integers(0, 9, 500)]
    df = spark.createDataFrame([(v, "hot" if i % 3 else f"t{i % 7}") for i, v in enumerate(x)], "x double, t string").repartition(3)
    got = {r["column"]: r for r in profile_columns(df).collect()}
    s = pd.Series(x, dtype=float)
    assert (got["x"]["n_rows"], got["x"]["n_null"], got["x"]["n_distinct"]) == (500, s.isna().sum(), s.nunique())
    assert [got["x"][c] for c in ("mean", "std", "min", "max")] == pytest.approx([s.mean(), s.std(), s.min(), s.max()])
    assert got["t"]["top_values"].startswith("hot:333|") and got["t"]["mean"] is None and got["t"]["least"] == "hot"
    assert profile_columns(df.where("false")).count() == 0


def test_entity_store_changes_whole_buckets_under_commits(spark, tmp_path):
    def table(s):
        return sorted(map(tuple, s.read().select("k", "v").collect()), key=str)

    def rows(*r):
        return spark.createDataFrame(list(r), "k string, v int")

    s = EntityStore(spark, str(tmp_path / "s"), "k", buckets=4)
    assert s.apply("a", rows(("x", 1), ("x", 2), ("y", 3), (None, 4))).count() == 3
    assert s.apply("b", rows(("x", 9), ("z", 5))).count() == 2
    assert s.apply("b", rows(("x", 100))).count() == 0, "a replay"
    assert table(s) == [("x", 9), ("y", 3), ("z", 5), (None, 4)]
    assert s.apply("c", rows(("x", 7), ("w", 8)), "backfill").collect()[0][0] == "w"
    assert table(s) == [("w", 8), ("x", 9), ("y", 3), ("z", 5), (None, 4)]
    assert sorted(r["v"] for r in s.read(rows(("x", 0), (None, 0))).collect()) == [4, 9]
    s.apply("d", rows(), entities=rows(("y", 0)))  # an entity that has no rows any more
    assert table(s) == [("w", 8), ("x", 9), ("z", 5), (None, 4)]
    s._fs.mkdirs(s._path("data/cut-off/__bucket=1"))  # a change that was cut off leaves no record
    assert len(s.commits()) == 4 and len(table(EntityStore(spark, str(tmp_path / "s"), "k", 4))) == 4
    with pytest.raises(RuntimeError):
        s._commit(0, {})
    with pytest.raises(ValueError):
        s.apply("e", rows(("x", 1)), "merge")


def test_refresh_skips_unfinished_versions_and_replayed_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    refresh(spark, root, spark.createDataFrame([(1, "a")], "k int, v string"), "k", batch_id=0)
    (tmp_path / "t" / "v=7").mkdir()  # cut off before its commit
    assert latest_version(spark, root)[0] == 0
    assert refresh(spark, root, spark.createDataFrame([(1, "z")], "k int, v string"), "k", batch_id=0)[1] == -1
    path, n = refresh(spark, root, spark.createDataFrame([(2, "b")], "k int, v string"), "k", batch_id=1)
    assert n == 2 and sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_rows_apart_counts_repeats_and_nulls_in_one_shuffle(spark, monkeypatch):
    """the comparison of the refreshed panel moved both frames twice."""
    from pyspark.sql import DataFrame

    from panelwright.plans.catalogue import rows_apart

    a = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, None, 0.5), (3, "z", 1.0)], "k int, s string, v double")
    b = spark.createDataFrame([(None, 1, "x"), (0.5, 2, None), (0.5, 2, None), (9.0, 4, "y")], "v double, k int, s string")
    same = b.select("k", "s", "v")
    assert rows_apart(a, b) == a.exceptAll(same).count() + same.exceptAll(a).count() == 4
    assert rows_apart(a, a) == 0 == rows_apart(a.where("false"), b.where("false"))
    monkeypatch.setattr(DataFrame, "exceptAll", None)
    assert rows_apart(a, a.where("k < 3")) == 1


def test_panel_is_deduped_before_it_is_widened(spark):
    """wide rows were sorted and shuffled to keep one per (entity, period), and the patch was shuffled twice."""
    from panelwright.operators.outcomes import OutcomeSpec, dedupe_periods
    from panelwright.plans.panel import PanelSpec, build_panel

    rows = [(e, t, s, team, float(i % 5 + 1), 10.0 + i, None if t == "totals" else float(i) if i % 3 else None)
            for i, (e, s, team, t) in enumerate((e, s, team, t) for e in (1, 2, 3, None) for s in ("1999-00", "2000-01", "Career", None) for team in ("a", "b", "2TM") for t in ("totals", "advanced"))
            if not (e == 2 and team == "2TM") and not (e == 3 and s == "2000-01" and t == "advanced")]
    long = spark.createDataFrame(rows, "entity_id long, table_id string, Season string, Team string, G double, MP double, AQ double")
    crosswalk = spark.createDataFrame([(1, "x"), (2, None), (4, "y")], "entity_id long, link_id string")
    detail = spark.createDataFrame([("x", "totals", "1998-99", "u", 5.0), ("x", "totals", "1999-00", "v", 6.0), ("y", "totals", "1999-00", "w", 7.0), (None, "totals", "1999-00", "z", 8.0)],
                                   "link_id string, table_id string, Season string, Team string, N double")
    spec = PanelSpec(patch_columns=["AQ"], detail_tags=["totals"], detail_order=["Season", "Team"])
    outcome = OutcomeSpec("entity_id", "Season", "Team", "G", "MP", {}, ["Team"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        late = dedupe_periods(build_panel(long, crosswalk, detail, spec), outcome)
        early = build_panel(long, crosswalk, detail, spec, lambda df: dedupe_periods(df, outcome))
        text = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert text(early).count("Exchange hashpartitioning") < text(late).count("Exchange hashpartitioning")
        key = lambda r: tuple(str(x) for x in r)
        assert early.columns == late.columns
        found = sorted(map(tuple, early.collect()), key=key)
        assert found == sorted(map(tuple, late.collect()), key=key)
        assert len(found) == 6 and {r[0] for r in found} == {1, 2, 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
