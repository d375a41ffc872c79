import pytest
from pyspark.sql import functions as F

from panelwright.operators.assemble import (
    DuplicateKeyError,
    anti_join,
    key_set_diff,
    outer_blocks,
    patch_join,
    replace_by_key,
    validated_left_join,
)
from panelwright.operators.clean import (
    drop_all_null_columns,
    drop_repeated_headers,
    drop_spacer_rows,
    normalise_names,
    safe_numeric,
    split_by_tag,
)
from panelwright.operators.outcomes import combined_stint_flag
from panelwright.operators.select import keep_first, keep_last, latest_per_key, prefer_flagged
from tests.conftest import rows


def test_prefer_flagged_fixture(spark):
    data = [
        # id, season, team, ord
        ("p1", "2011-12", "2TM", 1), ("p1", "2011-12", "AAA", 2), ("p1", "2011-12", "BBB", 3),   # flag first
        ("p2", "2011-12", "AAA", 1), ("p2", "2011-12", "2TM", 2), ("p2", "2011-12", "BBB", 3),   # flag middle
        ("p3", "2011-12", "AAA", 1), ("p3", "2011-12", "BBB", 2), ("p3", "2011-12", "2TM", 3),   # flag last
        ("p4", "2011-12", "3TM", 1), ("p4", "2011-12", "2TM", 2),                                # two flagged
        ("p5", "2011-12", "AAA", 1), ("p5", "2011-12", "BBB", 2),                                # no flag
        ("p6", "2011-12", None, 1), ("p6", "2011-12", "CCC", 2),                                 # null team
        ("p7", "2011-12", "2TMX", 1), ("p7", "2011-12", "DDD", 2),                               # 2TMX no match
        (None, "2011-12", "2TM", 1),                                                             # null key dropped
    ]
    df = spark.createDataFrame(data, "id string, season string, team string, ord int")
    out = prefer_flagged(df, ["id", "season"], combined_stint_flag("team"), ["ord"])
    got = {r["id"]: r["team"] for r in out.collect()}
    assert got == {"p1": "2TM", "p2": "2TM", "p3": "2TM", "p4": "3TM", "p5": "AAA", "p6": None, "p7": "2TMX"}


def test_keep_first_last_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, o int")
    assert rows(keep_first(df, ["k"], ["o"]), ["o"]) == [{"k": None, "o": 1}, {"k": "a", "o": 3}]
    assert rows(keep_last(df, ["k"], ["o"]), ["o"]) == [{"k": None, "o": 2}, {"k": "a", "o": 4}]
    assert keep_first(df, ["missing"], ["o"]).count() == 4


def test_latest_per_key_rules(spark):
    df = spark.createDataFrame([
        ("a", "2010-11", 1, 1.0), ("a", "2012-13", 2, 2.0), ("a", "Career", 3, 9.0),
        ("b", "2013-14", 1, 1.0), ("b", "2013-14", 2, 5.0),      # tie in year: last row wins
        ("c", "Career", 1, 7.0),                                   # only Career: dropped
        (None, "2014-15", 1, 0.0),                                 # null key dropped
    ], "k string, season string, o int, v double")
    got = {r["k"]: r["v"] for r in latest_per_key(df, "k", "season", ["o"]).collect()}
    assert got == {"a": 2.0, "b": 5.0}


def test_latest_per_key_fallbacks(spark):
    career_only = spark.createDataFrame([("a", "Career", 1), ("a", "career", 2), ("b", "x", 3)], "k string, season string, o int")
    assert sorted(r["o"] for r in latest_per_key(career_only, "k", "season", ["o"]).collect()) == [1, 2]
    neither = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 3)], "k string, season string, o int")
    assert sorted(r["o"] for r in latest_per_key(neither, "k", "season", ["o"]).collect()) == [1, 3]
    no_period = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, o int")
    assert sorted(r["o"] for r in latest_per_key(no_period, "k", "season", ["o"]).collect()) == [2, 3]


def test_patch_join_fixture(spark):
    base = spark.createDataFrame([
        ("p", "2011-12", "AAA", 1.0), ("p", "2011-12", "BBB", 2.0), ("q", "2011-12", "CCC", 3.0), ("r", "2012-13", "DDD", 4.0),
    ], "id string, season string, team string, PER double")
    patch = spark.createDataFrame([
        ("p", "2011-12", "X", 10.0, 1.5), ("p", "2011-12", "Y", 20.0, 2.5),   # two rows per key: first wins
        ("q", "2011-12", "X", None, 3.5),                                      # null keeps left
    ], "id string, season string, team string, PER double, BPM double")
    out = patch_join(base, patch, ["id", "season"], ["PER", "BPM"], order_by=["team"])
    got = {(r["id"], r["team"]): (r["PER"], r["BPM"]) for r in out.collect()}
    assert got == {("p", "AAA"): (10.0, 1.5), ("p", "BBB"): (10.0, 1.5), ("q", "CCC"): (3.0, 3.5), ("r", "DDD"): (4.0, None)}


def test_validated_join_raises_on_duplicates(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([("a", 1)], "k string, y int")
    with pytest.raises(DuplicateKeyError):
        validated_left_join(left, right, ["k"])
    with pytest.raises(DuplicateKeyError):
        validated_left_join(right, left.withColumnRenamed("x", "z"), ["k"])


def test_anti_join_keeps_null_keys_and_compares_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    keys = spark.createDataFrame([("1",)], "k string")
    assert sorted(r["v"] for r in anti_join(df, keys, "k").collect()) == ["b", "c"]


def test_replace_by_key_and_key_diff(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert rows(replace_by_key(old, new, "k"), ["k"]) == [{"k": 1, "v": "old"}, {"k": 2, "v": "new"}, {"k": 3, "v": "new"}]
    d = key_set_diff(old, new, "k", "k").first()
    assert (d["missing_in_b"], d["extra_in_b"]) == (1, 1)


def test_outer_blocks_matches_outer_join(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, a_v double")
    b = spark.createDataFrame([("y", 3.0), ("z", 4.0), (None, 5.0)], "k string, b_v double")
    got = rows(outer_blocks([a, b], "k"), ["k"])
    assert got == [{"k": "x", "a_v": 1.0, "b_v": None}, {"k": "y", "a_v": 2.0, "b_v": 3.0},
                   {"k": "z", "a_v": None, "b_v": 4.0}, {"k": None, "a_v": None, "b_v": 5.0}]


def test_spacers_headers_and_all_null(spark):
    df = spark.createDataFrame([
        (None, "1", None), ("", "2", None), ("  ", "3", None), ("nan", "4", None), ("2011-12", "5", None),
        ("2011-12", "Rk", None), ("2012-13", None, None),
    ], "Season string, Rk string, empty double")
    kept = drop_repeated_headers(drop_spacer_rows(df, "Season"))
    assert sorted((r["Season"], r["Rk"]) for r in kept.collect() if r["Rk"]) == [("2011-12", "5")]
    assert kept.count() == 2  # the null Rk row is kept
    assert drop_all_null_columns(df).columns == ["Season", "Rk"]
    empty = spark.createDataFrame([], "a string, b string")
    assert drop_all_null_columns(empty).columns == ["a", "b"]


def test_split_by_tag_orders_ids_then_sorted(spark):
    df = spark.createDataFrame([
        ("p", "totals", "2011-12", 1.0, None), ("p", "advanced", "2011-12", None, 2.0), ("q", None, "x", 1.0, 1.0),
    ], "id string, table_id string, Season string, PTS double, BPM double")
    parts = split_by_tag(df, "table_id", ["id"])
    assert set(parts) == {"totals", "advanced"}
    assert parts["totals"].columns == ["id", "PTS", "Season"]
    assert parts["advanced"].columns == ["id", "BPM", "Season"]


def test_normalise_names_and_safe_numeric(spark):
    df = spark.createDataFrame([("1", "2", "x", "a", "1,000", "2011-12")],
                               "`Unnamed: 0` string, `FG%` string, `W/L x` string, txt string, big string, Season string")
    n = normalise_names(df)
    assert n.columns == ["FGpct", "W_L_x", "txt", "big", "Season"]
    typed = safe_numeric(n)
    types = dict(typed.dtypes)
    assert types["FGpct"] == "double" and types["txt"] == "string" and types["Season"] == "string"
    assert types["big"] == "string"  # nothing parses, stays text
    mixed = spark.createDataFrame([("1",), ("x",)], "v string")
    assert [r[0] for r in safe_numeric(mixed).collect()] == [1.0, None]
    assert F is not None
