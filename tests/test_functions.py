import math

from pyspark.sql import functions as F

from panelwright.functions import (
    height_inches,
    is_period_label,
    period_label,
    position_code,
    recruiting_rank,
    recruiting_year,
    safe_ratio,
    start_year,
    strip_prefixes,
    to_number,
    url_join,
    url_join_col,
    weight_lb,
    weighted_sum,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_start_year(spark):
    assert one_col(spark, [" 2011-12", "abc", None, "201", "2011", "Career"], start_year) == [2011, -1, -1, -1, 2011, -1]


def test_period_label_roundtrip(spark):
    assert one_col(spark, [1995, 1999, 2009], period_label, "int") == ["1995-96", "1999-00", "2009-10"]
    assert one_col(spark, ["2011-12", "Career", "2011", "2011-2012", None], is_period_label) == [True, False, False, False, False]


def test_position_code(spark):
    got = one_col(spark, ["SG-PG", "sf/pf", " C ", "G", None, ""], position_code)
    assert got == ["SG", "SF", "C", "UNK", "UNK", "UNK"]


def test_profile_text_fields(spark):
    texts = ["Recruiting Rank: 2017 (30)", "6-10 , 253lb", "season 2011-12 only", "5-12 tall"]
    assert one_col(spark, texts, recruiting_year) == [2017, None, None, None]
    assert one_col(spark, texts, recruiting_rank) == [30, None, None, None]
    assert one_col(spark, texts, height_inches) == [None, 82.0, None, None]
    assert one_col(spark, texts, weight_lb) == [None, 253.0, None, None]


def test_to_number_rejects_suffixes_and_separators(spark):
    got = one_col(spark, ["3.5", " 7 ", "1,000", "1d", "inf", "nan", "-2e3", "x", None], to_number)
    assert got[:2] == [3.5, 7.0]
    assert got[2] is None and got[3] is None
    assert math.isinf(got[4])
    assert got[5] is None and got[7] is None and got[8] is None
    assert got[6] == -2000.0


def test_weighted_sum_and_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (1.0, None, 0.0)], "a double, b double, g double")
    out = df.select(weighted_sum({"a": 2.0, "b": -1.0}).alias("w"), safe_ratio("a", "g").alias("r")).collect()
    assert (out[0]["w"], out[0]["r"]) == (0.0, 0.25)
    assert out[1]["w"] is None and out[1]["r"] is None


def test_strip_prefixes_first_listed_wins(spark):
    got = one_col(spark, ["cbb_advanced_BPM", "cbb_totals_PTS", "pos_is_C", "PER"],
                  lambda c: strip_prefixes(c, ["cbb_advanced_", "cbb_totals_", "pos_is_"]))
    assert got == ["BPM", "PTS", "C", "PER"]


def test_url_join(spark):
    got = one_col(spark, ["/players/a/x.html", "https://o.org/y", "//cdn.org/z", "rel.html"],
                  lambda c: url_join("https://www.site.com/dir/page.html", c))
    assert got == ["https://www.site.com/players/a/x.html", "https://o.org/y", "https://cdn.org/z",
                   "https://www.site.com/dir/rel.html"]
    df = spark.createDataFrame([("https://a.org/en/5?x=1", "/p"), ("http://b.net/en/7", "q")], "u string, h string")
    assert [r[0] for r in df.select(url_join_col("u", "h")).collect()] == ["https://a.org/p", "http://b.net/en/q"]
