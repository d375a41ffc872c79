"""The worked golden of FIXTURES.md section 3, plus edge cases of the outcome summary."""

import pytest

from panelwright.operators.outcomes import OutcomeSpec, career_summary

SPEC = OutcomeSpec(entity="id", period="Season", stint="Team", games="G", minutes="MP",
                   weights={"PTS": 1.0}, order_by=["Team"])

PANEL = [
    # a: debut 2012, 150 games, rate 20, two qualifying seasons
    ("a", "2012-13", "AAA", 75.0, 1000.0, 1500.0),
    ("a", "2013-14", "AAA", 75.0, 1000.0, 1500.0),
    # b: debut 2022, 140 games, rate 10; a 2024 row with G=0 sets the window end
    ("b", "2022-23", "BBB", 70.0, 900.0, 700.0),
    ("b", "2023-24", "BBB", 70.0, 900.0, 700.0),
    ("b", "2024-25", "BBB", 0.0, 0.0, 0.0),
    # c: one qualifying season -> tier C
    ("c", "2015-16", "CCC", 20.0, 200.0, 100.0),
    ("c", "2016-17", "CCC", 5.0, 50.0, 10.0),
    # d: debut 2010 -> outside the cohort
    ("d", "2010-11", "DDD", 50.0, 500.0, 400.0),
    ("d", "2011-12", "DDD", 50.0, 500.0, 400.0),
    # e: games but none qualifying -> tier B
    ("e", "2020-21", "EEE", 9.0, 500.0, 90.0),
    # f: no games at all -> tier A
    ("f", "2019-20", "FFF", None, None, None),
    # g: G=10 and MP=100 qualifies; null MP does not; an unparsable season -> debut -1
    ("g", "2018-19", "GGG", 10.0, 100.0, 50.0),
    ("g", "2019-20", "GGG", 30.0, None, 60.0),
    ("g", "bad", "GGG", 1.0, 1.0, 1.0),
]


@pytest.fixture(scope="module")
def summary(spark):
    df = spark.createDataFrame(PANEL, "id string, Season string, Team string, G double, MP double, PTS double")
    return {r["id"]: r.asDict() for r in career_summary(df, SPEC).collect()}


def test_tiers_and_cohort(summary):
    assert {k: v["tier"] for k, v in summary.items()} == {
        "a": "D", "b": "D", "c": "C", "d": "D", "e": "B", "f": "A", "g": "C"}
    assert summary["a"]["entry_cohort"] and summary["b"]["entry_cohort"]
    assert not summary["d"]["entry_cohort"]
    assert summary["g"]["first_period_start_year"] == -1 and not summary["g"]["entry_cohort"]
    assert summary["g"]["eligible_periods"] is None


def test_golden_composite(summary):
    a, b = summary["a"], summary["b"]
    assert a["window_end_year"] == 2024
    assert a["eligible_periods"] == 13 and b["eligible_periods"] == 3
    assert a["games_vs_opportunity"] == pytest.approx(150 / 1066)
    assert b["games_vs_opportunity"] == pytest.approx(140 / 246)
    assert (a["z_rate"], b["z_rate"]) == pytest.approx((1.0, -1.0))
    assert (a["z_longevity"], b["z_longevity"]) == pytest.approx((-1.0, 1.0))
    assert a["composite"] == pytest.approx(0.4) and b["composite"] == pytest.approx(-0.4)
    for k in "cdefg":
        assert summary[k]["composite"] is None


def test_rollup_details(summary):
    assert summary["f"]["career_games"] == 0.0 and summary["f"]["n_qualifying"] == 0
    assert summary["b"]["mean_rate_qual"] == pytest.approx(10.0)  # the G=0 row has a null rate and does not qualify
    assert summary["e"]["mean_rate_qual"] is None
    assert summary["g"]["n_qualifying"] == 1
    assert summary["a"]["first_period"] == "2012-13"


def test_single_eligible_entity_gives_null_z(spark):
    df = spark.createDataFrame(PANEL[:2], "id string, Season string, Team string, G double, MP double, PTS double")
    out = career_summary(df, SPEC).first()
    assert out["tier"] == "D" and out["z_rate"] is None and out["composite"] is None


def test_spec_variants(spark):
    from pyspark.sql import functions as F

    from panelwright.operators.outcomes import add_composite, prime_rate, quartile_label

    df = spark.createDataFrame(PANEL, "id string, Season string, Team string, G double, MP double, PTS double")
    prime = {r["id"]: r["prime_rate"] for r in prime_rate(df, SPEC, best=1).collect()}
    assert prime["a"] == pytest.approx(20.0) and prime["c"] == pytest.approx(5.0) and "e" not in prime
    summ = career_summary(df, SPEC)
    labels = {r["id"]: r["quartile"] for r in quartile_label(summ.filter("composite IS NOT NULL")).collect()}
    assert labels == {"a": "top", "b": "bottom"}
    # Restricting the eligible set to one entity leaves sd 0, so the restricted z is null.
    r = {x["id"]: x["composite_r"] for x in add_composite(summ, SPEC, restrict=F.col("id") == "a", suffix="_r").collect()}
    assert r["a"] is None and r["b"] is None
