"""Reading the driver tables and shaping them into the panel abstractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import period_label
from panelwright.operators.outcomes import OutcomeSpec
from panelwright.session import materialize

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line measures: one partial+final aggregation on l_orderkey.

    The output is hash-partitioned on the order key, so the join to orders
    that follows shuffles only the orders side.
    """
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("mp"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"),
        F.count(F.lit(1)).alias("nl"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("taxamt"),
        F.max("l_quantity").alias("mq"),
        F.max("l_discount").alias("md"),
    )


def customer_year_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x order-year x priority rows (the per-stint rows of the panel)."""
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), F.col("o_orderpriority").alias("stint")
    )
    return (
        o.join(order_measures(spark, sf_dir), "o_orderkey")
        .groupBy("o_custkey", "yr", "stint")
        .agg(
            F.count(F.lit(1)).cast("double").alias("G"),
            F.sum("mp").alias("MP"),
            F.sum("rev").alias("REV"),
            F.sum("nl").cast("double").alias("NL"),
            F.sum("taxamt").alias("TAXAMT"),
            F.max("mq").alias("MQ"),
            F.max("md").alias("MD"),
        )
    )


def customer_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with one row per stint plus a combined ``kTM`` row when a year has k >= 2 stints."""
    stints = materialize(customer_year_stints(spark, sf_dir), "stints")
    combined = (
        stints.groupBy("o_custkey", "yr")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("G").alias("G"), F.sum("MP").alias("MP"), F.sum("REV").alias("REV"),
            F.sum("NL").alias("NL"), F.sum("TAXAMT").alias("TAXAMT"),
        )
        .filter(F.col("k") >= 2)
        .withColumn("stint", F.concat(F.col("k").cast("string"), F.lit("TM")))
        .drop("k")
    )
    cols = ["o_custkey", "period", "stint", "G", "MP", "REV", "NL", "TAXAMT"]
    return (
        stints.drop("MQ", "MD").unionByName(combined)
        .withColumn("period", period_label("yr"))
        .select(*cols)
    )


# Parameters of the customer x year outcome definition used by the catalogue.
CUSTOMER_SPEC = OutcomeSpec(
    entity="o_custkey",
    period="period",
    stint="stint",
    games="G",
    minutes="MP",
    weights={"REV": 0.01, "NL": 2.0, "TAXAMT": -0.05},
    order_by=["stint"],
    min_games=2,
    min_minutes=100,
    entry_min=1995,
    entry_max=1997,
    min_valid_year=1990,
    games_per_period=12,
)


# ------------------------------------------------- reference-shaped long tables

def entity_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long stat table tagged by ``table_id``: ``totals`` rows per (customer, year, priority
    stint), combined ``kTM`` rows, one ``Career`` row per customer, and ``advanced`` rows of
    line averages per (customer, year, priority).

    Everything derives from one per-order line aggregate joined to orders:
    line averages are sums over line counts, and the combined and career rows
    come from one grouping-sets aggregation over the stint rows.
    """
    from panelwright.operators.assemble import union_by_name

    # Four branches read the stint aggregate with different column sets, so
    # Spark cannot reuse one exchange; write it once and let them read it.
    stints = materialize(customer_year_stints(spark, sf_dir), "stints")
    measures = ["G", "MP", "REV", "NL", "TAXAMT"]
    totals = stints.select(
        F.col("o_custkey").alias("entity_id"), F.lit("totals").alias("table_id"),
        period_label("yr").alias("Season"), F.col("stint").alias("Team"), F.col("stint").alias("Pos"), *measures,
    )
    # (customer, year) and (customer) sums in one aggregation over the stint rows.
    rolled = stints.groupingSets(
        [["o_custkey", "yr"], ["o_custkey"]], "o_custkey", "yr"
    ).agg(
        F.count(F.lit(1)).alias("k"), F.min("stint").alias("Pos"), F.grouping_id().alias("gid"),
        *[F.sum(m).alias(m) for m in measures],
    )
    combined = rolled.filter((F.col("gid") == 0) & (F.col("k") >= 2)).select(
        F.col("o_custkey").alias("entity_id"), F.lit("totals").alias("table_id"),
        period_label("yr").alias("Season"), F.concat(F.col("k").cast("string"), F.lit("TM")).alias("Team"),
        "Pos", *measures,
    )
    career = rolled.filter(F.col("gid") == 1).select(
        F.col("o_custkey").alias("entity_id"), F.lit("totals").alias("table_id"), F.lit("Career").alias("Season"),
        F.lit("TOT").alias("Team"), *measures,
    )
    adv = stints.select(
        F.col("o_custkey").alias("entity_id"), F.lit("advanced").alias("table_id"), period_label("yr").alias("Season"),
        F.col("stint").alias("Team"), (F.col("MP") / F.col("NL")).alias("AQ"), "MQ", "MD",
    )
    return union_by_name([totals, combined, career, adv])


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity -> link id crosswalk with profile fields, derived from customer."""
    c = read(spark, sf_dir, "customer")
    bad = F.col("c_acctbal") < 0
    return c.select(
        F.col("c_custkey").alias("entity_id"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_nationkey").cast("string")).alias("link_id"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit("unknown"))
        .otherwise(F.format_string("%d-06-15", F.lit(1960) + F.col("c_nationkey"))).alias("birthday"),
        F.when(bad, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(bad, F.lit("negative balance")).alias("error"),
    )


def detail_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-link (supplier nation) long table tagged totals/per100/advanced, with Career rows."""
    from panelwright.operators.assemble import union_by_name

    li = read(spark, sf_dir, "lineitem")
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    base = li.join(s, "l_suppkey").groupBy(
        F.col("s_nationkey").cast("string").alias("link_id"), F.year("l_shipdate").alias("yr")
    ).agg(
        F.count(F.lit(1)).alias("N"), F.sum("l_quantity").alias("QTY"),
        F.avg("l_quantity").alias("AQ"), F.max("l_discount").alias("MD"),
    )
    # Six branches read this aggregate; written once (see entity_long).
    base = materialize(base, "detail-base")
    team = F.concat(F.lit("T"), F.col("link_id")).alias("Team")
    season = period_label("yr").alias("Season")
    per_year = [
        base.select("link_id", F.lit("totals").alias("table_id"), season, team, F.col("N").cast("double").alias("N"), "QTY"),
        base.select("link_id", F.lit("per100").alias("table_id"), season, team,
                    (F.lit(100.0) * F.col("QTY") / F.col("N")).alias("QTY100")),
        base.select("link_id", F.lit("advanced").alias("table_id"), season, team, "AQ", "MD"),
    ]
    career = base.groupBy("link_id").agg(
        F.sum("N").alias("N"), F.sum("QTY").alias("QTY"), F.max("MD").alias("MD")
    )
    c_season = F.lit("Career").alias("Season")
    per_career = [
        career.select("link_id", F.lit("totals").alias("table_id"), c_season, team, F.col("N").cast("double").alias("N"), "QTY"),
        career.select("link_id", F.lit("per100").alias("table_id"), c_season, team,
                      (F.lit(100.0) * F.col("QTY") / F.col("N")).alias("QTY100")),
        career.select("link_id", F.lit("advanced").alias("table_id"), c_season, team,
                      (F.col("QTY") / F.col("N")).alias("AQ"), "MD"),
    ]
    return union_by_name(per_year + per_career)


def panel_spec():
    from panelwright.plans.panel import PanelSpec

    return PanelSpec(
        entity="entity_id", link="link_id", patch_columns=["AQ", "MQ", "MD"],
        detail_order=["Season", "Team"],
    )


# Outcome definition over the assembled panel (same parameters as CUSTOMER_SPEC).
PANEL_OUTCOME = OutcomeSpec(
    entity="entity_id",
    period="Season",
    stint="Team",
    games="G",
    minutes="MP",
    weights={"REV": 0.01, "NL": 2.0, "TAXAMT": -0.05},
    order_by=["Team"],
    min_games=2,
    min_minutes=100,
    entry_min=1995,
    entry_max=1997,
    min_valid_year=1990,
    games_per_period=12,
)

# Fixed values for the catalogue's position coding: priority codes kept, and
# the dummy levels (code 1 and unknown are the baseline).
POSITION_LEVELS = ("1", "2", "3")
DUMMY_LEVELS = ("2", "3")
