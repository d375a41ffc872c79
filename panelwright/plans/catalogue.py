"""Catalogue of queries over the driver tables, one per operator family.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built with
the library operators.  Doubles are rounded to 4 places at the very end only,
so results compare exactly with the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelwright.functions import (
    strip_prefixes,
    contains_text,
    dummies,
    extract_or_null,
    height_inches,
    period_label,
    position_code,
    recruiting_rank,
    recruiting_year,
    safe_ratio,
    season_urls,
    start_year,
    url_id,
    url_join_col,
    weight_lb,
    weighted_sum,
)
from panelwright.functions._util import qcol
from panelwright.operators.assemble import (
    backfill,
    key_set_diff,
    left_join,
    outer_blocks,
    patch_join,
    replace_by_key,
    union_by_name,
    checked_left_join,
)
from panelwright.operators.clean import (
    blank_to_null_all,
    drop_all_null_columns,
    drop_spacer_rows,
    failure_log,
    flatten_name,
    normalise_names,
    prefix_columns,
    project_with_optional,
    require_non_null,
    safe_numeric,
    tag_literal,
    tag_schema,
)
from panelwright.operators.audit import (
    KeyRule,
    TableRule,
    TableRules,
    audit_set,
    audit_table,
    duplicate_row_count,
    empty_row_count,
    missing_period_profile,
    readiness,
    summary_counters,
)
from panelwright.operators.eda import (
    box_stats,
    conditional_counts,
    corr_matrix,
    cumulative_share,
    describe,
    first_non_null,
    histogram,
    max_group_size,
    null_rates,
    pivot_report,
    profile_columns,
    scatter_pairs,
    top_groups,
    value_counts,
)
from panelwright.operators.cohort import (
    cohort_mask,
    debut_age,
    feature_projection,
    feature_stats,
    modeling_cohort,
)
from panelwright.operators.modeling import (
    apply_imputer_scaler,
    cv_frame,
    fit_imputer_scaler,
    fit_imputer_scaler_long,
    fold_id,
    gram_sums,
    lasso_cv,
    lasso_gradient,
    lasso_solve,
    linear_prediction,
    params_table,
    permutation_importance,
    regression_metrics,
    ridge_cv,
    ridge_solve,
    selected_features,
    split_label,
    BOOST_DRAWS,
    BOOST_GRID,
    FOREST_DRAWS,
    FOREST_GRID,
    N_FOLDS,
    SEED,
    TOP_IMPORTANCES,
)
from panelwright.operators.quantiles import global_rank
from panelwright.operators.trees import bin_rows, params_text, search_trees
from panelwright.operators.outcomes import add_composite, career_summary, dedupe_periods, prime_rate, quartile_label
from panelwright.operators.pca import (
    best_variant_per_base,
    covariance_frame,
    covariance_matrix,
    fit_pca,
    pc_outcome_corr,
    pca_analysis,
    pca_checks,
)
from panelwright.operators.supervised import Evaluation, evaluate_supervised, model_report
from panelwright.operators.select import (
    argmax_row,
    earliest_value_per_key,
    first_seen,
    keep_first,
    keep_last,
    latest_per_key,
    prefer_flagged,
    top_n,
)
from panelwright.plans.panel import PanelSpec, build_panel, normalise_tables, pages_to_panel, write_normalised
from panelwright.plans.rendered import BASE_URL, CANDIDATES, LISTING, rendered_pages
from panelwright.streaming.entity_store import EntityStore
from panelwright.session import materialize, scratch_folder, scratch_generation
from panelwright.sources.files import (
    count_periods_column,
    latest_file,
    range_from_name,
    read_csv_text,
    read_optional,
    require_inputs,
    row_count,
    write_json,
    write_table,
)
from panelwright.sources.pages import listing_rows, page_bios, page_comments, page_links, page_rows, page_status, page_tables
from panelwright.plans.tables import (
    CUSTOMER_SPEC,
    DUMMY_LEVELS,
    PANEL_OUTCOME,
    POSITION_LEVELS,
    TABLES,
    crosswalk,
    customer_year_panel,
    customer_year_stints,
    detail_long,
    entity_long,
    panel_spec,
    read,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (comparison-friendly output)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(qcol(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(qcol(f.name))
    return df.select(*cols)


# ------------------------------------------------------------- outcomes

def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return career_summary(customer_year_panel(spark, sf_dir), CUSTOMER_SPEC)


@register("career_summary")
def q_career_summary(spark, sf_dir):
    return finish(customer_summary(spark, sf_dir))


@register("tier_counts")
def q_tier_counts(spark, sf_dir):
    s = customer_summary(spark, sf_dir)
    return s.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count_if(F.col("entry_cohort")).alias("n_cohort"),
        F.count("composite").alias("n_composite"),
    )


@register("zscore_composite")
def q_zscore_composite(spark, sf_dir):
    s = customer_summary(spark, sf_dir)
    return finish(
        s.filter((F.col("tier") == "D") & F.col("entry_cohort")).select(
            "o_custkey", "z_rate", "z_longevity", "composite"
        )
    )


@register("opportunity_share")
def q_opportunity_share(spark, sf_dir):
    s = customer_summary(spark, sf_dir)
    return finish(
        s.select(
            "o_custkey", "first_period_start_year", "window_end_year", "eligible_periods",
            "nominal_max_games", "games_vs_opportunity",
        )
    )


# --------------------------------------------------------- row selection (W)

@register("dedupe_prefer_flagged")
def q_dedupe_prefer_flagged(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    out = prefer_flagged(
        li, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "A",
        ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"],
    )
    return finish(out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate",
        "l_quantity", "l_extendedprice",
    ))


@register("keep_first")
def q_keep_first(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    out = keep_first(ev, ["user_id", "event_type"], ["event_id"])
    return finish(out.select("user_id", "event_type", "event_id", "ts", "value"))


@register("keep_last")
def q_keep_last(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    out = keep_last(ev, ["user_id", "event_type"], ["event_id"])
    return finish(out.select("user_id", "event_type", "event_id", "ts", "value"))


def orders_with_period(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("period", period_label(F.year("o_orderdate")))


@register("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    o = orders_with_period(spark, sf_dir)
    out = latest_per_key(o, "o_custkey", "period", ["o_orderdate", "o_orderkey"])
    return finish(out.select("o_custkey", "o_orderkey", "period", "o_totalprice"))


@register("earliest_per_key")
def q_earliest_per_key(spark, sf_dir):
    o = orders_with_period(spark, sf_dir)
    return earliest_value_per_key(
        o, "o_custkey", start_year("period"), "o_orderpriority", ["o_orderdate", "o_orderkey"],
        min_year=1990, alias="first_priority",
    )


@register("first_seen")
def q_first_seen(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    out = first_seen(o, "o_custkey", "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_orderdate")


# ------------------------------------------------------- scalar measures (F)

@register("weighted_index")
def q_weighted_index(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn(
        "l_tax_n", F.when(F.col("l_linenumber") != 3, F.col("l_tax"))
    )
    idx = weighted_sum({"l_extendedprice": 0.5, "l_discount": 100.0, "l_tax_n": -200.0})
    return finish(li.select("l_orderkey", "l_linenumber", idx.alias("index_value")))


@register("safe_ratio")
def q_safe_ratio(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return finish(li.select(
        "l_orderkey", "l_linenumber", safe_ratio("l_extendedprice", "l_tax").alias("price_per_tax")
    ))


# ------------------------------------------------------------------ joins (J)

def customer_year_totals(spark, sf_dir) -> DataFrame:
    stints = customer_year_stints(spark, sf_dir)
    return (
        stints.groupBy("o_custkey", "yr")
        .agg(F.sum("G").alias("G"), F.sum("MP").alias("MP"))
        .withColumn("AQ", F.col("MP") / F.col("G"))
        .withColumn("period", period_label("yr"))
        .drop("yr")
    )


def late_year_line_stats(spark, sf_dir) -> DataFrame:
    """Per (customer, period, priority) line averages for orders from 1998 on (the patch rows)."""
    o = read(spark, sf_dir, "orders").filter(F.year("o_orderdate") >= 1998)
    li = read(spark, sf_dir, "lineitem")
    return (
        o.join(li, o.o_orderkey == li.l_orderkey)
        .groupBy("o_custkey", period_label(F.year("o_orderdate")).alias("period"),
                 F.col("o_orderpriority").alias("stint"))
        .agg(F.avg("l_quantity").alias("AQ"), F.max("l_discount").alias("MD"))
    )


@register("patch_join")
def q_patch_join(spark, sf_dir):
    base = customer_year_totals(spark, sf_dir)
    patch = late_year_line_stats(spark, sf_dir)
    out = patch_join(base, patch, ["o_custkey", "period"], ["AQ", "MD"], order_by=["stint"])
    return finish(out.select("o_custkey", "period", "G", "MP", "AQ", "MD"))


@register("left_label_join")
def q_left_label_join(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nk"))
    n = read(spark, sf_dir, "nation").filter(F.col("n_regionkey") <= 2).select(
        F.col("n_nationkey").alias("nk"), "n_name"
    )
    return left_join(c, n, "nk", fill={"n_name": "UNK"}).select("c_custkey", "c_name", "n_name")


@register("one_to_one_join")
def q_one_to_one_join(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    s = customer_summary(spark, sf_dir).select("o_custkey", "tier")
    return checked_left_join(c, s, ["o_custkey"])


@register("outer_block_assembly")
def q_outer_block_assembly(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    blocks = []
    for flag in ("A", "N", "R"):
        b = li.filter(F.col("l_returnflag") == flag).groupBy("l_orderkey").agg(
            F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n")
        )
        blocks.append(prefix_columns(b, f"{flag}_", "l_orderkey"))
    wide = outer_blocks(blocks, "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return finish(left_join(o, wide, "o_orderkey").select(
        "o_orderkey", "o_custkey", "A_qty", "A_n", "N_qty", "N_n", "R_qty", "R_n"
    ))


# ------------------------------------------------------- cleaning (P, F18)

def events_long(spark, sf_dir) -> DataFrame:
    """Events as a long tagged table with injected gaps and spacer labels."""
    ev = read(spark, sf_dir, "events")
    m7 = F.col("event_id") % 7
    return ev.select(
        "event_id", "user_id", F.col("event_type").alias("table_id"),
        F.when(m7 == 0, F.lit(None)).when(m7 == 1, F.lit("")).when(m7 == 2, F.lit("  "))
        .when(m7 == 3, F.lit("nan")).otherwise(period_label(F.year("ts"))).alias("Season"),
        F.when(m7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("click_value"),
        F.when(F.col("event_type") == "purchase", F.col("props")).alias("purchase_props"),
        F.lit(None).cast("double").alias("empty_measure"),
    )


@register("split_by_type")
def q_split_by_type(spark, sf_dir):
    return tag_schema(events_long(spark, sf_dir), "table_id", ["event_id", "user_id"])


@register("drop_all_null")
def q_drop_all_null(spark, sf_dir):
    return finish(drop_all_null_columns(events_long(spark, sf_dir)))


@register("drop_spacers")
def q_drop_spacers(spark, sf_dir):
    out = drop_spacer_rows(events_long(spark, sf_dir), "Season")
    return out.select("event_id", "table_id", "Season")


@register("normalise_names")
def q_normalise_names(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Unnamed: 0"),
        F.col("l_orderkey").alias("order"),
        F.col("l_discount").alias(flatten_name(("Price", "disc %"))),
        F.col("l_tax").alias("tax/price"),
        F.col("l_quantity").alias(" qty total "),
        F.col("l_returnflag").alias(flatten_name(("nan", "flag"))),
    )
    return finish(normalise_names(li))


@register("safe_numeric")
def q_safe_numeric(spark, sf_dir):
    ev = read(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, F.lit("x"))
        .otherwise(F.regexp_extract("props", "([0-9]+)", 1)).alias("k"),
        F.col("event_type").alias("kind"),
        F.format_string("%d", F.col("user_id")).alias("Team"),
    )
    return finish(safe_numeric(ev))


# --------------------------------------------------- refresh and key sets

@register("replace_by_key")
def q_replace_by_key(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    existing = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    return finish(replace_by_key(existing, new, "o_custkey"))


@register("backfill_keys")
def q_backfill_keys(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    existing = o.filter(F.year("o_orderdate") <= 1996)
    later = o.filter(F.year("o_orderdate") >= 1997)
    return backfill(existing, later, "o_custkey")


@register("key_set_diff")
def q_key_set_diff(spark, sf_dir):
    docs = key_set_diff(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id", "doc_id")
    ords = key_set_diff(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
    return docs.select(
        F.col("missing_in_b").alias("docs_without_label"), F.col("extra_in_b").alias("labels_without_doc"),
        ords.select(F.col("missing_in_b")).scalar().alias("orders_without_lines"),
        ords.select(F.col("extra_in_b")).scalar().alias("lines_without_order"),
    )


def doc_profiles(spark, sf_dir) -> DataFrame:
    """documents + labels as a profile table with a status and an error text."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    lab = read(spark, sf_dir, "labels")
    return left_join(d, lab, "doc_id").select(
        "doc_id", "source", "lang", "quality",
        F.when(F.col("toxic") == 1, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(F.col("toxic") == 1, F.concat(F.lit("toxic:"), F.col("lang"))).alias("error"),
    )


@register("crosswalk_filter")
def q_crosswalk_filter(spark, sf_dir):
    p = doc_profiles(spark, sf_dir)
    cw = project_with_optional(
        p, ["doc_id", "source", "quality", "status", "height", "weight"],
        {"height": "double", "weight": "double"},
    )
    mapped = cw.filter(F.col("quality").isNotNull() & F.col("source").isNotNull())
    return mapped.select("source", "quality", "height").distinct()


@register("failure_log")
def q_failure_log(spark, sf_dir):
    return failure_log(doc_profiles(spark, sf_dir), "status", "doc_id", "source", "error")


@register("union_by_name")
def q_union_by_name(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = read(spark, sf_dir, "labels").select("doc_id", "quality")
    u = union_by_name([d.filter(contains_text("source", "src1")), lab])
    return u.select("doc_id", "lang", "source", "quality")


# ------------------------------------------------------------ profiling (A)

EVENT_NUMERIC = ["value", "click_value", "user_id", "event_id"]
LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("null_rates")
def q_null_rates(spark, sf_dir):
    return finish(null_rates(events_long(spark, sf_dir)))


@register("describe")
def q_describe(spark, sf_dir):
    return finish(describe(read(spark, sf_dir, "lineitem"), LINE_NUMERIC))


@register("value_counts")
def q_value_counts(spark, sf_dir):
    return value_counts(events_long(spark, sf_dir), "Season")


@register("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    return finish(corr_matrix(events_long(spark, sf_dir), EVENT_NUMERIC))


@register("histogram")
def q_histogram(spark, sf_dir):
    return finish(histogram(read(spark, sf_dir, "events"), "value", 30, group="event_type"))


@register("box_stats")
def q_box_stats(spark, sf_dir):
    return finish(box_stats(read(spark, sf_dir, "events"), "value", "event_type"))


def customer_spend(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))


@register("top_bottom")
def q_top_bottom(spark, sf_dir):
    s = customer_spend(spark, sf_dir)
    top = top_n(s, [F.col("spend").desc(), F.col("o_custkey").asc()], 25).withColumn("side", F.lit("top"))
    bottom = top_n(s.filter(F.col("spend").isNotNull()), [F.col("spend").asc(), F.col("o_custkey").asc()], 10) \
        .withColumn("side", F.lit("bottom"))
    return finish(top.unionByName(bottom).select("side", "o_custkey", "spend"))


@register("first_non_null")
def q_first_non_null(spark, sf_dir):
    return finish(first_non_null(events_long(spark, sf_dir), "user_id", ["value", "click_value"], ["event_id"]))


@register("scatter_pairs")
def q_scatter_pairs(spark, sf_dir):
    return finish(scatter_pairs(events_long(spark, sf_dir), "value", "click_value", extra=["event_id"]))


@register("grain_check")
def q_grain_check(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    li = read(spark, sf_dir, "lineitem")
    counts = conditional_counts(o, {"n_urgent": F.col("o_orderpriority") == "1-URGENT",
                                    "n_open": F.col("o_orderstatus") == "O"})
    return counts.select(
        "n_urgent", "n_open",
        max_group_size(li, ["l_orderkey"]).alias("max_lines_per_order"),
        max_group_size(li, ["l_orderkey", "l_linenumber"]).alias("max_key_group"),
        o.agg(F.count_distinct("o_custkey")).scalar().alias("n_customers"),
        o.select("o_custkey", "o_orderstatus").distinct().agg(F.count(F.lit(1))).scalar().alias("n_cust_status"),
        o.agg(F.min("o_orderdate")).scalar().alias("min_orderdate"),
        o.agg(F.max("o_orderdate")).scalar().alias("max_orderdate"),
    )


@register("top_groups")
def q_top_groups(spark, sf_dir):
    return top_groups(read(spark, sf_dir, "lineitem"), "l_suppkey", 3)


@register("report_pivot")
def q_report_pivot(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    cells = li.groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_quantity").alias("avg_qty"))
    return finish(pivot_report(cells, "l_returnflag", "l_linestatus", "avg_qty", ["O", "F"]))


@register("report_unpivot")
def q_report_unpivot(spark, sf_dir):
    d = describe(read(spark, sf_dir, "lineitem"), LINE_NUMERIC)
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return finish(d.unpivot(["column"], stats, "stat", "value"))


@register("cumulative_share")
def q_cumulative_share(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rev = li.join(p, "l_partkey").groupBy("p_brand").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )
    return finish(cumulative_share(rev, "p_brand", "revenue"))


@register("running_share_lines")
def q_running_share_lines(spark, sf_dir):
    """Running share of every line's price (W8 over a whole large table)."""
    li = read(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")  # whole numbers: sums don't depend on their order
    return finish(cumulative_share(li.select(key.alias("line"), cents.alias("cents")), "line", "cents").drop("share"))


@register("corr_embedding")
def q_corr_embedding(spark, sf_dir):
    """Correlations of all 64 embedding dimensions, pairwise over the vectors that have both."""
    v = read(spark, sf_dir, "embeddings")
    dims = [F.when((F.col("vec_id") + i) % 7 != 0, F.col("embedding")[i].cast("double")).alias(f"d{i:02d}") for i in range(64)]
    rows = corr_matrix(v.select(*dims), [f"d{i:02d}" for i in range(64)])
    return finish(rows).withColumn("r", F.col("r") + F.lit(0.0))  # no negative zeros


@register("profile_columns")
def q_profile_columns(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_tax")))
    rows = profile_columns(li, ["l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linenumber"])
    return finish(rows.select("column", "n_rows", "n_null", "null_share", "n_distinct", "mean", "std", "min", "max", F.when(F.col("column") != "l_extendedprice", F.regexp_replace("top_values", r"\.0:", ":")).alias("top_values")))


@register("file_order")
def q_file_order(spark, sf_dir):
    """Rows of two files of one name in two folders, cut into many splits, in file order."""
    root = scratch_folder(spark, "file-order")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 2).alias("half"))
    orders.coalesce(1).sortWithinPartitions("half", F.col("o_orderkey").desc()).write.partitionBy("half").option("header", True).csv(root)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))
        rows = materialize(read_csv_text(spark, f"{root}/half=*"), "file-order-rows")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    place = global_rank(rows.select("o_orderkey", "o_orderstatus", F.col("_row_ord.file").alias("file"), F.col("_row_ord.block").alias("block"), F.col("_row_ord.pos").alias("pos")), ["block", "pos"], ["file"], label="file-order-ranked")
    return place.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus", F.col("__r").cast("long").alias("place"))


# ---------------------------------------------------------------- audits (V)

@register("audit_set")
def q_audit_set(spark, sf_dir):
    """A registry of rules over several tables, one of which cannot be read (V4, V6)."""
    el = events_long(spark, sf_dir)
    twice = read(spark, sf_dir, "customer").unionByName(read(spark, sf_dir, "customer").where("c_custkey % 100 = 0"))
    tables = {
        "lineitem": read(spark, sf_dir, "lineitem"), "orders": lambda: read(spark, sf_dir, "orders"), "customer": twice,
        "events_long": el, "nothing": read(spark, sf_dir, "nation").where("false"), "gone": lambda: read(spark, sf_dir, "no_such_table"),
    }
    registry = {
        "lineitem": TableRules([KeyRule(["l_orderkey", "l_linenumber"], "note"), KeyRule(["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"])]),
        "orders": TableRules([KeyRule(["o_orderkey"]), KeyRule(["o_custkey"], where=F.col("o_orderstatus") == "P"), KeyRule(["o_orderkey", "o_nothing"])]),
        "customer": TableRules([KeyRule(["c_custkey"]), KeyRule(["c_nationkey"], "note")]),
        "events_long": TableRules([KeyRule(["user_id", "table_id", "Season"], where=F.col("Season").isNotNull())], full_rows=None, period="Season"),
        "nothing": TableRules([KeyRule(["n_nationkey"])]),
        "gone": TableRules([KeyRule(["id"])]),
    }
    return audit_set(spark, tables, registry)


def rows_apart(left: DataFrame, right: DataFrame) -> int:
    """Rows, with repeats, that only one of two frames has: both sides counted in one shuffle."""
    signed = left.withColumn("__side", F.lit(1)).unionByName(right.select(*[qcol(c) for c in left.columns], F.lit(-1).alias("__side")))
    apart = signed.groupBy(*[qcol(c) for c in left.columns]).agg(F.sum("__side").alias("__more"))
    return apart.agg(F.coalesce(F.sum(F.abs("__more")), F.lit(0)).alias("n")).first()["n"]


@register("refresh_rebuild")
def q_refresh_rebuild(spark, sf_dir):
    """A stored long table is replaced in part, replayed and backfilled; its panel is redone for changed entities only."""
    root, spec = scratch_folder(spark, "entity-store"), panel_spec()
    long = materialize(entity_long(spark, sf_dir), "store-long")
    links = materialize(crosswalk(spark, sf_dir), "store-crosswalk")
    scaled = lambda rows, f: rows.withColumn("G", F.col("G") * f)
    build = lambda rows: build_panel(rows, links, None, spec)
    stats, panel = EntityStore(spark, f"{root}/long", "entity_id", 16), EntityStore(spark, f"{root}/panel", "entity_id", 16)
    steps = [
        ("first", long.where("entity_id % 3 <> 0"), "replace"),
        ("fix", scaled(long.where("entity_id % 5 = 0"), 2), "replace"),
        ("fix", scaled(long.where("entity_id % 5 = 0"), 7), "replace"),  # a replay
        ("fill", long.where("entity_id % 3 = 0"), "backfill"),
    ]
    for batch, rows, mode in steps:
        panel.rebuild(f"panel-{batch}", stats, stats.apply(batch, rows, mode), build)
    whole = build(stats.read())
    differ = rows_apart(panel.read(), whole)
    parts = normalise_tables(stats.read(), "table_id", ["entity_id"], ["totals", "advanced"])
    rows = panel.read().groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("G").alias("games"))
    return finish(rows.withColumns({"differ": F.lit(differ), "commits": F.lit(len(stats.commits())), "n_totals": F.lit(parts["totals"].count()), "n_advanced": F.lit(parts["advanced"].count())}))


@register("audit_duplicates")
def q_audit_duplicates(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    kd = duplicate_row_count(li, ["l_orderkey", "l_linenumber"])
    return kd.select(
        F.col("n_dup_rows").alias("key_dup_rows"),
        duplicate_row_count(li).select("n_dup_rows").scalar().alias("full_dup_rows"),
    )


@register("audit_empty")
def q_audit_empty(spark, sf_dir):
    el = events_long(spark, sf_dir).select("Season", "purchase_props", "empty_measure")
    return el.agg(empty_row_count(el).alias("n_empty_rows"), F.count(F.lit(1)).alias("n_rows"))


@register("audit_tables")
def q_audit_tables(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    el = events_long(spark, sf_dir)
    a = audit_table(li, TableRule("lineitem", ["l_orderkey", "l_linenumber"], period=None))
    b = audit_table(el, TableRule("events_long", ["user_id", "table_id", "Season"],
                                  row_filter=F.col("Season").isNotNull(), period="Season"))
    return a.unionByName(b)


@register("readiness")
def q_readiness(spark, sf_dir):
    prof = doc_profiles(spark, sf_dir)
    labels = read(spark, sf_dir, "labels")
    docs = read(spark, sf_dir, "documents")
    return readiness(
        profiles=prof, status="status", entity_list=labels, entity_key="doc_id", profile_key="doc_id",
        crosswalk=prof.filter(F.col("lang") != "es"),
        failures=failure_log(prof, "status", "doc_id", "source", "error"),
        mapping_keys=docs.filter(F.col("lang") == "en"), mapping_key="source",
        detail_rows=docs.join(labels.filter(F.col("quality") == 1), "doc_id"), detail_key="source",
    )


@register("summary_counters")
def q_summary_counters(spark, sf_dir):
    counters = {f"n_{t}": read(spark, sf_dir, t) for t in TABLES}
    counters["n_panel_rows"] = customer_year_panel(spark, sf_dir)
    counters["n_error_profiles"] = doc_profiles(spark, sf_dir).filter(F.col("status") == "error")
    return summary_counters(spark, counters)


# --------------------------------------------------- panel assembly

PANEL_COLUMNS = [
    "entity_id", "Season", "Team", "Pos", "G", "MP", "AQ", "MQ", "MD", "link_id", "birthday", "status",
    "cbb_totals_Season", "cbb_totals_N", "cbb_totals_QTY", "cbb_per100_QTY100", "cbb_advanced_AQ",
    "cbb_advanced_MD", "cbb_advanced_Team",
]


def assembled_panel(spark, sf_dir, dedupe=None) -> DataFrame:
    return build_panel(entity_long(spark, sf_dir), crosswalk(spark, sf_dir), detail_long(spark, sf_dir), panel_spec(), dedupe)


@register("panel_build")
def q_panel_build(spark, sf_dir):
    return finish(assembled_panel(spark, sf_dir).select(*PANEL_COLUMNS))


@register("normalise_tables")
def q_normalise_tables(spark, sf_dir):
    long = entity_long(spark, sf_dir)
    long = long.withColumn(
        "Rk", F.when((F.col("Season") == "Career") & (F.col("entity_id") % 2 == 0), F.lit("Rk"))
    ).withColumn(
        "Season",
        F.when((F.col("table_id") == "advanced") & (F.col("entity_id") % 9 == 0), F.lit("  "))
        .otherwise(F.col("Season")),
    )
    parts = normalise_tables(long, "table_id", ["entity_id"], ["totals", "per100", "advanced"])
    rows = []
    for tag, frame in parts.items():
        if frame is None:
            rows.append(spark.range(1).select(
                F.lit(tag).alias("table_id"), F.lit(0).cast("long").alias("n_rows"),
                F.lit(None).cast("string").alias("columns")))
        else:
            rows.append(frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(tag).alias("table_id"), "n_rows", F.lit(",".join(frame.columns)).alias("columns")))
    return union_by_name(rows)


# -------------------------------------------------------------- cohort (C4)

def stored_panel(spark, sf_dir) -> DataFrame:
    """The assembled panel, deduped to one row per (entity, period), written once a session and table folder;
    the summary, first rows and demographics of every query read it without re-running the dedupe."""
    return _stored(spark, sf_dir, "panel", lambda: materialize(assembled_panel(spark, sf_dir, lambda rows: dedupe_periods(rows, PANEL_OUTCOME)), "panel-deduped"))


_STORED: dict = {}


def _stored(spark, sf_dir, name, make):
    """What ``make`` gives, kept for the session as long as its scratch tables are there."""
    key = (*scratch_generation(spark), sf_dir, name)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def masked_base(spark, sf_dir) -> DataFrame:
    panel = stored_panel(spark, sf_dir)
    summ = career_summary(panel, PANEL_OUTCOME, deduped=True)
    first_rows = keep_first(panel, ["entity_id"], ["Season", "Team"])
    base = checked_left_join(first_rows, summ, ["entity_id"])
    return base.filter(cohort_mask("tier", "entry_cohort", "link_id", "composite"))


def cohort_frame(spark, sf_dir) -> DataFrame:
    panel = stored_panel(spark, sf_dir)
    summ = career_summary(panel, PANEL_OUTCOME, deduped=True)
    return modeling_cohort(
        panel, summ, PANEL_OUTCOME, link="link_id", require=["cbb_advanced_AQ"], birth="birthday",
        pos_col="Pos", valid=POSITION_LEVELS, dummy_levels=DUMMY_LEVELS, deduped=True,
    )


MODEL_FEATURES = ["debut_age", "pos_is_2", "pos_is_3", "cbb_advanced_AQ", "cbb_advanced_MD",
                  "cbb_totals_QTY", "cbb_per100_QTY100", "AQ", "MD"]


@register("cohort_mask")
def q_cohort_mask(spark, sf_dir):
    return finish(masked_base(spark, sf_dir).select("entity_id", "tier", "composite", "link_id"))


@register("cohort_frame")
def q_cohort_frame(spark, sf_dir):
    return finish(cohort_frame(spark, sf_dir).select(
        "entity_id", "Season", "tier", "composite", "first_period_start_year", *MODEL_FEATURES
    ))


@register("complete_case")
def q_complete_case(spark, sf_dir):
    return finish(require_non_null(cohort_frame(spark, sf_dir), ["debut_age"]).select("entity_id", "debut_age"))


@register("feature_projection")
def q_feature_projection(spark, sf_dir):
    return finish(feature_projection(cohort_frame(spark, sf_dir), "entity_id", MODEL_FEATURES, "composite"))


FEATURE_PREFIXES = ("cbb_advanced_", "cbb_per100_", "cbb_totals_")
FEATURE_EXTRA = ("debut_age", "pos_is_2", "pos_is_3")


@register("select_features")
def q_select_features(spark, sf_dir):
    return finish(feature_stats(cohort_frame(spark, sf_dir), FEATURE_PREFIXES, FEATURE_EXTRA,
                                exclude=("composite", "entity_id")))


@register("position_code")
def q_position_code(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", position_code(F.col("o_orderpriority"), POSITION_LEVELS).alias("code"))


@register("dummies")
def q_dummies(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    code = position_code(F.col("o_orderpriority"), POSITION_LEVELS)
    return o.select("o_orderkey", *dummies(code, DUMMY_LEVELS, "pos_is_"))


@register("debut_age")
def q_debut_age(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("not a date"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("birth"),
    )
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("first_period_start_year")
    )
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return finish(j.select("l_orderkey", "l_linenumber", debut_age("first_period_start_year", "birth").alias("age")))


# ------------------------------------------------------------- modeling (M)

@register("hash_split")
def q_hash_split(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.groupBy(split_label("o_orderkey").alias("split")).agg(F.count(F.lit(1)).alias("n"))


@register("kfold_sizes")
def q_kfold_sizes(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.groupBy(fold_id("o_orderkey").alias("fold")).agg(F.count(F.lit(1)).alias("n"))


def lines_with_gaps(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") != 2, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_tax")).alias("l_tax"),
        split_label(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("split"),
    )


@register("impute_scale")
def q_impute_scale(spark, sf_dir):
    d = lines_with_gaps(spark, sf_dir)
    params = params_table(fit_imputer_scaler(d.filter(F.col("split") == "train"), LINE_NUMERIC))[()]
    test = d.filter(F.col("split") == "test")
    return finish(apply_imputer_scaler(test, params, LINE_NUMERIC, keep=["l_orderkey", "l_linenumber"]))


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    stats = gram_sums(li, ["l_quantity"], "l_extendedprice")[()]
    b0, beta = ridge_solve(stats, 0.0)
    scored = li.select("l_extendedprice", linear_prediction(["l_quantity"], b0, beta).alias("prediction"))
    return finish(regression_metrics(scored, "l_extendedprice", "prediction"))


def modeling_frame(spark, sf_dir) -> DataFrame:
    """Supervised frame (C9) with a train/test label per entity, written once for reuse."""
    def make():
        frame = feature_projection(cohort_frame(spark, sf_dir), "entity_id", MODEL_FEATURES, "composite")
        return materialize(frame.withColumn("split", split_label("entity_id")), "modeling-frame")

    return _stored(spark, sf_dir, "modeling", make)


def _flag_best(rows, key, lower_is_better=True):
    best = min(rows, key=lambda r: r[key]) if lower_is_better else max(rows, key=lambda r: r[key])
    return [{**r, "is_best": r is best} for r in rows]


@register("ridge_cv")
def q_ridge_cv(spark, sf_dir):
    train = modeling_frame(spark, sf_dir).filter(F.col("split") == "train")
    rows = _flag_best(ridge_cv(cv_frame(train, "entity_id", MODEL_FEATURES, "composite")[1]), "cv_rmse")
    return spark.createDataFrame([(r["alpha"], r["cv_rmse"], r["is_best"]) for r in rows],
                                 "alpha double, cv_rmse double, is_best boolean")


@register("lasso_path")
def q_lasso_path(spark, sf_dir):
    train = modeling_frame(spark, sf_dir).filter(F.col("split") == "train")
    _, stats = cv_frame(train, "entity_id", MODEL_FEATURES, "composite")
    params = params_table(fit_imputer_scaler(train, MODEL_FEATURES))[()]
    whole = gram_sums(apply_imputer_scaler(train, params, MODEL_FEATURES, keep=["composite"]), MODEL_FEATURES, "composite")[()]
    return spark.createDataFrame([(r["alpha"], r["cv_mse"], r["is_best"]) for r in _flag_best(lasso_cv(stats, whole), "cv_mse")],
                                 "alpha double, cv_mse double, is_best boolean")


def evaluated(spark, sf_dir):
    """(train, test, evaluation) on the modeling frame: the whole searches over both grids, run once a session and table folder."""
    def make():
        mf = modeling_frame(spark, sf_dir)
        train, test = mf.filter(F.col("split") == "train"), mf.filter(F.col("split") == "test")
        grids, draws = {"forest": FOREST_GRID, "boost": BOOST_GRID}, {"forest": FOREST_DRAWS, "boost": BOOST_DRAWS}
        return train, test, evaluate_supervised(train, "entity_id", MODEL_FEATURES, "composite", grids, draws)

    return _stored(spark, sf_dir, "evaluated", make)


def _search_rows(spark, rows):
    return spark.createDataFrame([(r["draw"], params_text(r["params"]), r["fold_rmse"], r["cv_rmse"], r["is_best"]) for r in _flag_best(rows, "cv_rmse")],
                                 "draw int, params string, fold_rmse array<double>, cv_rmse double, is_best boolean")


@register("forest")
def q_forest(spark, sf_dir):
    return _search_rows(spark, evaluated(spark, sf_dir)[2].searches["forest"])


@register("gbt")
def q_gbt(spark, sf_dir):
    return _search_rows(spark, evaluated(spark, sf_dir)[2].searches["boost"])


@register("search_checks")
def q_search_checks(spark, sf_dir):
    """Per tree kind: its draws, folds and distinct parameter sets, one best draw, and whether every parameter lies in the grid."""
    searches = evaluated(spark, sf_dir)[2].searches
    rows = []
    for kind, grid in (("forest", FOREST_GRID), ("boost", BOOST_GRID)):
        found = searches[kind]
        inside = all(r["params"][k] in grid[k] for r in found for k in grid)
        scores = all(abs(sum(r["fold_rmse"]) / len(r["fold_rmse"]) - r["cv_rmse"]) < 1e-9 and r["cv_rmse"] > 0 for r in found)
        rows.append((kind, len(found), min(len(r["fold_rmse"]) for r in found), len({params_text(r["params"]) for r in found}), inside, scores))
    return spark.createDataFrame(rows, "kind string, n_draws int, n_folds int, n_distinct int, in_grid boolean, consistent boolean")


@register("stump_cv")
def q_stump_cv(spark, sf_dir):
    """One cut found by each tree kind on every fold of all lines, scored on the fold held out (M9, M10 in closed form)."""
    stumps = {
        "forest": [{"n_trees": 1, "max_depth": 1, "min_leaf": 20, "feature_share": 1.0, "bootstrap": False}],
        "boost": [{"n_rounds": 1, "learning_rate": 0.5, "max_depth": 1, "min_leaf": 20, "l2": l2} for l2 in (0.0, 1000.0)],
    }
    lines = line_model(spark, sf_dir).withColumn("l_discount", F.when(F.col("l_quantity") % 7 != 0, F.col("l_discount")))
    table = (lines, "line_id", ["l_quantity", "l_discount"], "price")
    rows, binned = [], bin_rows(*table, fold_id("line_id"), N_FOLDS)
    for kind, fits in stumps.items():
        for r in search_trees(*table, kind, fits, fold_id("line_id"), N_FOLDS, SEED, binned):
            rows += [(kind, float(r["params"].get("l2", 0.0)), i, x) for i, x in enumerate(r["fold_rmse"])]
    return finish(spark.createDataFrame(rows, "kind string, l2 double, fold int, rmse double"))


@register("model_compare")
def q_model_compare(spark, sf_dir):
    _, test, evaluation = evaluated(spark, sf_dir)
    report = materialize(model_report(evaluation, {"test": test}, "composite").select("model", "rmse", "mae", "r2", "cv_score"), "model-report")
    order = {name: i for i, name in enumerate(evaluation.models)}
    ranked = report.withColumn("place", F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), F.col("model")))
    best = argmax_row(ranked, "r2", "place").select(F.col("model").alias("best")).scalar()
    return report.withColumn("is_best", F.col("model") == best)


@register("model_report")
def q_model_report(spark, sf_dir):
    train, test, evaluation = evaluated(spark, sf_dir)
    return model_report(evaluation, {"train": train, "test": test}, "composite")


@register("model_checks")
def q_model_checks(spark, sf_dir):
    """Per model and split: its rows, the outcome's variance, and whether the metrics agree with each other and with them."""
    train, test, evaluation = evaluated(spark, sf_dir)
    splits = {"train": train, "test": test}
    sizes = union_by_name([df.agg(F.lit(k).alias("split"), F.count("composite").alias("n_rows"), F.var_pop("composite").alias("var_outcome")) for k, df in splits.items()])
    joined = model_report(evaluation, splits, "composite").join(sizes, "split")
    agrees = (F.col("mae") <= F.col("rmse")) & (F.abs(F.col("r2") - (1 - F.col("rmse") ** 2 / F.col("var_outcome"))) < 1e-9) & (F.col("cv_score") > 0)
    return finish(joined.select("model", "split", "n_rows", "var_outcome", agrees.alias("consistent")))


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    _, test, evaluation = evaluated(spark, sf_dir)
    candidates = {n: evaluation.models[n] for n in ("ridge", "random_forest", "gradient_boosting")}
    best = argmax_row(model_report(Evaluation(candidates, [], {}), {"test": test}, "composite"), "r2", "model").first()["model"]
    imp = permutation_importance(test, "entity_id", MODEL_FEATURES, "composite", candidates[best].predict)
    return imp.withColumn("model", F.lit(best))


@register("importance_known")
def q_importance_known(spark, sf_dir):
    """Importance under a model that is the outcome itself: one column carries it, the others nothing."""
    lines = line_model(spark, sf_dir).withColumn("same", F.col("price"))
    known = permutation_importance(lines, "line_id", ["l_quantity", "l_discount", "same"], "price", lambda df: df.withColumn("prediction", F.col("same")), repeats=2)
    top = known.withColumn("large", F.col("importance_mean") > 0.9).orderBy(F.col("importance_mean").desc(), "feature").limit(TOP_IMPORTANCES)
    return top.select("feature", "large", (F.col("importance_mean") == 0).alias("none"))


# ----------------------------------------- closed forms and optimality (M6-M8)

def line_model(spark, sf_dir) -> DataFrame:
    """Price in thousands by quantity and discount, one row per line."""
    return read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"), "l_quantity", "l_discount",
        (F.col("l_extendedprice") / 1000).alias("price"))


@register("ridge_two")
def q_ridge_two(spark, sf_dir):
    _, stats = cv_frame(line_model(spark, sf_dir), "line_id", ["l_quantity", "l_discount"], "price")
    rows = [(i, r["alpha"], r["cv_rmse"]) for i, r in enumerate(ridge_cv(stats))]
    return finish(spark.createDataFrame(rows, "step int, alpha double, cv_rmse double"))


@register("lasso_one")
def q_lasso_one(spark, sf_dir):
    lines = line_model(spark, sf_dir)
    _, stats = cv_frame(lines, "line_id", ["l_quantity"], "price")
    params = params_table(fit_imputer_scaler(lines, ["l_quantity"]))[()]
    whole = gram_sums(apply_imputer_scaler(lines, params, ["l_quantity"], keep=["price"]), ["l_quantity"], "price")[()]
    rows = [(i, r["alpha"], r["cv_mse"]) for i, r in enumerate(lasso_cv(stats, whole))]
    return finish(spark.createDataFrame(rows, "step int, alpha double, cv_mse double"))


def lasso_fit(spark, sf_dir):
    """Sums over all training rows, the best alpha and its coefficients."""
    train = modeling_frame(spark, sf_dir).filter("split = 'train'")
    _, stats = cv_frame(train, "entity_id", MODEL_FEATURES, "composite")
    params = params_table(fit_imputer_scaler(train, MODEL_FEATURES))[()]
    whole = gram_sums(apply_imputer_scaler(train, params, MODEL_FEATURES, keep=["composite"]), MODEL_FEATURES, "composite")[()]
    alpha = min(lasso_cv(stats, whole), key=lambda r: r["cv_mse"])["alpha"]
    return whole, alpha, lasso_solve(whole, alpha)[1]


@register("l1_known")
def q_l1_known(spark, sf_dir):
    """Lasso on one column and one that never varies: the second is left out, the first has its closed form (M8)."""
    lines = line_model(spark, sf_dir).withColumn("flat", F.lit(2.0)).withColumn("price", F.col("price") + 2 * F.col("l_quantity"))
    cols = ["flat", "l_quantity"]
    params = params_table(fit_imputer_scaler(lines, cols))[()]
    whole = gram_sums(apply_imputer_scaler(lines, params, cols, keep=["price"]), cols, "price")[()]
    return finish(spark.createDataFrame(selected_features(cols, lasso_solve(whole, 1.5)[1]), "feature string, coefficient double"))


def known_pca(spark, sf_dir):
    """Three columns whose components are known: two in step, and one that has both signs on every line."""
    lines = line_model(spark, sf_dir).withColumn("side", F.explode(F.array(F.lit(-1.0), F.lit(1.0))))
    frame = materialize(lines.select(
        "price", split_label("line_id").alias("split"), (F.col("l_quantity") * 3).alias("a_qty"), F.col("l_quantity").alias("b_qty"), (F.col("side") * 40).alias("c_side")), "pca-known")
    return frame, fit_pca(frame.select("a_qty", "b_qty", "c_side"), ["a_qty", "b_qty", "c_side"])


def no_negative_zeros(df):
    return finish(df).select(*[(F.col(f.name) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


@register("pca_known_loadings")
def q_pca_known_loadings(spark, sf_dir):
    return no_negative_zeros(known_pca(spark, sf_dir)[1].loadings(spark))


@register("pca_known_scree")
def q_pca_known_scree(spark, sf_dir):
    return no_negative_zeros(known_pca(spark, sf_dir)[1].scree(spark))


@register("pca_known_corr")
def q_pca_known_corr(spark, sf_dir):
    frame, model = known_pca(spark, sf_dir)
    return no_negative_zeros(pc_outcome_corr(model.scores(frame, keep=["split", "price"]), "split", "price", model.k))


@register("pca_known_top")
def q_pca_known_top(spark, sf_dir):
    """The variant of largest loading for each base name, prefixes stripped."""
    return no_negative_zeros(best_variant_per_base(known_pca(spark, sf_dir)[1].loadings(spark), "PC1", ("a_", "b_", "c_")))


@register("strip_prefix")
def q_strip_prefix(spark, sf_dir):
    """Column names without their block's prefix."""
    named = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.element_at(F.array(*[F.lit(x) for x in ("cbb_totals_", "cbb_", "x_", "")]), (F.col("p_partkey") % 4 + 1).cast("int")), "p_brand").alias("name"))
    return named.select("p_partkey", strip_prefixes(F.col("name"), ("cbb_totals_", "cbb_")).alias("base"))


@register("normalise_sinks")
def q_normalise_sinks(spark, sf_dir):
    """The split tables and the mapping as written, with the rows counted by the writes and those read back."""
    root = scratch_folder(spark, "normalised")
    counted = write_normalised(entity_long(spark, sf_dir), crosswalk(spark, sf_dir), root, "table_id", ["entity_id"], ["totals", "advanced", "missing"], ("entity_id", "link_id"))
    back = {t: row_count(spark, f"{root}/{t}") for t in ("totals", "advanced", "missing", "mapping")}
    return counted.join(spark.createDataFrame(list(back.items()), "table_id string, n_read long"), "table_id")


@register("l1_features")
def q_l1_features(spark, sf_dir):
    _, _, beta = lasso_fit(spark, sf_dir)
    return spark.createDataFrame(selected_features(MODEL_FEATURES, beta), "feature string, coefficient double")


@register("lasso_checks")
def q_lasso_checks(spark, sf_dir):
    """Per feature, whether the fit meets the optimality conditions."""
    whole, alpha, beta = lasso_fit(spark, sf_dir)
    gradient = lasso_gradient(whole, beta)
    rows = [(c, bool(abs(g - alpha * np.sign(b)) < 1e-8 if b else abs(g) <= alpha + 1e-8))
            for c, g, b in zip(MODEL_FEATURES, gradient, beta, strict=True)]
    return spark.createDataFrame(rows, "feature string, optimal boolean")


# ------------------------------------------------------------------ PCA (M15+)

def cohort_pca(spark, sf_dir):
    return pca_analysis(cohort_frame(spark, sf_dir), "entity_id", "composite", FEATURE_PREFIXES, FEATURE_EXTRA)


@register("pca_cohort")
def q_pca_cohort(spark, sf_dir):
    """The cohort's PCA: its size, the columns chosen by the data, and whether the fit is one."""
    run = cohort_pca(spark, sf_dir)
    checks = pca_checks(run)
    return run.summary.select("n_entities", "n_train", "n_features", "feature_columns", *[F.lit(v).alias(n) for n, v in checks.items()])


@register("pca_summary")
def q_pca_summary(spark, sf_dir):
    return cohort_pca(spark, sf_dir).summary


def embedding_features(spark, sf_dir) -> tuple[DataFrame, list]:
    """All embedding dimensions as columns named by block (``b{block}_d{dim}``) with the label."""
    e = read(spark, sf_dir, "embeddings")
    names = [f"b{i // 16}_d{i % 16:02d}" for i in range(e.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


def pca_inputs(spark, sf_dir):
    df, names = embedding_features(spark, sf_dir)
    df = df.withColumn("split", split_label("vec_id"))
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    # Fit the imputer/scaler on the exploded vector (one long frame) instead of
    # 64 columns unpivoted back to long form.
    e = read(spark, sf_dir, "embeddings").filter(split_label("vec_id") == "train")
    long = e.select(F.posexplode("embedding").alias("pos", "x")).select(
        F.format_string("b%d_d%02d", F.floor(F.col("pos") / 16).cast("int"), F.col("pos") % 16).alias("column"),
        F.col("x").cast("double").alias("value"))
    params = params_table(fit_imputer_scaler_long(long))[()]
    keep = ["vec_id", "label", "split"]
    return names, apply_imputer_scaler(train, params, names, keep), apply_imputer_scaler(test, params, names, keep)


@register("pca_covariance")
def q_pca_covariance(spark, sf_dir):
    names, ztrain, _ = pca_inputs(spark, sf_dir)
    cov, _, _ = covariance_matrix(ztrain, names)
    return finish(covariance_frame(spark, names, cov))


def pca_model(spark, sf_dir):
    names, ztrain, ztest = pca_inputs(spark, sf_dir)
    return names, ztrain, ztest, fit_pca(ztrain, names)


@register("pca_fit")
def q_pca_fit(spark, sf_dir):
    _, _, _, model = pca_model(spark, sf_dir)
    return model.scree(spark)


@register("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    _, _, _, model = pca_model(spark, sf_dir)
    return model.loadings(spark)


@register("pca_corr")
def q_pca_corr(spark, sf_dir):
    _, ztrain, ztest, model = pca_model(spark, sf_dir)
    scored = model.scores(ztrain.unionByName(ztest), keep=["split", "label"])
    corr = pc_outcome_corr(scored, "split", "label", model.k)
    return pivot_report(corr, "pc", "split", "r_success", ["train", "test"])


@register("pca_top_loadings")
def q_pca_top_loadings(spark, sf_dir):
    _, _, _, model = pca_model(spark, sf_dir)
    return best_variant_per_base(model.loadings(spark), "PC1", ["b0_", "b1_", "b2_", "b3_"])


# ------------------------------------------------------------ pages

def page_id_text(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("page_id"), "html")


def all_pages(spark, sf_dir) -> DataFrame:
    """The saved pages and those rendered from orders, with text ids."""
    return page_id_text(read(spark, sf_dir, "pages")).unionByName(rendered_pages(spark, sf_dir))


TOTALS_CELLS = {"Rk": "rk", "Season": "season", "Tm": "tm", "G": "g", "MP": "mp", "MP.1": "mp_1", "FGpct": "fgpct",
                "PER": "per", "Per_Game_A_B": "a_b", "Per_Game_A_B.1": "a_b_1", "Gone": "gone"}


@register("page_tables")
def q_page_tables(spark, sf_dir):
    rows = page_tables(all_pages(spark, sf_dir), CANDIDATES)
    return rows.select("page_id", "table_id", "row_no", F.size("cells").alias("n_cells"),
                       *[F.col("cells").getItem(c).alias(n) for c, n in TOTALS_CELLS.items()])


@register("page_listing")
def q_page_listing(spark, sf_dir):
    return listing_rows(page_rows(all_pages(spark, sf_dir), ("listing",), listing=LISTING, base_url=BASE_URL))


@register("page_bios")
def q_page_bios(spark, sf_dir):
    return finish(page_bios(page_rows(all_pages(spark, sf_dir), ("status", "bio"), base_url=BASE_URL)))


def page_run(spark, sf_dir):
    spec = PanelSpec(entity="page_id", link="profile_id", stint="Tm", patch_columns=["PER"])
    return pages_to_panel(all_pages(spark, sf_dir), CANDIDATES, ["Rk", "Season", "Tm", "G", "MP", "PER"], LISTING, BASE_URL, spec)


@register("pages_panel")
def q_pages_panel(spark, sf_dir):
    panel = page_run(spark, sf_dir).panel
    return finish(panel.select("page_id", "Season", "Tm", "G", "MP", "PER", "profile_id"))


@register("pages_appearances")
def q_pages_appearances(spark, sf_dir):
    return page_run(spark, sf_dir).appearances


@register("pages_counters")
def q_pages_counters(spark, sf_dir):
    return page_run(spark, sf_dir).counters


@register("page_status")
def q_page_status(spark, sf_dir):
    return page_status(read(spark, sf_dir, "pages"))


@register("page_comments")
def q_page_comments(spark, sf_dir):
    return page_comments(read(spark, sf_dir, "pages"))


@register("page_links")
def q_page_links(spark, sf_dir):
    return page_links(read(spark, sf_dir, "pages")).select("page_id", "link_no", "href")


@register("file_round_trip")
def q_file_round_trip(spark, sf_dir):
    """Orders through the file sources and sinks: written, found again by name, read as text, counted, summarised."""
    folder = scratch_folder(spark, "files")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).otherwise("  ").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).otherwise("n/a").alias("o_orderpriority"))
    written = write_table(orders, f"{folder}/orders_1995_2003.csv", "csv")
    write_table(orders.filter("o_orderkey < 0"), f"{folder}/orders_1990_1994.csv", "csv")
    path = latest_file(spark, folder, "orders_*.csv", required=True)
    require_inputs(spark, [path])
    back = tag_literal(blank_to_null_all(read_csv_text(spark, path, with_order=False)), table_id="orders")
    write_json(back.agg(count_periods_column("o_orderpriority")), f"{folder}/summary.json")
    summary = spark.read.schema("n_periods long").json(f"{folder}/summary.json")
    missing = read_optional(spark, f"{folder}/none", "o_orderkey string")
    return back.select(
        "*", F.lit(written).alias("n_written"), F.lit(row_count(spark, path, "csv")).alias("n_read"), F.lit(range_from_name(path)).alias("n_years"),
        summary.agg(F.max("n_periods")).scalar().alias("n_priorities"), missing.agg(F.count(F.lit(1))).scalar().alias("n_missing"))


URL_PATTERN = r"/([a-z]{2})/([0-9]+)"


@register("url_id")
def q_url_id(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", url_id("url", URL_PATTERN, 1).alias("lang"),
                    url_id("url", URL_PATTERN, 2).cast("long").alias("num"))


@register("text_fields")
def q_text_fields(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    href = extract_or_null("html", r'<a href="([^"]*)"')
    return finish(p.select(
        "page_id",
        extract_or_null("html", r"<title>(.*?)</title>").alias("title"),
        href.alias("first_href"),
        url_join_col(F.col("url"), href).alias("abs_href"),
        recruiting_year(F.col("html")).alias("recruiting_year"),
        recruiting_rank(F.col("html")).alias("recruiting_rank"),
        height_inches(F.col("html")).alias("height_inches"),
        weight_lb(F.col("html")).alias("weight_lb"),
    ))


URL_TEMPLATE = "https://stats.example.org/leagues/totals_%d.html"


@register("url_template")
def q_url_template(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    span = o.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    return span.select("lo", F.posexplode(season_urls("lo", "hi", URL_TEMPLATE)).alias("i", "url")).select(
        (F.col("lo") + F.col("i")).alias("year"), "url")


@register("missing_period_profile")
def q_missing_period_profile(spark, sf_dir):
    return missing_period_profile(events_long(spark, sf_dir), "Season", "table_id", 3)


@register("profile_report")
def q_profile_report(spark, sf_dir):
    prof = doc_profiles(spark, sf_dir)
    labels = read(spark, sf_dir, "labels")
    o = read(spark, sf_dir, "orders")

    def item(section, name, value):
        return F.struct(F.lit(section).alias("section"), F.lit(name).alias("item"), value.cast("double").alias("value"))

    head = spark.range(1).select(F.explode(F.array(
        item("rows", "documents", read(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()),
        item("rows", "labels", labels.agg(F.count(F.lit(1))).scalar()),
        item("missing_pct", "quality", prof.agg(F.count_if(F.col("quality").isNull()) * 100.0 / F.count(F.lit(1))).scalar()),
        item("distinct", "label_doc_id", labels.agg(F.count_distinct("doc_id")).scalar()),
        item("range", "order_year_min", o.agg(F.min(F.year("o_orderdate"))).scalar()),
        item("range", "order_year_max", o.agg(F.max(F.year("o_orderdate"))).scalar()),
    )).alias("s")).select("s.*")
    status = value_counts(prof, "status").select(F.lit("status").alias("section"), F.col("status").alias("item"),
                                                  F.col("n").cast("double").alias("value"))
    return finish(head.unionByName(status))


# ------------------------------------- documented-only outcome variants (spec)

@register("quartile_label")
def q_quartile_label(spark, sf_dir):
    s = customer_summary(spark, sf_dir).filter(F.col("composite").isNotNull())
    return finish(quartile_label(s).select("o_custkey", "composite", "quartile"))


@register("prime_rate")
def q_prime_rate(spark, sf_dir):
    return finish(prime_rate(customer_year_panel(spark, sf_dir), CUSTOMER_SPEC))


@register("restricted_z")
def q_restricted_z(spark, sf_dir):
    s = customer_summary(spark, sf_dir)
    links = crosswalk(spark, sf_dir).select(F.col("entity_id").alias("o_custkey"), "link_id")
    linked = s.join(links, "o_custkey", "left")
    out = add_composite(linked, CUSTOMER_SPEC, restrict=F.col("link_id").isNotNull(), suffix="_r")
    return finish(out.filter(F.col("composite_r").isNotNull()).select(
        "o_custkey", "z_rate_r", "z_longevity_r", "composite_r"))
