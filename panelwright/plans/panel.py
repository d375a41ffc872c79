"""Composed operators: build the wide panel (C2) and the normalised per-tag tables.

The long stat table is one DataFrame tagged by ``table_id``; splits are lazy
filters (or ``write.partitionBy(tag)`` when materialised).  Everything below
is a plan; nothing is collected except the per-tag schema pass of the split.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.assemble import left_join, left_join_spread, patch_join
from panelwright.operators.audit import summary_counters
from panelwright.operators.clean import (
    drop_repeated_headers,
    drop_spacer_rows,
    keep_period_rows,
    require_non_null,
    safe_numeric,
    split_by_tag,
)
from panelwright.operators.select import keep_first, latest_per_key
from panelwright.session import materialize
from panelwright.sources.pages import listing_rows, page_bios, page_rows, pick


@dataclass
class PanelSpec:
    """Column names of the long tables and the crosswalk."""

    entity: str = "entity_id"
    link: str = "link_id"
    tag: str = "table_id"
    period: str = "Season"
    stint: str = "Team"
    totals_tag: str = "totals"
    patch_tag: str = "advanced"
    patch_columns: list = field(default_factory=list)
    required: list = field(default_factory=lambda: ["G", "MP"])
    detail_tags: list = field(default_factory=lambda: ["totals", "per100", "advanced"])
    detail_drop: list = field(default_factory=list)
    detail_prefix: str = "cbb_"
    detail_order: list = field(default_factory=list)


def build_panel(long: DataFrame, crosswalk: DataFrame, detail_long: DataFrame | None, spec: PanelSpec,
                dedupe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """entity x period panel.

    totals rows with a period label and both required measures, left-joined
    to the crosswalk (J1), patched from the first ``patch_tag`` row per
    (entity, period) (J2), then joined on the link id (J4) to the detail
    blocks: per tag the latest-period row per link (W4), namespaced (P15) and
    assembled per link (J3).  ``dedupe`` keeps one row per (entity, period), none
    with a null key: it runs on the narrow rows, before the joins that add columns
    to a row and never rows, so its pass by these keys serves the patch as well.
    """
    totals = long.filter(qcol(spec.tag) == F.lit(spec.totals_tag))
    totals = require_non_null(keep_period_rows(totals, spec.period), spec.required)
    base = left_join(totals, crosswalk, spec.entity)
    patch = keep_period_rows(long.filter(qcol(spec.tag) == F.lit(spec.patch_tag)), spec.period)
    base = dedupe(base) if dedupe else base
    base = patch_join(base, patch, [spec.entity, spec.period], spec.patch_columns, order_by=[spec.stint], no_null_keys=dedupe is not None)
    if detail_long is None:
        return base
    # Latest row per (tag, link) for every declared tag in one pass; the
    # whole-frame fallbacks are decided per tag.
    detail = detail_long.filter(qcol(spec.tag).isin(list(spec.detail_tags)))
    picked = latest_per_key(detail, spec.link, spec.period, spec.detail_order, groups=[spec.tag])
    values = [c for c in detail_long.columns if c not in (spec.tag, spec.link, *spec.detail_drop)]
    # Widen per link in one aggregation: each (tag, column) cell comes from
    # the single picked row of that tag (J3 without chained outer joins).
    wide = picked.where(qcol(spec.link).isNotNull()).groupBy(qcol(spec.link)).agg(*[
        F.max(F.when(qcol(spec.tag) == F.lit(tid), qcol(c))).alias(f"{spec.detail_prefix}{tid}_{c}")
        for tid in spec.detail_tags for c in values
    ])
    return left_join_spread(base, wide, spec.link, [spec.entity, spec.period])


def normalise_tables(long: DataFrame, tag: str, id_cols, tags, period: str = "Season") -> dict[str, DataFrame]:
    """Per declared tag: repeated headers dropped (P4), split (P9/P10), spacer rows dropped (P5).

    Undeclared tags are ignored; a declared tag with no rows maps to ``None``.
    """
    cleaned = drop_repeated_headers(long)
    parts = split_by_tag(cleaned, tag, id_cols, tags=tags)
    return {t: (drop_spacer_rows(parts[t], period) if t in parts else None) for t in tags}


def write_normalised(long: DataFrame, mapping: DataFrame, root: str, tag: str, id_cols, tags, link: tuple[str, str], period: str = "Season") -> DataFrame:
    """Write every declared table and the mapping table under ``root``; rows ``(table_id, n_rows)`` as the writes counted them.

    The mapping holds the distinct pairs of ids that are both there (P12).  A
    declared tag without rows is not written and counts 0.
    """
    from panelwright.sources.files import write_table

    parts = normalise_tables(long, tag, id_cols, tags, period)
    counts = [(t, write_table(parts[t], f"{root}/{t}") if parts[t] is not None else 0) for t in tags]
    pairs = mapping.select(*[qcol(c) for c in link]).dropna().distinct()
    counts.append(("mapping", write_table(pairs, f"{root}/mapping")))
    return long.sparkSession.createDataFrame(counts, "table_id string, n_rows long")


def rebuild_panel(spark, long_path: str, crosswalk_path: str, detail_path: str | None, spec: PanelSpec,
                  out_path: str | None = None) -> DataFrame:
    """Rebuild the panel from saved tables (C8): missing inputs raise, the result is optionally written."""
    from panelwright.sources.files import require_inputs, write_table

    require_inputs(spark, [p for p in (long_path, crosswalk_path, detail_path) if p])
    detail = spark.read.parquet(detail_path) if detail_path else None
    panel = build_panel(spark.read.parquet(long_path), spark.read.parquet(crosswalk_path), detail, spec)
    if out_path:
        write_table(panel, out_path)
        return spark.read.parquet(out_path)
    return panel


def long_from_rows(rows: DataFrame, columns, entity_col: str, tag: str = "table_id") -> DataFrame:
    """Typed long stat table from ``page_rows`` of kind table: one row per table row, keyed by its page.

    ``columns`` are lifted out of the cell map and typed with the dataset-wide
    numeric rule.
    """
    wide = pick(rows, "table", columns)
    return safe_numeric(wide.select(F.col("page_id").alias(entity_col), F.col("name").alias(tag), "row_no", *[qcol(c) for c in columns]))


def pages_to_long(pages: DataFrame, candidates: dict, page_key: str, entity_col: str, columns,
                  tag: str = "table_id", id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Saved pages -> typed long stat table keyed by the pages' entity column."""
    keyed = pages.select(qcol(page_key).alias("page_id"), qcol(html_col).alias("html"))
    return long_from_rows(page_rows(keyed, ("table",), candidates), columns, entity_col, tag)


@dataclass
class PageRun:
    """What one run over saved pages gives."""

    long: DataFrame
    tables: dict
    profiles: DataFrame
    listing: DataFrame
    appearances: DataFrame
    panel: DataFrame
    counters: DataFrame


def pages_to_panel(pages: DataFrame, candidates: dict, columns, listing: tuple[str, str], base_url: str, spec: PanelSpec) -> PageRun:
    """Saved pages -> long table, tables by tag, profiles, listing rows, panel and run counters.

    ``pages`` has ``page_id`` (the entity) and ``html``.  Each page is read
    once and what it holds is written once; all results come from that table.
    A page that fails keeps its profile row, with its error and null fields,
    and has no table rows.  The crosswalk is the profiles' link id.
    """
    rows = materialize(page_rows(pages, ("status", "table", "listing", "bio"), candidates, listing, base_url), "page-rows")
    profiles = page_bios(rows)
    long = long_from_rows(rows, columns, spec.entity, spec.tag)
    crosswalk = profiles.filter(F.col("profile_id").isNotNull()).select(F.col("page_id").alias(spec.entity), F.col("profile_id").alias(spec.link))
    panel = build_panel(long, crosswalk, None, spec)
    listed = listing_rows(rows)
    counters = summary_counters(pages.sparkSession, {
        "n_pages": profiles,
        "n_errors": profiles.filter("status <> 'ok'"),
        "n_with_link": crosswalk,
        "n_listing_rows": pick(rows, "listing"),
        "n_long_rows": pick(rows, "table"),
        "n_panel_rows": panel,
    })
    return PageRun(long, normalise_tables(long, spec.tag, [spec.entity], list(candidates), spec.period), profiles, listed, appearances(listed, ["entity_id"], ["page_id", "row_no"]), panel, counters)


def appearances(season_list: DataFrame, keys, order_by) -> DataFrame:
    """One row per (period, entity) from the listing rows."""
    return keep_first(season_list, keys, order_by)


__all__ = ["PageRun", "PanelSpec", "appearances", "build_panel", "long_from_rows", "normalise_tables", "pages_to_long", "pages_to_panel", "rebuild_panel", "write_normalised"]
