"""Cleaning and reshaping: names, header/spacer rows, all-null columns, tag splits, numeric typing.

The two data-dependent schema steps (all-null column drop, numeric typing)
each cost one aggregation pass whose result is one row; the decision is made
from that row and the data itself never leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelwright.functions import blank_to_null, is_period_label, to_number
from panelwright.functions._util import qcol

# Label columns that numeric typing leaves as text, and the
# header cells whose repetition marks a repeated header row.
LABEL_COLUMNS = ("Player", "Season", "Tm", "Team", "Pos", "Lg", "Awards")
HEADER_MARKERS = ("Rk", "Player")


def flatten_name(parts) -> str:
    """Join multi-level header parts with ``_``, skipping missing parts."""
    if isinstance(parts, str):
        return parts
    kept = [str(p) for p in parts if p is not None and str(p) != "nan"]
    return "_".join(kept).strip("_")


def normalise_name(name: str) -> str:
    """strip; ``%`` -> ``pct``, ``/`` -> ``_``, space -> ``_``."""
    return name.strip().replace("%", "pct").replace("/", "_").replace(" ", "_")


def normalise_names(df: DataFrame) -> DataFrame:
    """Drop ``Unnamed`` columns (P3) and normalise the rest."""
    keep = [c for c in df.columns if not c.startswith("Unnamed")]
    return df.select(*[qcol(c).alias(normalise_name(c)) for c in keep])


def drop_repeated_headers(df: DataFrame, markers=HEADER_MARKERS) -> DataFrame:
    """Remove rows that repeat the header (``Rk == 'Rk'``); null cells are kept."""
    out = df
    for m in markers:
        if m in out.columns:
            out = out.filter(~qcol(m).cast("string").eqNullSafe(F.lit(m)))
    return out


def _strip(c):
    return F.regexp_replace(qcol(c).cast("string"), r"^\s+|\s+$", "")


def drop_spacer_rows(df: DataFrame, period: str = "Season") -> DataFrame:
    """Drop rows whose period is null, blank or the text ``nan`` (P5); no-op without the column."""
    if period not in df.columns:
        return df
    s = _strip(period)
    return df.filter(qcol(period).isNotNull() & ~s.isin("", "nan"))


def keep_period_rows(df: DataFrame, period: str = "Season") -> DataFrame:
    """Keep ``YYYY-YY`` rows only."""
    if period not in df.columns:
        return df
    return df.filter(is_period_label(period))


def require_non_null(df: DataFrame, cols) -> DataFrame:
    """Drop rows lacking any of ``cols`` when all are present."""
    if not all(c in df.columns for c in cols):
        return df
    return df.dropna(subset=list(cols))


def non_null_counts(df: DataFrame, cols=None) -> dict:
    """Non-null count per column and the row count, from one aggregation pass."""
    cols = list(cols or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(qcol(c)).alias(f"c{i}") for i, c in enumerate(cols)],
    ).first()
    return {"__rows__": row["__n"], **{c: row[f"c{i}"] for i, c in enumerate(cols)}}


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value (P8); an empty frame is returned unchanged."""
    counts = non_null_counts(df)
    if counts["__rows__"] == 0:
        return df
    return df.select(*[qcol(c) for c in df.columns if counts[c] > 0])


def split_by_tag(df: DataFrame, tag: str, id_cols, tags=None) -> dict[str, DataFrame]:
    """One frame per tag value, tag dropped, all-null columns dropped, ids first then sorted.

    One grouped pass counts non-nulls per (tag, column); its output has one
    row per distinct tag, so it stays small.  The frames are lazy filters.
    """
    if tag not in df.columns:
        return {}
    src = df.filter(qcol(tag).isNotNull())
    if tags is not None:
        src = src.filter(qcol(tag).cast("string").isin(list(tags)))
    others = [c for c in df.columns if c != tag]
    stats = src.groupBy(qcol(tag).cast("string").alias("__t")).agg(
        *[F.count(qcol(c)).alias(f"c{i}") for i, c in enumerate(others)]
    ).collect()
    out = {}
    for row in stats:
        kept = [c for i, c in enumerate(others) if row[f"c{i}"] > 0]
        ordered = [c for c in id_cols if c in kept] + sorted(c for c in kept if c not in id_cols)
        part = src.filter(qcol(tag).cast("string") == F.lit(row["__t"]))
        out[row["__t"]] = part.select(*[qcol(c) for c in ordered])
    return out


def tag_schema(df: DataFrame, tag: str, id_cols) -> DataFrame:
    """The split as a table: ``(tag, n_rows, columns)`` with the kept column list joined by commas."""
    others = [c for c in df.columns if c != tag]
    stats = df.filter(qcol(tag).isNotNull()).groupBy(qcol(tag).cast("string").alias(tag)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(qcol(c)).alias(f"__c{i}") for i, c in enumerate(others)],
    )
    ordered = [c for c in id_cols if c in others] + sorted(c for c in others if c not in id_cols)
    pieces = [F.when(F.col(f"__c{others.index(c)}") > 0, F.lit(c)) for c in ordered]
    return stats.select(qcol(tag), "n_rows", F.concat_ws(",", *pieces).alias("columns"))


def project_with_optional(df: DataFrame, cols, optional_types: dict) -> DataFrame:
    """Select ``cols``; any listed in ``optional_types`` but absent is created as typed null."""
    out = []
    for c in cols:
        if c in df.columns:
            out.append(qcol(c))
        elif c in optional_types:
            out.append(F.lit(None).cast(optional_types[c]).alias(c))
        else:
            raise KeyError(f"missing column: {c}")
    return df.select(*out)


def failure_log(df: DataFrame, status: str, id_col: str, url_col: str, error_col: str,
                error_value: str = "error") -> DataFrame:
    """Rows whose status is ``error`` as ``(entity_id, entity_url, error)``."""
    return df.filter(qcol(status) == F.lit(error_value)).select(
        qcol(id_col).alias("entity_id"), qcol(url_col).alias("entity_url"), qcol(error_col).alias("error")
    )


def prefix_columns(df: DataFrame, prefix: str, key: str, drop=()) -> DataFrame:
    """Namespace every column but ``key`` with ``prefix`` and drop ``drop``."""
    return df.select(
        qcol(key), *[qcol(c).alias(f"{prefix}{c}") for c in df.columns if c != key and c not in drop]
    )


def tag_literal(df: DataFrame, **values) -> DataFrame:
    """Constant id columns placed first."""
    lits = [F.lit(v).alias(k) for k, v in values.items()]
    return df.select(*lits, *[qcol(c) for c in df.columns if c not in values])


def safe_numeric(df: DataFrame, exclude=LABEL_COLUMNS) -> DataFrame:
    """Type text columns as double when any value parses as a number.

    One pass counts parseable values per text column; columns with none stay
    text.  The decision is dataset-wide (the reference decides per page table).
    """
    text_cols = [f.name for f in df.schema.fields
                 if isinstance(f.dataType, StringType) and f.name not in exclude]
    if not text_cols:
        return df
    row = df.agg(*[F.count(to_number(qcol(c))).alias(f"c{i}") for i, c in enumerate(text_cols)]).first()
    numeric = {c for i, c in enumerate(text_cols) if row[f"c{i}"] > 0}
    return df.select(*[to_number(qcol(c)).alias(c) if c in numeric else qcol(c) for c in df.columns])


def blank_to_null_all(df: DataFrame) -> DataFrame:
    """Whitespace-only text cells become null in every string column."""
    return df.select(*[
        blank_to_null(qcol(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else qcol(f.name)
        for f in df.schema.fields
    ])


__all__ = [
    "HEADER_MARKERS", "LABEL_COLUMNS", "blank_to_null_all", "drop_all_null_columns",
    "drop_repeated_headers", "drop_spacer_rows", "failure_log", "flatten_name", "keep_period_rows",
    "non_null_counts", "normalise_name", "normalise_names", "prefix_columns", "project_with_optional",
    "require_non_null", "safe_numeric", "split_by_tag", "tag_literal", "tag_schema",
]
