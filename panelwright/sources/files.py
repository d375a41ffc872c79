"""File sources and sinks: text-typed CSV scans, latest-file pick, optional inputs, counted writes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwright.functions._util import qcol

# The text cells pandas' CSV reader treats as missing by default.
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv_text(spark: SparkSession, path: str, na_values=PANDAS_NA_VALUES, with_order: bool = True,
                  quoted_newlines: bool = False) -> DataFrame:
    """Header CSV with every column as text and pandas' missing markers as null.

    Types are never inferred (``2011-12`` would become a timestamp); cast with
    ``safe_numeric`` afterwards.  ``_row_ord`` records file order (path,
    start of the block in the file, position in the block) for order-dependent
    operators.  Files are split
    among tasks; ``quoted_newlines`` declares line breaks inside quoted cells,
    which make each file one task.
    """
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", quoted_newlines) \
        .option("escape", '"').csv(path)
    cols = [F.when(~qcol(c).isin(list(na_values)), qcol(c)).alias(c) for c in df.columns]
    if with_order:
        # Whatever a task packs together, rows of one block of one file keep their order in it.
        order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
        return df.select(*cols, order.alias("_row_ord"))
    return df.select(*cols)


def list_files(spark: SparkSession, directory: str, glob: str) -> list[str]:
    """Sorted file paths in ``directory`` matching ``glob`` (metadata listing only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory.rstrip("/") + "/" + glob)
    fs = path.getFileSystem(conf)
    stats = fs.globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in stats)


def latest_file(spark: SparkSession, directory: str, glob: str, required: bool = False) -> str | None:
    """The last matching file by name, or None (S3); ``required`` raises instead."""
    files = list_files(spark, directory, glob)
    if not files:
        if required:
            raise FileNotFoundError(f"no file matching {glob} in {directory}")
        return None
    return files[-1]


def range_from_name(path: str, pattern: str = r"_(\d+)_(\d+)\.\w+$") -> int | None:
    """``end - start + 1`` from two numbers in a file name, None when absent."""
    m = re.search(pattern, path.rsplit("/", 1)[-1])
    return int(m.group(2)) - int(m.group(1)) + 1 if m else None


def count_periods_column(col: str) -> Column:
    """Fallback for S4 as an aggregate: the number of distinct values of ``col``."""
    return F.count_distinct(qcol(col)).alias("n_periods")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_optional(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` or an empty relation with ``schema`` when it does not exist.

    A CSV comes with the columns and types of ``schema``; a cell that is no such value is null.
    """
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, path):
        return empty
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    found = read_csv_text(spark, path, with_order=False)
    have = set(found.columns)
    return found.select(*[(qcol(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in empty.schema.fields])


def require_inputs(spark: SparkSession, paths) -> None:
    """Raise ``FileNotFoundError`` naming the first missing input."""
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"missing required input: {p}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> int:
    """Overwrite ``path`` and return the written row count from the same job.

    The count comes from an ``Observation`` on the write, so there is no
    second pass over the data.
    """
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return int(obs.get["n"])


def row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Records in a table, 0 when it does not exist (S7; counts records, not physical lines)."""
    if not path_exists(spark, path):
        return 0
    df = read_csv_text(spark, path, with_order=False) if fmt == "csv" else spark.read.format(fmt).load(path)
    return df.count()


def write_json(df: DataFrame, path: str) -> None:
    """Metric or summary rows as JSON lines, in as many files as the frame has partitions."""
    df.write.mode("overwrite").json(path)


def text_schema(cols) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


__all__ = [
    "PANDAS_NA_VALUES", "count_periods_column", "latest_file", "list_files", "path_exists", "range_from_name",
    "read_csv_text", "read_optional", "require_inputs", "row_count", "text_schema", "write_json", "write_table",
]
