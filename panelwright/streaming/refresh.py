"""Replace-by-key refresh of a stored table, per batch or per streaming micro-batch.

The table lives in versioned folders ``<root>/v=<n>``; each refresh reads the
latest version, replaces the rows whose key arrives in the update (C6), and
writes the next version, so a path is never overwritten while it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelwright.operators.assemble import replace_by_key
from panelwright.sources.files import list_files, path_exists, write_table

_VERSION = re.compile(r"/v=(\d+)/?$")


def latest_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(number, path) of the newest finished ``v=<n>`` folder under ``root``; (-1, None) when there is none."""
    best = (-1, None)
    for p in list_files(spark, root, "v=*"):
        m = _VERSION.search(p)
        if m and int(m.group(1)) > best[0] and path_exists(spark, f"{p}/_SUCCESS"):
            best = (int(m.group(1)), p)
    return best


def applied(spark: SparkSession, root: str, batch_id) -> bool:
    """Whether a finished version holds the batch already."""
    return any(path_exists(spark, f"{p.rsplit('/', 2)[0]}/_SUCCESS") for p in list_files(spark, root, f"v=*/_batches/{batch_id}"))


def refresh(spark: SparkSession, root: str, updates: DataFrame, key: str, batch_id=None) -> tuple[str, int]:
    """Write the next version with ``updates`` replacing rows that share its keys; returns (path, rows).

    A batch id that an earlier version holds is not applied again (rows -1).
    """
    n, path = latest_version(spark, root)
    if batch_id is not None and path is not None and applied(spark, root, batch_id):
        return path, -1
    merged = updates if path is None else replace_by_key(spark.read.parquet(path), updates, key)
    target = f"{root.rstrip('/')}/v={n + 1}"
    rows = write_table(merged, target)
    if batch_id is not None:
        mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/_batches/{batch_id}")
        mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()
    return target, rows


def stream_refresh(updates_stream: DataFrame, root: str, key: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Apply :func:`refresh` to every micro-batch of a streaming source (``foreachBatch``)."""
    spark = updates_stream.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            refresh(spark, root, batch, key, batch_id)

    writer = updates_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


__all__ = ["applied", "latest_version", "refresh", "stream_refresh"]
