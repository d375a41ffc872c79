"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (runtime re-planning, partition
# coalescing, skew splitting, runtime-size-checked broadcast), UTC session time,
# Arrow for the few pandas batches, and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Local runs only: the driver JVM is the whole "cluster", give it room.
LOCAL_CONF = {"spark.driver.memory": "16g"}


def get_session(
    app: str = "panelwright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the submit configuration wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_CONF.items():
                builder = builder.config(k, v)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local master, where driver and
    executors are one process, gets a private folder when it is unset; on a
    cluster a missing setting is an error, since executors would write to
    their own disks.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            path = None
    if not path and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="panelwright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder for intermediate files; :func:`drop_scratch` removes it."""
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of an expensive intermediate that several branches
    reuse; the written files outlive any executor, so a lost executor costs
    only its running tasks, and the read-back plan gets parquet pruning and
    pushdown.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Scratch tables written by this process, per application, for drop_scratch().
_SCRATCH: dict[str, list[str]] = {}


_DROPS: dict[str, int] = {}


def scratch_generation(spark: SparkSession) -> tuple[str, int]:
    """Names the scratch tables that are there: it changes with the application and whenever tables are dropped."""
    app = spark.sparkContext.applicationId
    return app, _DROPS.get(app, 0)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this application wrote with :func:`materialize`.

    Call once the frames that read them are no longer needed (end of a job).
    Returns the number of tables removed.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    app, drops = scratch_generation(spark)
    _DROPS[app] = drops + 1
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp) and fs.delete(hp, True):
            removed += 1
    return removed


__all__ = ["get_session", "checkpoint_dir", "scratch_folder", "scratch_path", "materialize", "drop_scratch", "DEFAULT_CONF"]
