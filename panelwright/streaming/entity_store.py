"""A stored table of entities that changes by whole buckets under commit records.

Rows lie in ``buckets`` folders by a hash of their entity.  A change reads and
writes the buckets that it touches, as new folders, and then adds one commit
record that names the folder of every bucket; readers follow the newest
record.  A change that is cut off leaves no record and so no trace, and a batch id
that a record names is not applied again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators.assemble import union_by_name
from panelwright.session import materialize


class EntityStore:
    """A table under ``root`` whose rows belong to the entities in column ``key`` (null is an entity too)."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def _bucket(self):
        return F.pmod(F.xxhash64(qcol(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def commits(self) -> list[dict]:
        """The commit records, oldest first (one small file a change)."""
        found = self._fs.globStatus(self._path("commits/*.json")) or []
        out = []
        for path in sorted((s.getPath() for s in found), key=lambda p: p.getName()):
            stream = self._fs.open(path)
            try:
                out.append(json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
        return out

    def _commit(self, number: int, record: dict) -> None:
        draft = self._path(f"commits/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        target = self._path(f"commits/{number:08d}.json")
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            raise RuntimeError(f"another change took commit {number} of {self.root}")

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        from pyspark.sql.types import StructType

        kind = StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*folders) if folders else self.spark.createDataFrame([], kind)

    def read(self, entities: DataFrame | None = None) -> DataFrame:
        """The table, or the rows of ``entities`` (a frame with the key) read from their buckets alone."""
        last = self.commits()[-1]
        if entities is None:
            return self._read(list(last["folders"].values()), last["schema"])
        some = {str(r[0]) for r in entities.select(self._bucket()).distinct().collect()}  # at most one row a bucket
        rows = self._read([f for b, f in last["folders"].items() if b in some], last["schema"])
        wanted = entities.select(qcol(self.key).alias("__key")).distinct()
        return rows.join(wanted, qcol(self.key).eqNullSafe(F.col("__key")), "left_semi")

    def apply(self, batch_id: str, updates: DataFrame, mode: str = "replace", entities: DataFrame | None = None) -> DataFrame:
        """Change the table by ``updates`` and return the entities that changed (a frame with the key).

        ``replace``: all rows of the updates' entities (or of ``entities``) go
        and the updates come.  ``backfill``: updates of entities that the table
        lacks come.  A batch id that was applied before changes nothing.
        """
        if mode not in ("replace", "backfill"):
            raise ValueError(f"unknown mode {mode!r}")
        done = self.commits()
        none = updates.select(qcol(self.key)).limit(0)
        if any(c["batch"] == batch_id for c in done):
            return none
        folders = dict(done[-1]["folders"]) if done else {}
        new = materialize(updates.withColumn("__bucket", self._bucket()), "store-updates")
        gone = materialize((entities if entities is not None else new).select(qcol(self.key)).distinct().withColumn("__bucket", self._bucket()), "store-entities")
        touched = sorted(r[0] for r in gone.select("__bucket").union(new.select("__bucket")).distinct().collect())  # at most one row a bucket
        if not touched:
            return none
        old = None
        if done:
            old = self._read([folders[str(b)] for b in touched if str(b) in folders], done[-1]["schema"]).withColumn("__bucket", self._bucket())
        if old is not None and mode == "replace":
            left = old.join(gone.select(qcol(self.key).alias("__key")), qcol(self.key).eqNullSafe(F.col("__key")), "left_anti")
            rows, changed = union_by_name([left, new]), gone
        elif old is not None:
            held = old.select(qcol(self.key).alias("__key")).distinct()
            new = materialize(new.join(held, qcol(self.key).eqNullSafe(F.col("__key")), "left_anti"), "store-backfill")
            rows, changed = union_by_name([old, new]), new.select(qcol(self.key)).distinct()
        else:
            rows, changed = new, gone
        target = f"{self.root}/data/{uuid.uuid4().hex}"
        # Rebalanced by bucket, so that a bucket with very many rows is written by several tasks.
        rows.hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(target)
        written = {s.getPath().getName().split("=")[1] for s in self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(f"{target}/__bucket=*")) or []}
        for b in map(str, touched):
            folders.pop(b, None)
            if b in written:
                folders[b] = f"{target}/__bucket={b}"
        self._commit(len(done), {"batch": batch_id, "folders": folders, "schema": rows.drop("__bucket").schema.json()})
        return changed.select(qcol(self.key))

    def rebuild(self, batch_id: str, source: EntityStore, changed: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Redo what this table holds of the changed entities from ``source``; others stay as they are."""
        changed = materialize(changed, "store-changed")
        return self.apply(batch_id, build(source.read(changed)), entities=changed)


__all__ = ["EntityStore"]
