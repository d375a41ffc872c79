"""Shared helpers: column picking, per-batch text mapping, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelwright.session import materialize

ARROW = {LongType: pa.int64(), IntegerType: pa.int32(), DoubleType: pa.float64(), StringType: pa.string(), BinaryType: pa.binary(), BooleanType: pa.bool_()}

#: Text that one step of a Python task holds at a time; a longer text is a step of its own.
STEP_BYTES = 8 << 20


def col(name: str) -> Column:
    """A column by its literal name (dots and other signs are not paths)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Remainder of crc32(doc_id as text) by 3 that holds a row out of learning.
HELD_OUT = 1


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out from learning labels (a null id is not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def fresh() -> None:
    """Give back what earlier tasks of this worker left free, so that workers kept between stages do not add up."""
    gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the system; what is still in use stays."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def steps(batch: pa.RecordBatch, text_column: int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes at most."""
    sizes = pc.binary_length(batch.column(text_column)).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(df: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable[[pa.Array], list]], outputs: dict[str, DataType]) -> DataFrame:
    """One output row per input row, computed from its text alone, in Arrow batches without a shuffle.

    ``make()`` runs once per task and returns a function from an Arrow array of
    texts (null counts as empty) to one list per output column.
    Only the id and the text are read, so other columns of any name do no harm.
    """
    src = df.select(col(id_col), col(text_col))
    kind = src.schema[1].dataType
    empty = b"" if isinstance(kind, BinaryType) else ""
    schema = StructType([StructField(id_col, src.schema[0].dataType), *(StructField(n, t) for n, t in outputs.items())])
    types = [ARROW[type(t)] for t in outputs.values()]
    names = [id_col, *outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        work = make()
        for batch in batches:
            for part in steps(batch, 1):
                made = work(part.column(1).fill_null(empty))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v, t) for v, t in zip(made, types, strict=True))], names)

    return src.mapInArrow(run, schema)


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node reachable, for each node that has an edge.

    ``edges`` has long columns a and b.  Large-star and small-star steps
    alternate until nothing moves; every round is written to the shared
    checkpoint folder, so lineage stays short.  The minimum per node combines
    on the map side, and the join back is an ordinary join that adaptive
    execution splits when one node has very many neighbours.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), label)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        now = materialize(small, label)
        state = tuple(now.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
