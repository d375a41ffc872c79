"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are sorted by grid cells of width epsilon on their leading
principal axes and cut into blocks.  Pairs of sequence intervals are refined
from the whole sequence down to blocks, and a pair whose bounding boxes lie
further apart than epsilon is skipped with all that is below it.  A box has
the leading axes and, as one more, the norm of what these leave out.  What is
left is joined block by block, again by halving, with exact cosines at the
leaves; a task holds the blocks of one tile of block pairs, so a block moves
once a tile and not once a pair.  Any orthonormal axes give the same links;
good ones skip more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import col, connected_components
from panelwright.llm.links import forest
from panelwright.session import materialize

#: Vectors of a block, leaf of the recursion inside a pair of blocks, axes of cells and of boxes, rows the axes are fitted on.
BLOCK, LEAF, CELL_AXES, BOX_AXES, FIT_ROWS = 256, 64, 4, 12, 8192
#: Blocks of one partition are numbered below 2 ** PART_BITS; one step of the refinement takes FAN_BITS bits; a tile is 2 ** TILE_BITS blocks wide and high.
PART_BITS, FAN_BITS, TILE_BITS = 24, 3, 3
#: Numbers of a box: the leading axes and the norm of the rest.
BOX_DIMS = BOX_AXES + 1


def fit_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal axes (columns) by falling variance."""
    centred = vectors - vectors.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred)
    return axes[:, np.argsort(-values)]


def far_apart(a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    return float(gap @ gap) > eps * eps


def join_intervals(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, cosine: float, eps: float, out: np.ndarray) -> None:
    """Mark the linked pairs of two sequence intervals in ``out``; px and py are the vectors on the leading axes."""
    if far_apart(px, py, eps):
        return
    if len(x) <= LEAF and len(y) <= LEAF:
        out[:] = x @ y.T >= cosine
        return
    if len(x) >= len(y):
        h = len(x) // 2
        join_intervals(x[:h], y, px[:h], py, cosine, eps, out[:h])
        join_intervals(x[h:], y, px[h:], py, cosine, eps, out[h:])
    else:
        h = len(y) // 2
        join_intervals(x, y[:h], px, py[:h], cosine, eps, out[:, :h])
        join_intervals(x, y[h:], px, py[h:], cosine, eps, out[:, h:])


def near_duplicates(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of the same label and length link at a cosine of ``cosine`` or
    more in double precision.  Null or zero vectors, vectors with null or
    non-finite components, null labels and null ids link with nothing and
    stay.  Equal vectors are one class: links between copies are counted, not
    expanded.  Rows that repeat an id are vectors of their own that share it;
    they are kept or dropped alike.  Ids are integers; a text id that is none
    fails the job with CAST_INVALID_INPUT.  An empty table gives an empty
    result; other columns are not read.
    """
    eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    rows = df.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("v"), col(label_col).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("valid", valid)
    classes = rows.where("valid").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "grid-classes")

    def unit(vectors: list) -> np.ndarray:
        x = np.array(vectors, dtype=np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    place, n, drawn = F.xxhash64("label", "v"), classes.count(), FIT_ROWS * 5 // 4
    low = classes.where(place < F.lit((drawn << 64) // n - (1 << 63))) if n > drawn else classes  # what reaches the driver does not grow with the table
    sample = low.orderBy(place, "id").limit(FIT_ROWS).select("v").toPandas()["v"].tolist()
    axes: dict[int, np.ndarray] = {}
    if sample:
        sizes = [len(v) for v in sample]
        n = max(set(sizes), key=sizes.count)  # vectors of another length use their own first coordinates as axes
        axes[n] = fit_axes(unit([v for v in sample if len(v) == n]))

    def project(x: np.ndarray) -> np.ndarray:
        """Coordinates on the leading axes and the norm of the rest: no two vectors are nearer than these are."""
        if x.shape[1] in axes:
            lead = axes[x.shape[1]][:, :BOX_AXES]
            along = x @ lead
            rest = x - along @ lead.T
        else:
            along, rest = x[:, :BOX_AXES], x[:, BOX_AXES:]
        along = np.pad(along, ((0, 0), (0, max(0, BOX_AXES - along.shape[1]))))
        return np.column_stack([along, np.linalg.norm(rest, axis=1)])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0).to_pylist()
            for size in sorted({len(v) for v in vectors}):
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                x = unit([vectors[i] for i in at])
                grid = np.floor(project(x)[:, :CELL_AXES] / eps).astype(np.int64)
                part = batch.take(pa.array(at))
                made = [part.column(1), pa.array([size] * len(at), pa.int64()), *(pa.array(grid[:, k]) for k in range(CELL_AXES)), part.column(2), part.column(3), pa.array([r.tobytes() for r in x], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names)

    names = ["label", "length", *(f"c{k}" for k in range(CELL_AXES)), "id", "size", "unit"]
    grid_schema = f"label {dict(rows.dtypes)['label']}, length long, {', '.join(f'c{k} long' for k in range(CELL_AXES))}, id long, size long, unit binary"
    order = [*names[: 2 + CELL_AXES], F.xxhash64("id"), "id"]
    sequence = classes.select("v", "label", "id", "size").mapInArrow(cells, grid_schema).repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, now, held = TaskContext.get().partitionId() << PART_BITS, 0, None, []

        def block() -> pa.RecordBatch:
            x = np.stack([np.frombuffer(r[2]) for r in held])
            along = project(x)
            made = {"block": pa.array([first + n], pa.int64()), "label": pa.array([now[0]], kind), "length": pa.array([now[1]], pa.int64()), "ids": pa.array([[r[0] for r in held]], pa.list_(pa.int64())), "sizes": pa.array([[r[1] for r in held]], pa.list_(pa.int64())), "units": pa.array([x.tobytes()], pa.binary())}
            made |= {f"lo{k}": pa.array([along[:, k].min()]) for k in range(BOX_DIMS)} | {f"hi{k}": pa.array([along[:, k].max()]) for k in range(BOX_DIMS)}
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            kind = batch.schema.field(0).type
            for label, length, i, size, u in zip(*(batch.column(c).to_pylist() for c in ("label", "length", "id", "size", "unit")), strict=True):
                if held and (now != (label, length) or len(held) == BLOCK):
                    yield block()
                    n, held = n + 1, []
                now = (label, length)
                held.append((i, size, u))
        if held:
            yield block()

    box = [f"{s}{k}" for s in ("lo", "hi") for k in range(BOX_DIMS)]
    block_schema = f"block long, label {dict(rows.dtypes)['label']}, length long, ids array<long>, sizes array<long>, units binary, {', '.join(f'{b} double' for b in box)}"
    table = materialize(sequence.mapInArrow(blocks, block_schema), "grid-blocks")

    def nodes(shift: int, side: str) -> DataFrame:
        ends = [F.min(f"lo{k}").alias(f"{side}lo{k}") for k in range(BOX_DIMS)] + [F.max(f"hi{k}").alias(f"{side}hi{k}") for k in range(BOX_DIMS)]
        level = table.groupBy("label", "length", F.shiftright("block", shift).alias(f"{side}node")).agg(*ends)
        return level.withColumnsRenamed({"label": f"{side}label", "length": f"{side}length"})

    def near(shift: int, pairs: DataFrame | None) -> DataFrame:
        """Pairs of intervals of 2 ** shift block numbers whose boxes are near, below the pairs of the level above."""
        a, b = nodes(shift, "a"), nodes(shift, "b")
        same = (F.col("alabel") == F.col("blabel")) & (F.col("alength") == F.col("blength")) & (F.col("anode") <= F.col("bnode"))
        gaps = [F.greatest(F.lit(0.0), F.col(f"alo{k}") - F.col(f"bhi{k}"), F.col(f"blo{k}") - F.col(f"ahi{k}")) for k in range(BOX_DIMS)]
        close = sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps
        if pairs is not None:
            up = pairs.select(F.col("alabel").alias("plabel"), F.col("alength").alias("plength"), F.col("anode").alias("pa"), F.col("bnode").alias("pb"))
            a = a.join(up, (F.col("alabel") == F.col("plabel")) & (F.col("alength") == F.col("plength")) & (F.shiftright("anode", FAN_BITS) == F.col("pa")))
            same = same & (F.shiftright("bnode", FAN_BITS) == F.col("pb"))
        return a.join(b, same & close).select("alabel", "alength", "anode", "bnode")

    top = table.agg(F.max("block")).first()[0] or 0
    shift = -(-int(top).bit_length() // FAN_BITS) * FAN_BITS
    pairs = None
    while shift >= 0:
        pairs = materialize(near(shift, pairs), "grid-pairs")
        shift -= FAN_BITS

    def joined(one: tuple, two: tuple) -> pa.RecordBatch:
        """Link counts and a spanning forest of a pair of blocks, or of a block with itself."""
        (ia, sa, x, px), (ib, sb, y, py) = one, two
        linked = np.zeros((len(ia), len(ib)), dtype=bool)
        join_intervals(x, y, px, py, cosine, eps, linked)
        if one is two:
            linked |= linked.T
            np.fill_diagonal(linked, False)
            ids, counts, whole = ia, linked @ sa, linked
        else:
            ids, counts = np.concatenate([ia, ib]), np.concatenate([linked @ sb, sa @ linked])
            whole = np.zeros((len(ids), len(ids)), dtype=bool)
            whole[: len(ia), len(ia) :] = linked
            whole[len(ia) :, : len(ia)] = linked.T
        hit = np.flatnonzero(counts)
        edges = forest(whole)
        made_a = [*ids[hit].tolist(), *(int(ids[i]) for i, _ in edges)]
        made_b = [None] * len(hit) + [int(ids[j]) for _, j in edges]
        made_n = [*counts[hit].tolist(), *[0] * len(edges)]
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (made_a, made_b, made_n)], ["a", "b", "n"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, wanted = None, {}, []
        for batch in batches:
            for r in range(batch.num_rows):
                i, j, block, partners, block_ids, sizes, units = (batch.column(f)[r].as_py() for f in ("i", "j", "block", "partners", "ids", "sizes", "units"))
                if now != (i, j):
                    yield from (joined(held[a], held[b]) for a, b in wanted)
                    now, held, wanted = (i, j), {}, []
                x = np.frombuffer(units).reshape(len(block_ids), -1)
                held[block] = (np.array(block_ids), np.array(sizes), x, project(x))
                wanted += [(block, p) for p in partners]
        yield from (joined(held[a], held[b]) for a, b in wanted)

    # One row per tile and block in it; the first block of a pair brings its partners, at most 2 ** TILE_BITS.
    tile = [F.shiftright("anode", TILE_BITS).alias("i"), F.shiftright("bnode", TILE_BITS).alias("j")]
    ends = [F.struct(F.col("anode").alias("block"), F.col("bnode").alias("partner")), F.struct(F.col("bnode").alias("block"), F.lit(None).cast("long").alias("partner"))]
    needed = pairs.select(*tile, F.explode(F.array(*ends)).alias("e")).groupBy("i", "j", F.col("e.block").alias("block")).agg(F.collect_list("e.partner").alias("partners"))
    work = needed.join(table.select("block", "ids", "sizes", "units"), "block").repartition("i", "j").sortWithinPartitions("i", "j", "block")
    found = materialize(work.mapInArrow(verify, "a long, b long, n long"), "grid-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("b is not null").select("a", "b"), "grid-components").withColumnRenamed("node", "id")
    least = roots.join(classes.select("id", "least"), "id").groupBy("root").agg(F.min("least").alias("smallest"))
    per_class = classes.join(counts, "id", "left").join(roots.join(least, "root"), "id", "left")
    per_class = per_class.select("label", "v", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("smallest", "least").alias("component_id"))
    linked = rows.where("valid").join(per_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
