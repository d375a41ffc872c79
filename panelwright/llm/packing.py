"""Hierarchical packing: documents go to context-size tiers, and gaps in long windows are filled from shorter ones."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from panelwright.llm.chunks import library_encoder
from panelwright.llm.common import col, fresh, give_back, steps
from panelwright.session import materialize

#: Window lengths in tokens, long to short; powers of two, so a full window of any tier needs no padding.
TIERS = (2048, 1024, 512, 256)
#: Tokens of one optimiser step; a step takes windows of one tier, from any task, that add up to this.
STEP_TOKENS = 16_384
#: Numbers of one task's windows: ids are task * TASK_IDS + number.
TASK_IDS = 1 << 40
#: Tasks whose last pieces (fewer tokens than the shortest tier each) are packed together, and the first number of such a pack.
REST_TASKS, REST_FIRST = 1024, 1 << 22
#: Bytes of text that a task encodes at a time.
STEP_TEXT = 4 << 20
#: Rows (one per task and tier) up to which the tokens before each task are broadcast.
BROADCAST_ROWS = 200_000


class TierPacker:
    """Packs pieces (length, doc, start) of one task; leftovers wait for the next batch of documents.

    A document gives whole longest windows first.  What is left of it belongs
    to the shortest tier that holds it.  Longest tier first, each window opens
    with the longest waiting piece of its tier, takes the largest shorter
    pieces that fit, and the last gap is closed by cutting a piece.  So a task
    ends with fewer waiting tokens than the shortest tier holds; ``finish``
    lays them out in windows of exact powers of two.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.longest = tiers, tiers[0]
        self.waiting: list[tuple] = []  # sorted by length
        self.held = self.windows = 0
        self.filled = [0] * (len(tiers) + 1)  # tokens per tier; windows below the shortest tier come last
        self.out: list[tuple] = []

    def add(self, doc: int, n: int) -> None:
        at = 0
        while n - at >= self.longest:
            self._emit([(self.longest, doc, at)], self.longest)
            at += self.longest
        if n > at:
            self.wait((n - at, doc, at))

    def wait(self, piece: tuple) -> None:
        insort(self.waiting, piece)
        self.held += piece[0]

    def _take(self, i: int) -> tuple:
        piece = self.waiting.pop(i)
        self.held -= piece[0]
        return piece

    def _emit(self, pieces: list[tuple], size: int) -> None:
        lane = self.tiers.index(size) if size in self.tiers else len(self.tiers)
        at = 0
        for length, doc, start in pieces:
            self.out.append((doc, start, length, self.windows, at, size, lane, self.filled[lane]))
            at += length
        self.filled[lane] += size
        self.windows += 1

    def _window(self, size: int) -> None:
        """One full window from the waiting pieces, which hold at least ``size`` tokens."""
        gap, pieces = size, []
        while gap and self.waiting:
            fits = bisect_right(self.waiting, (gap, 1 << 62, 0))
            if fits:
                piece = self._take(fits - 1)
            else:
                length, doc, start = self._take(0)
                piece = (gap, doc, start)
                self.wait((length - gap, doc, start + gap))
            pieces.append(piece)
            gap -= piece[0]
        self._emit(pieces, size)

    def _made(self) -> list[tuple]:
        made, self.out = self.out, []
        return made

    def pack(self) -> list[tuple]:
        """The pieces of all windows that can be filled."""
        for size, shorter in zip(self.tiers, [*self.tiers[1:], 0], strict=True):
            while self.held >= size and bisect_left(self.waiting, (shorter + 1, -1, 0)) < len(self.waiting):
                self._window(size)
        return self._made()

    def leave(self) -> list[tuple]:
        """The waiting pieces themselves, in no window."""
        left, self.waiting, self.held = self.waiting, [], 0
        return [(doc, start, length, None, None, None, None, None) for length, doc, start in left]

    def finish(self) -> list[tuple]:
        """The waiting pieces in windows of powers of two."""
        while self.held:
            self._window(1 << (self.held.bit_length() - 1))
        return self._made()


NUMBERS = ["doc_tokens", "task", "window", "offset", "sequence_length", "lane", "before"]


def piece_rows(made: list[tuple], docs: dict[int, tuple], task: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Arrow rows of packed pieces; ``docs`` has (id, ids from ``base`` on, base, tokens of the document)."""
    for i in range(0, len(made), 4096):
        doc, start, length, *place = zip(*made[i : i + 4096], strict=True)
        held = [docs[d] for d in doc]
        ids = [raw[4 * (a - base) : 4 * (a - base + n)] for (_, raw, base, _), a, n in zip(held, start, length, strict=True)]
        numbers = [[h[3] for h in held], [task] * len(doc), *place]
        yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], kind), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), *(pa.array(n, pa.int64()) for n in numbers)], ["id", "start", "length", "ids", *NUMBERS])


def pack_documents(df: DataFrame, path: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (binary uint32), doc_tokens, sequence_id, offset, sequence_length, step_group.

    Each task encodes and packs its own documents and holds one batch and its
    waiting pieces.  What waits at a task's end (fewer tokens than the
    shortest tier) is packed together with that of up to ``REST_TASKS`` tasks;
    only there windows below the shortest tier arise, in powers of two.
    ``sequence_length`` is the window's size.  Step groups hold windows of one
    tier over all tasks: a tier's windows are laid in a row by task and
    number, and cut every ``STEP_TOKENS`` tokens, so all groups of a tier but
    the last are equal, however the table is split; windows below the shortest
    tier have groups of their own.  Null and empty texts hold the end id
    only; repeated rows are packed each; a very long text is encoded by
    itself, whole; an empty table gives no piece; other columns are not read.
    """
    src = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    schema = StructType([StructField("id", src.schema[0].dataType), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()), *(StructField(n, LongType()) for n in NUMBERS)])

    def encode_and_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        encoder, packer, task = library_encoder(path), TierPacker(tiers), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        docs: dict[int, tuple] = {}
        n_docs, kind = 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in steps(batch, 1, STEP_TEXT):
                texts = encoder.encode(part.column(1).fill_null(""))
                for doc_id, ids in zip(part.column(0).to_pylist(), texts, strict=True):
                    docs[n_docs] = (doc_id, ids + end, 0, len(ids) // 4 + 1)
                    packer.add(n_docs, len(ids) // 4 + 1)
                    n_docs += 1
                del texts
                yield from piece_rows(packer.pack(), docs, task, kind)
                docs = {d: docs[d] for _, d, _ in packer.waiting}
            give_back()
        yield from piece_rows(packer.leave(), docs, task, kind)

    def pack_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer, docs, kind = None, TierPacker(tiers), {}, None

        def close() -> Iterator[pa.RecordBatch]:
            yield from piece_rows([*packer.pack(), *packer.finish()], docs, REST_FIRST + now, kind)

        for batch in batches:
            kind = batch.schema.field(1).type
            for block, doc_id, start, length, ids, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and block != now:
                    yield from close()
                    packer, docs = TierPacker(tiers), {}
                now = block
                packer.wait((length, len(docs), start))
                docs[len(docs)] = (doc_id, ids, start, total)
        if now is not None:
            yield from close()

    first = materialize(src.mapInArrow(encode_and_pack, schema), "packing-windows")
    left = first.where("window is null").select(F.floor(F.col("task") / REST_TASKS).alias("block"), "id", "start", "length", "ids", "doc_tokens")
    rest = materialize(left.repartition("block").sortWithinPartitions("block", "id", "start", "ids").mapInArrow(pack_rest, schema), "packing-rest")
    windows = first.where("window is not null").unionByName(rest)

    tokens = windows.groupBy("task", "lane").agg(F.max(F.col("before") + F.col("sequence_length")).alias("tokens"))  # one row per task and tier
    earlier = Window.partitionBy("lane").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(tokens.select("task", "lane", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before")), "packing-steps")
    side = F.broadcast(offsets) if offsets.count() <= BROADCAST_ROWS else offsets
    group = F.floor((F.col("tokens_before") + F.col("before")) / STEP_TOKENS) * (len(tiers) + 1) + F.col("lane")
    sequence = F.col("task") * TASK_IDS + F.col("window")
    return windows.join(side, ["task", "lane"]).select(F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens", sequence.alias("sequence_id"), "offset", "sequence_length", group.alias("step_group"))
