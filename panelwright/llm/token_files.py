"""Token ids in fixed-width bit-packed files with random access.

A file holds 64 ids in as many 64-bit words as an id has bits, so packing and
unpacking are a few numpy operations per bit lane.  Layout, little-endian:

    payload   blocks of BLOCK_IDS ids (the last one padded to 64 ids)
    offsets   uint64, byte offset of every block and of the end
    docs      int64 ids, uint8 null marks, uint64 first position of every document and of the end
    trailer   8 bytes magic, then uint64: bits, ids, documents, blocks
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.chunks import library_encoder
from panelwright.llm.common import col, fresh, steps
from panelwright.session import materialize, scratch_path

MAGIC = b"PWTOKEN1"
TRAILER = struct.Struct("<8sQQQQ")
#: Ids of one block; a random read touches whole blocks.
BLOCK_IDS = 1 << 16


def bits_for(largest: int) -> int:
    """The fewest bits that hold every id up to ``largest``."""
    return max(1, int(largest).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError("an id does not fit the vocabulary's width")
    lanes = np.zeros((-(-len(ids) // 64), 64), dtype=np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), dtype="<u8")
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack_bits(raw: bytes, bits: int, n: int) -> np.ndarray:
    words = np.frombuffer(raw, dtype="<u8").reshape(-1, bits)
    lanes, mask = np.empty((len(words), 64), dtype=np.uint64), np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = x & mask
    return lanes.reshape(-1)[:n].astype("<u4")


@lru_cache(maxsize=1)
def store(uri: str):
    """(file system, path) of a folder URI; any store that pyarrow opens."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class FileWriter:
    """Collects ids into blocks and writes them as they fill; documents may run over blocks."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.offsets, self.docs, self.nulls, self.starts = [0], [], [], [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 16 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, dtype="<u4")
        end = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, end, BLOCK_IDS):
            raw = pack_bits(ids[i : min(i + BLOCK_IDS, end)], self.bits)
            self.out.write(raw)
            self.offsets.append(self.offsets[-1] + len(raw))
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.out.write(np.array(self.docs, dtype="<i8").tobytes() + np.array(self.nulls, dtype=np.uint8).tobytes())
        self.out.write(np.array(self.starts, dtype="<u8").tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, self.n_ids, len(self.docs), len(self.offsets) - 1))


class FileReader:
    """Random access to one file: ``ids(a, b)`` reads only the blocks that hold positions a to b."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, self.bits, self.n_ids, n_docs, n_blocks = TRAILER.unpack(source.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        footer = 8 * (n_blocks + 1) + 9 * n_docs + 8 * (n_docs + 1)
        raw = source.read_at(footer, size - TRAILER.size - footer)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1)
        at = 8 * (n_blocks + 1)
        self.docs = np.frombuffer(raw, "<i8", n_docs, at)
        self.nulls = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs)
        self.starts = np.frombuffer(raw, "<u8", n_docs + 1, at + 9 * n_docs)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, dtype="<u4")
        first, last = a // BLOCK_IDS, (b - 1) // BLOCK_IDS
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        n = min(self.n_ids - first * BLOCK_IDS, (last + 1 - first) * BLOCK_IDS)
        return unpack_bits(self.source.read_at(hi - lo, lo), self.bits, n)[a - first * BLOCK_IDS : b - first * BLOCK_IDS]


def write_token_files(df: DataFrame, path: str, out_uri: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id`` to each and write the files; returns the manifest.

    The manifest has one row per file: name, n_docs, n_ids and ``start`` (ids
    in all files before it).  Files follow ascending ids (null ids first;
    equal ids by a hash of the text and then the text, so one id with very many rows is
    spread too).  Each task writes under a name of its own attempt and renames
    it when complete, so a repeated task replaces the same content.  Null and
    empty texts hold the end id only; an empty table gives an empty manifest.
    Ids are integers; a text id that is none fails the job with
    CAST_INVALID_INPUT.  A very long text is encoded by itself, whole.
    """
    spark = df.sparkSession
    uri = out_uri or scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    src = df.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        encoder = library_encoder(path)
        bits = bits_for(max(encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id))
        task = TaskContext.get()
        writer = None
        tail = np.array([end_id], dtype="<u4")
        for batch in batches:
            for part in steps(batch, 1):
                if writer is None:
                    target, folder = store(uri)
                    target.create_dir(folder)
                    name, temp = f"part-{task.partitionId():06d}.bin", f"{folder}/.attempt-{task.taskAttemptId()}"
                    out = target.open_output_stream(temp)
                    writer = FileWriter(out, bits)
                made = encoder.encode(part.column(1).fill_null(""))
                for doc_id, ids in zip(part.column(0).to_pylist(), made, strict=True):
                    writer.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), tail]))
        if writer is not None:
            writer.close()
            out.close()
            target.move(temp, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})

    files = src.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(write, "file string, n_docs long, n_ids long")
    files = materialize(files, "token-manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.select(F.lit(uri).alias("uri"), "*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """All documents of the files: id, ``start`` (ids of all documents before it) and ``ids`` (uint32, little-endian)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, name, before in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                source, folder = store(uri)
                with source.open_input_file(f"{folder}/{name}") as f:
                    reader = FileReader(f)
                    starts, n_docs = reader.starts.astype(np.int64), len(reader.docs)
                    a = 0
                    while a < n_docs:
                        b = max(a + 1, int(np.searchsorted(starts, starts[a] + 16 * BLOCK_IDS, side="right")) - 1)
                        raw, cut = reader.ids(int(starts[a]), int(starts[b])).tobytes(), (4 * (starts[a : b + 1] - starts[a])).tolist()
                        yield pa.RecordBatch.from_arrays([pa.array(reader.docs[a:b], pa.int64(), mask=reader.nulls[a:b].astype(bool)), pa.array(starts[a:b] + before), pa.array([raw[x:y] for x, y in zip(cut, cut[1:], strict=False)], pa.binary())], ["doc_id", "start", "ids"])
                        a = b

    spark: SparkSession = manifest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("uri", "file", "start").repartition(n).mapInArrow(read, "doc_id long, start long, ids binary")
