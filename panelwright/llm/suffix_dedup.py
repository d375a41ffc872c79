"""Repeated byte strings across a corpus, by merging shard Burrows-Wheeler transforms.

Every window of ``length`` bytes belongs to the smallest hash of its
``SEED``-byte strings.  Neighbouring windows with the same smallest string
form a segment, and equal windows lie in segments of equal seed, so seeds deal
the work out and a seed that occurs once rules its segments out; so does a
segment that shares neither the bytes left of its seed nor those right of it
with another one, since no window of it can.  Equal segments fall together early.  The different segments of a seed are
concatenated into shards whose transforms are merged by refining their
interleave several characters at a time; the refinement's block borders give
the common prefixes, and a block that is never split holds a repeated string.
Suffixes are sorted once, inside their shard.

A seed whose different segments hold more than ``HOT_BYTES`` is dealt again,
window by window, by the hash of the whole window: equal windows still meet, a
window that occurs once is ruled out, and no merge holds the whole seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from panelwright.llm.common import STEP_BYTES, col, fresh, steps
from panelwright.session import materialize

#: Bytes of a string that counts as repeated, bytes of a seed, and positions worked on at a time.
LENGTH, SEED, CHUNK = 100, 16, 1 << 16
#: Bytes of segments that one merge works on (the segments of a seed that is not hot stay together).
MERGE_BYTES = 1 << 17
#: Bytes of different segments that make a seed hot, and windows that a task folds before it hands them on.
HOT_BYTES, FOLD_WINDOWS = 1 << 20, 1 << 16
#: Different segments of a seed that are looked at together to rule out those that can share no window.
FLANK_SEGMENTS = 1 << 16


def loads(buf: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes at each of the first n offsets as one number."""
    return np.ndarray((n,), dtype="<u8", buffer=buf.data, strides=(1,)).astype(np.uint64)


def seed_hashes(buf: np.ndarray) -> np.ndarray:
    n = len(buf) - SEED + 1
    h = (loads(buf, n) * np.uint64(0x9E3779B97F4A7C15)) ^ (loads(buf[8:], n) * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def segments(buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, seed hash, where the seed lies) of the segments of one text."""
    windows, width = len(buf) - length + 1, length - SEED + 1
    at_all, seed_all = [], []
    for a in range(0, windows, CHUNK):
        b = min(a + CHUNK, windows)
        h = seed_hashes(buf[a : b + length - 1])
        low = (h & ~np.uint64(0x3FFFF)) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[: b - a], low[width - span : width - span + b - a])
        at = (low & np.uint64(0x3FFFF)).astype(np.int64)
        at_all.append(at + a)
        seed_all.append(h[at])
    at, seed = np.concatenate(at_all), np.concatenate(seed_all)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, windows)), seed[first].view(np.int64), at[first]


def flank_hashes(buf: np.ndarray, at: np.ndarray, size: int, there: np.ndarray) -> np.ndarray:
    """32 bits of the ``size`` bytes at each place, 0 where they are not ``there``."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))  # a view: only the places asked for are copied
    at = np.where(there, at, 0)
    h = np.full(len(at), size, dtype=np.uint64)
    for k in [*range(0, size - 7, 8), max(size - 8, 0)]:
        word = words[np.minimum(at + k, len(buf))]
        if size < 8:
            word = word & np.uint64((1 << (8 * size)) - 1)
        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.where(there, (h & np.uint64(0xFFFFFFFF)) | np.uint64(1), np.uint64(0))


def shared_flanks(group: np.ndarray, flanks: np.ndarray) -> np.ndarray:
    """Which rows share the bytes left of the seed, or those right of it, with another row of their group."""
    out = np.zeros(len(group), dtype=bool)
    for side in (flanks.view(np.uint64) >> np.uint64(32), flanks.view(np.uint64) & np.uint64(0xFFFFFFFF)):
        order = np.lexsort((side, group))
        same = (group[order][1:] == group[order][:-1]) & (side[order][1:] == side[order][:-1]) & (side[order][1:] > 0)
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a shard by its first ``depth`` symbols or more, by doubling."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray((len(text),), dtype=">u8", buffer=padded.data, strides=(1,)).astype(np.uint64)
    known = 8
    while True:
        order = np.argsort(key)
        if known >= depth:
            return order
        key = key[order]
        rank = np.empty(len(text), dtype=np.uint64)
        rank[order] = np.cumsum(np.concatenate([[1], key[1:] != key[:-1]])).astype(np.uint64)
        if rank[order[-1]] == len(text):
            return order
        after = np.zeros(len(text), dtype=np.uint64)
        after[:-known] = rank[known:] if known < len(text) else 0
        key = (rank << np.uint64(32)) | after
        known *= 2


class Shard:
    """Concatenated segments with their suffix order; ``rows`` gives their Burrows-Wheeler transform, several symbols a row."""

    def __init__(self, strings: list[bytes], depth: int):
        sizes = np.array([len(s) + 1 for s in strings])
        self.end = np.cumsum(sizes) - 1
        self.start = self.end - sizes + 1
        self.text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)  # 0xFF, in no UTF-8, becomes 0
        self.order = sort_suffixes(self.text, depth)
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)])
        self.heads = np.ndarray((len(self.text),), dtype=">u8", buffer=padded.data, strides=(1,))[self.order].astype(np.uint64)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[self.order]

    def alphabet(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct strings of ``q`` symbols (sorted), and which of them each suffix starts with, along the order."""
        codes = self.heads >> np.uint64(8 * (8 - q))
        new = np.concatenate([[True], codes[1:] != codes[:-1]])
        return codes[new], np.cumsum(new) - 1

    def rows(self, q: int, names: np.ndarray) -> np.ndarray:
        """For each suffix in order the ``q`` symbols before it (around its own string's end), as their place in ``names``."""
        own, which = self.alphabet(q)
        code_at = np.empty(len(self.text), dtype=np.uint64)
        code_at[self.order] = np.searchsorted(names, own).astype(np.uint64)[which]
        back = self.order - q
        start = self.start[self.owner]
        return code_at[np.where(back < start, back + self.end[self.owner] - start + 1, back)]


def merge(a: Shard, b: Shard, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(from b, block) along the merged suffix order; suffixes of one block share their first ``depth`` symbols.

    Each refinement puts eight more symbols before what the order knows (the
    last one what is missing): a stable sort of the interleave by the symbols
    before each suffix.  Suffixes of one shard never change their order.
    """
    n = len(a.text) + len(b.text)
    from_b = np.zeros(n, dtype=bool)
    from_b[len(a.text) :] = True
    block, row, at = np.zeros(n, dtype=np.int32), np.empty(n, dtype=np.uint64), np.arange(n, dtype=np.uint64)
    for q, times in ((8, depth // 8), (depth % 8, 1)):
        if not q:
            continue
        names = np.unique(np.concatenate([a.alphabet(q)[0], b.alphabet(q)[0]]))
        from_a, from_other = a.rows(q, names) << np.uint64(32), b.rows(q, names) << np.uint64(32)
        for _ in range(times):
            row[from_b], row[~from_b] = from_other, from_a
            key = np.sort(row | at)  # the place now breaks ties, so the sort is stable
            step = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            key >>= np.uint64(32)
            from_b, block = from_b[step], block[step]
            border = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
            block[0] = 0
            np.cumsum(border, out=block[1:])
    return from_b, block


def repeated_windows(strings: list[bytes], base: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows whose bytes also start at a smaller position; ``base`` orders the strings' first bytes."""
    half = len(strings) // 2  # a seed never comes with one segment only
    a, b = Shard(strings[:half], length), Shard(strings[half:], length)
    from_b, block = merge(a, b, length)
    where = np.empty(len(block), dtype=np.int64)
    where[~from_b], where[from_b] = a.order, b.order + len(a.text)
    start, end = np.concatenate([a.start, b.start + len(a.text)]), np.concatenate([a.end, b.end + len(a.text)])
    owner = np.empty(len(block), dtype=np.int64)
    owner[~from_b], owner[from_b] = a.owner, b.owner + len(a.start)
    offset = where - start[owner]
    whole = where + length <= end[owner]  # only these suffixes are windows
    owner, offset, block = owner[whole], offset[whole], block[whole]
    if not len(block):
        return owner, offset
    place = base[owner] + offset
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    least = np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(block))))
    late = place > least
    return owner[late], offset[late]


def late_runs(uid: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows as runs (uid, start, n) of neighbours."""
    order = np.lexsort((start, uid))
    uid, start = uid[order], start[order]
    head = np.flatnonzero(np.concatenate([[True], (uid[1:] != uid[:-1]) | (start[1:] != start[:-1] + 1)])) if len(uid) else order
    n = np.diff(np.append(head, len(uid)))
    return pa.RecordBatch.from_arrays([pa.array(uid[head]), pa.array(start[head]), pa.array(n, pa.int64())], ["uid", "start", "n"])


def merge_held(held: list[tuple], length: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The repeated windows of the (uid, start, bytes) held, as runs, and which string each lies in."""
    uid, start = (np.array([h[k] for h in held], dtype=np.int64) for k in (0, 1))
    rank = np.unique(uid, return_inverse=True)[1].astype(np.int64)
    span = int(start.max()) + max(len(h[2]) for h in held) + 1
    owner, offset = repeated_windows([h[2] for h in held], rank * span + start, length)
    return late_runs(uid[owner], start[owner] + offset), owner


SPAN = ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())]))
SPANS = "uid long, start long, n long"


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(uid, start, n): runs of n windows from byte ``start`` whose strings also start earlier.  ``docs``: distinct uid, text as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for batch in batches:
            for part in steps(batch, 1):
                cols: list[list] = [[], [], [], [], []]
                digests: list[bytes] = []
                raws: list[bytes] = []
                at_byte = 0
                for uid, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if raw is None or len(raw) < length:
                        continue
                    first, n, seed, at = segments(np.frombuffer(raw, np.uint8), length)
                    for out, x in zip(cols, (seed, np.full(len(first), uid), first, n, np.stack([at, np.full(len(at), at_byte)])), strict=True):
                        out.append(x)
                    raws.append(raw)
                    at_byte += len(raw)
                    view, digest = memoryview(raw), xxhash.xxh3_128_digest
                    digests += [digest(view[i:j]) for i, j in zip(first.tolist(), (first + n + (length - 1)).tolist(), strict=True)]
                if not digests:
                    continue
                seed, uid, first, n = (np.concatenate(x) for x in cols[:4])
                # Of a window's bytes beside its seed at least half lie on one side, so these bytes tell which segments can share one.
                (at, base), flank = np.concatenate(cols[4], axis=1), -(-(length - SEED) // 2)
                buf = np.frombuffer(b"".join(raws), np.uint8)
                left = flank_hashes(buf, base + at - flank, flank, at - first >= flank)
                right = flank_hashes(buf, base + at + SEED, flank, at + SEED + flank <= first + n + length - 1)
                flanks = ((left << np.uint64(32)) | right).view(np.int64)
                code = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                order = np.lexsort((first, uid, code[:, 1], code[:, 0]))  # equal segments of the step side by side, the earliest first
                code = code[order]
                head = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]).any(axis=1)]))
                copies = np.diff(np.append(head, len(code))) - 1
                late = np.ones(len(code), dtype=bool)
                late[head] = False
                packed = np.stack([uid[order][late], first[order][late]], axis=1).astype("<i8").tobytes()
                ends = (16 * np.cumsum(copies)).tolist()
                kept = order[head]
                made = [pa.array(seed[kept]), pa.array(code[head, 0]), pa.array(code[head, 1]), pa.array(uid[kept]), pa.array(first[kept].astype(np.int32)), pa.array(n[kept].astype(np.int32)), pa.array(flanks[kept]), pa.array([packed[i:j] or None for i, j in zip([0, *ends], ends, strict=False)], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["seed", "c0", "c1", "uid", "start", "n", "flanks", "copies"])

    cuts = docs.mapInArrow(cut, "seed long, c0 long, c1 long, uid long, start int, n int, flanks long, copies binary")
    cuts = cuts.repartition("seed").sortWithinPartitions("seed", "c0", "c1", "uid", "start")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Repeats of equal segments (seed null), and the earliest of each segment that may share a window with another one of its seed."""
        last = None  # the latest row's keys
        held = [np.zeros(0, np.int64)] * 5  # seed, uid, start, n, flanks of the first-of-its-kind rows of the latest seed
        sent = None  # the latest seed, if it has so many that they went on unseen

        def rows(seed, uid, start, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seed, pa.int64()), pa.array(uid, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())], ["seed", "uid", "start", "n"])

        for batch in batches:
            seed, c0, c1, uid, start, n, flanks = (batch.column(i).to_numpy() for i in range(7))
            if not len(seed):
                continue
            before = [np.concatenate([[x[0] if last is None else last[k]], x[:-1]]) for k, x in enumerate((seed, c0, c1))]
            same = (seed == before[0]) & (c0 == before[1]) & (c1 == before[2])
            if last is None:
                same[0] = False
            last = (seed[-1], c0[-1], c1[-1])
            copies = batch.column(7)
            has = np.flatnonzero(copies.is_valid().to_numpy(zero_copy_only=False))
            pairs = np.frombuffer(b"".join(copies[i].as_py() for i in has.tolist()), "<i8").reshape(-1, 2)
            per = np.array([len(copies[i].as_py()) // 16 for i in has.tolist()], dtype=np.int64)
            if same.any() or len(pairs):
                out = [np.concatenate([uid[same], pairs[:, 0]]), np.concatenate([start[same], pairs[:, 1]]), np.concatenate([n[same], np.repeat(n[has], per)])]
                yield rows([None] * len(out[0]), *out)
            held = [np.concatenate([h, x[~same]]) for h, x in zip(held, (seed, uid, start, n, flanks), strict=True)]
            if not len(held[0]):
                continue
            open_from = int(np.searchsorted(held[0], held[0][-1], side="left"))
            if open_from:  # the seeds before are complete
                done = [x[:open_from] for x in held]
                go = shared_flanks(done[0], done[4])
                if sent is not None:
                    go |= done[0] == sent
                if go.any():
                    yield rows(*(x[go] for x in done[:4]))
                held = [x[open_from:] for x in held]
                sent = sent if sent == held[0][-1] else None
            if sent is not None or len(held[0]) > FLANK_SEGMENTS:
                yield rows(*held[:4])
                sent = int(held[0][-1])
                held = [x[:0] for x in held]
        if len(held[0]):
            go = shared_flanks(held[0], held[4])
            if go.any():
                yield rows(*(x[go] for x in held[:4]))

    sifted = materialize(cuts.mapInArrow(sift, "seed long, uid long, start long, n long"), "suffix-sifted")
    several = sifted.where("seed is not null")
    hot = materialize(several.groupBy("seed").agg(F.sum(F.col("n") + (length - 1)).alias("held")).where(F.col("held") > HOT_BYTES).select("seed"), "suffix-hot")  # at most one seed per HOT_BYTES of segments
    any_hot = hot.limit(1).count() > 0
    cold = several.join(F.broadcast(hot), "seed", "left_anti") if any_hot else several
    wanted = cold.groupBy("uid").agg(F.collect_list(F.struct("seed", "start", "n")).alias("parts"))  # bounded by the document

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                out: list[tuple] = []
                for uid, raw, parts in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    out += [(p["seed"], uid, p["start"], raw[p["start"] : p["start"] + p["n"] + length - 1]) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["seed", "uid", "start", "bytes"])

    strings = docs.join(wanted, "uid").select("uid", "text", "parts").mapInArrow(fetch, "seed long, uid long, start long, bytes binary")
    # A merge takes long for its bytes, so these few rows are not drawn together into fewer, larger partitions.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings = strings.repartition(parts, "seed").sortWithinPartitions("seed", "uid", "start")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, size = None, 0

        for batch in batches:
            for seed, uid, start, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if seed != now and size > MERGE_BYTES:
                    yield merge_held(held, length)[0]
                    held, size = [], 0
                now = seed
                held.append((uid, start, raw))
                size += len(raw)
        if held:
            yield merge_held(held, length)[0]

    found = sifted.where("seed is null").select("uid", "start", "n").unionByName(strings.mapInArrow(find, SPANS))
    return found.unionByName(hot_spans(docs, several.join(F.broadcast(hot), "seed"), length)) if any_hot else found


def hot_spans(docs: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """(uid, start, n) of the repeated windows of hot seeds; ``parts``: seed, uid, start, n of their segments.

    A task folds windows of equal bytes before the shuffle, so a window that
    very many documents share comes a few times.  A merge that fills up inside
    one window's copies keeps the earliest and goes on.
    """
    wanted = parts.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("parts"))  # bounded by the document

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        first: dict[bytes, tuple] = {}  # the earliest place of each window held
        late: list[tuple] = []

        def rows() -> Iterator[pa.RecordBatch]:
            if first:
                key = np.array([xxhash.xxh3_64_intdigest(w) for w in first], dtype=np.uint64).view(np.int64)
                uid, start = (np.array(x, dtype=np.int64) for x in zip(*first.values(), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(uid), pa.array(start), pa.array(np.ones(len(key), np.int64)), pa.array(list(first), pa.binary())], names)
            if late:
                runs = late_runs(*(np.array(x, dtype=np.int64) for x in zip(*late, strict=True)))
                yield pa.RecordBatch.from_arrays([runs.column(0), *runs.columns, pa.nulls(runs.num_rows, pa.binary())], names)
            first.clear()
            late.clear()

        for batch in batches:
            for part in steps(batch, 1):
                for uid, raw, spans in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    for span in spans:
                        for at in range(span["start"], span["start"] + span["n"]):
                            window, place = raw[at : at + length], (uid, at)
                            old = first.setdefault(window, place)
                            if old is not place:
                                if place < old:
                                    first[window] = place
                                late.append(max(old, place))
                        if len(first) + len(late) >= FOLD_WINDOWS:
                            yield from rows()
        yield from rows()

    names = ["deal", "uid", "start", "n", "bytes"]
    windows = docs.join(wanted, "uid").select("uid", "text", "parts").mapInArrow(deal, "deal long, uid long, start long, n long, bytes binary")
    windows = windows.repartition("deal").sortWithinPartitions("deal", "uid", "start")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, first = None, 0  # the latest window's hash, and where its copies begin
        for batch in batches:
            whole = batch.column(4).is_valid()
            yield batch.filter(pc.invert(whole)).select(["uid", "start", "n"])  # folded copies
            batch = batch.filter(whole)
            for key, uid, start, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if key != now:
                    if len(held) == first + 1:  # occurs once
                        held.pop()
                    if len(held) * length > MERGE_BYTES:
                        yield merge_held(held, length)[0]
                        held = []
                    now, first = key, len(held)
                elif len(held) * length > MERGE_BYTES:
                    runs, owner = merge_held(held, length)
                    yield runs
                    gone = set(owner.tolist())
                    held, first = [h for i, h in enumerate(held) if i >= first and i not in gone], 0
                held.append((uid, start, raw))
        if len(held) == first + 1:
            held.pop()
        if held:
            yield merge_held(held, length)[0]

    return windows.mapInArrow(find, SPANS)


def remove_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False, carry: bool = False) -> DataFrame:
    """One row per input row: the id, n_bytes, n_removed, n_spans, spans (begin, end in bytes), kept (binary).

    ``as_text`` gives kept as a string without the characters that a span cuts
    in two; ``carry`` adds the struct ``row`` of the other input columns.

    A byte goes when a ``length``-byte string that covers it also starts
    earlier: in a document of smaller id, or earlier in the same one; strings
    are judged on the input and may overlap.  Texts are UTF-8 bytes, null is
    empty, texts below ``length`` bytes stay.  Rows with a null id count as
    last and rows that share an id follow a hash of their text and the text;
    among wholly equal rows one comes first.  Ids are integers; a text id that
    is none fails the job with CAST_INVALID_INPUT.  An empty table gives an
    empty result; other columns are not read.
    """
    others = [col(c) for c in df.columns if c not in (id_col, text_col)] if carry else []
    rows = df.select(col(id_col).cast("long").alias("doc"), F.coalesce(col(text_col).cast("binary"), F.lit(b"")).alias("text"), *([F.struct(*others).alias("row")] if others else []))
    shared = rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1 or doc is null").limit(1).count() > 0
    if shared:  # positions in the order stated above stand in for ids
        order = [F.col("doc").asc_nulls_last(), F.xxhash64("text"), "text"]
        ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = materialize(ordered.withColumn("uid", F.monotonically_increasing_id()), "suffix-ordered")
    else:
        rows = rows.withColumn("uid", F.col("doc"))
    docs = rows.select("uid", "text")
    spans = repeated_spans(docs, length).groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("runs"))  # bounded by the document

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1, STEP_BYTES):
                made: list[tuple] = []
                for doc, raw, runs in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    found = []
                    for a, b in sorted((r["start"], r["start"] + r["n"] + length - 1) for r in runs or ()):
                        if found and a <= found[-1]["end"]:
                            found[-1]["end"] = max(found[-1]["end"], b)
                        else:
                            found.append({"begin": a, "end": b})
                    edges = [0, *(x for f in found for x in (f["begin"], f["end"])), len(raw)]
                    kept = [raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    kept = "".join(x.decode("utf-8", "ignore") for x in kept) if as_text else b"".join(kept)
                    made.append((doc, len(raw), sum(f["end"] - f["begin"] for f in found), len(found), found, kept))
                columns = [pa.array(x, t) for x, t in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *(part.column(i) for i in range(3, part.num_columns))], schema.names)

    schema = StructType([StructField(id_col, LongType()), *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")), StructField("spans", SPAN), StructField("kept", StringType() if as_text else BinaryType())])
    kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string() if as_text else pa.binary()]
    if others:
        schema.add(rows.schema["row"])
    return rows.join(spans, "uid", "left").select("doc", "text", "runs", *(["row"] if others else [])).mapInArrow(assemble, schema)
