"""Word windows that repeat across documents, by super-k-mers.

A window is ``WORDS`` consecutive words, and its minimiser the smallest hash of
``MMER`` neighbouring words in it.  Consecutive windows with the same minimiser
form one super-k-mer.  A minimiser that lies in one document rules its windows
out; the other super-k-mers travel, each as one packed string of words, to the
bucket of their minimiser, where their windows are sorted and counted by their
words.  Equal windows have equal minimisers, so they always meet.

Equal strings of one step fold into their earliest document before any shuffle.
A minimiser with more than ``HOT_STRINGS`` strings is dealt again, window by
window, by the hash of the whole window, so that no bucket holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from panelwright.llm.common import col, fresh, steps
from panelwright.llm.suffix_dedup import late_runs, loads
from panelwright.session import materialize

#: Words of a window and of a minimiser, and windows worked on at a time (their places take POS_BITS).
WORDS, MMER, CHUNK, POS_BITS = 13, 4, 1 << 18, 20
#: Strings that make a minimiser hot, and bytes of strings that a bucket task sorts together.
HOT_STRINGS, HELD_BYTES = 4096, 4 << 20

MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def word_bounds(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the words of texts that lie side by side in ``buf``; ``ends``: where each text ends."""
    word = ~((buf == 32) | ((buf - np.uint8(9)) <= 4))
    begin, last = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    border = ends[(ends > 0) & (ends < len(buf))]  # two texts may meet without white space between them
    begin[border] = word[border]
    last[border - 1] = word[border - 1]
    return np.flatnonzero(begin), np.flatnonzero(last) + 1


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word, from its length and its first and last eight bytes."""
    size = end - start
    at = loads(np.concatenate([buf, np.zeros(8, np.uint8)]), len(buf) + 1)
    mask = MASK[np.minimum(size, 8)]
    h = ((at[start] & mask) * MIX[0]) ^ ((at[np.maximum(end - 8, start)] & mask) * MIX[1]) ^ (size.astype(np.uint64) * MIX[2])
    h ^= h >> np.uint64(31)
    return h * MIX[3]


def super_kmers(h: np.ndarray, text: np.ndarray, words: int, mmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, minimiser) of the runs of windows with one minimiser; ``h``, ``text``: each word's hash and text."""
    out: list[tuple] = []
    width = words - mmer + 1
    for a in range(0, len(h) - words + 1, CHUNK):
        part = h[a : a + CHUNK + words - 1]
        g = np.zeros(len(part) - mmer + 1, dtype=np.uint64)
        for j in range(mmer):
            g = (g ^ part[j : j + len(g)]) * MIX[0]
            g ^= g >> np.uint64(29)
        low = (g & ~np.uint64((1 << POS_BITS) - 1)) | np.arange(len(g), dtype=np.uint64)  # ties: the leftmost
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        n = len(part) - words + 1
        at = (np.minimum(low[:n], low[width - span : width - span + n]) & np.uint64((1 << POS_BITS) - 1)).astype(np.int64)
        whole = np.flatnonzero(text[a : a + n] == text[a + words - 1 : a + words - 1 + n])  # windows inside one text
        if not len(whole):
            continue
        at = at[whole]
        head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1)]))
        out.append((whole[head] + a, np.diff(np.append(head, len(at))), g[at[head]].view(np.int64)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def string_hashes(h: np.ndarray, first: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """A hash of each run of words, from prefix sums of the words' hashes."""
    odd = MIX[0]
    power = np.cumprod(np.full(len(h), odd, dtype=np.uint64))
    back = np.cumprod(np.full(len(h), np.uint64(pow(int(odd), -1, 1 << 64)), dtype=np.uint64))
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * power)])
    return (total[first + n_words] - total[first]) * back[first] ^ n_words.astype(np.uint64)


#: Bits of a place: the first word above the windows (14 bits), dealt window by window or not, known as repeated or not.
START, COUNT, HOT, LATE = 16, 2, 2, 1


def windows_of(place):
    return (place >> COUNT) & 0x3FFF


def first_windows(strings: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, leader, is leader) of each window: the leader is the earliest string, in the order given, with the same words."""
    split = pc.split_pattern(strings, " ")
    size = pc.list_value_length(split).to_numpy()
    ids = pc.dictionary_encode(split.flatten()).indices.to_numpy().astype(np.uint64)
    n = size - (words - 1)
    begin = np.cumsum(size) - size
    row = np.repeat(np.arange(len(size)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = begin[row] + offset
    key = np.zeros(len(ids) - words + 1, dtype=np.uint64)
    for j in range(words):
        key = (key ^ ids[j : j + len(key)]) * MIX[0]
        key ^= key >> np.uint64(29)
    key = key[at]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    a, b = at[order[1:][same]], at[order[:-1][same]]
    if any((ids[a + j] != ids[b + j]).any() for j in range(words)):  # two windows with one hash: rank by the words
        key = np.unique(ids[at[:, None] + np.arange(words)], axis=0, return_inverse=True)[1].reshape(-1)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
    leader = np.empty(len(order), dtype=np.int64)
    leader[order] = row[order[head]]
    is_leader = np.zeros(len(order), dtype=bool)
    is_leader[order[np.unique(head)]] = True
    return row, offset, leader, is_leader


def repeated_windows(docs: DataFrame, doc: str, words: int, mmer: int) -> DataFrame:
    """(uid, start, n): runs of n windows from word ``start`` that also start in an earlier document.

    ``docs``: distinct uid, text as bytes, and in column ``doc`` a number that is
    equal for rows of one document id and ordered as the ids are.
    """

    def rows(schema: StructType, *columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, KINDS[type(f.dataType)]) for x, f in zip(columns, schema, strict=True)], schema.names)

    cut_schema = StructType([StructField(c, LongType()) for c in ("deal", "uid", "place")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for batch in batches:
            for part in steps(batch, 2):
                uids, docs_, texts = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_pylist()
                raw = b"".join(texts)
                buf = np.frombuffer(raw, np.uint8)
                if not len(buf):
                    continue
                ends = np.cumsum([len(t) for t in texts])
                start, end = word_bounds(buf, ends)
                text = np.searchsorted(ends, start, side="right")
                h = word_hashes(buf, start, end)
                first, n, deal = super_kmers(h, text, words, mmer)
                if not len(first):
                    continue
                own = text[first]
                uid, doc = uids[own], docs_[own]
                begin = first - np.searchsorted(text, own)  # word of its text
                code = string_hashes(h, first, n + (words - 1))
                order = np.lexsort((first, doc, code))
                head = np.maximum.accumulate(np.where(np.concatenate([[True], code[order][1:] != code[order][:-1]]), np.arange(len(order)), 0))
                lead = order[head]
                from_byte, to_byte = start[first], end[first + n + (words - 2)]
                again = (doc[order] > doc[lead]) & (to_byte[order] - from_byte[order] == to_byte[lead] - from_byte[lead])
                folded = np.zeros(len(first), dtype=bool)
                copies, leads = order[again], lead[again]
                equal = [raw[a:b] == raw[c:d] for a, b, c, d in zip(*(x.tolist() for x in (from_byte[copies], to_byte[copies], from_byte[leads], to_byte[leads])), strict=True)]
                folded[copies[np.array(equal, dtype=bool)]] = True
                yield rows(cut_schema, np.where(folded, uid, deal), uid, (begin << START) | (n << COUNT) | folded)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of minimisers that lie in several texts; rows come by minimiser and text."""
        carry = [np.zeros(0, np.int64)] * 3
        hot_deal: int | None = None  # the open group, if some of its rows went out as hot

        def send(group_rows: list[np.ndarray], last_open: bool) -> tuple[pa.RecordBatch | None, list[np.ndarray]]:
            nonlocal hot_deal
            deal, uid, place = group_rows
            head = np.flatnonzero(np.concatenate([[True], deal[1:] != deal[:-1]]))
            size = np.diff(np.append(head, len(deal)))
            going_on = np.zeros(len(head), dtype=bool) if hot_deal is None else deal[head] == hot_deal
            several = (uid[head] != uid[head + size - 1]) | going_on
            hot = several & ((size > HOT_STRINGS) | going_on)
            stay = last_open and not hot[-1]
            if last_open:
                hot_deal = int(deal[-1]) if hot[-1] else None
            out = np.repeat(several, size)
            if stay:
                out[head[-1] :] = False
            left = [x[head[-1] :] for x in group_rows] if stay else [x[:0] for x in group_rows]
            if not out.any():
                return None, left
            return rows(cut_schema, deal[out], uid[out], place[out] | np.where(np.repeat(hot, size)[out], HOT, 0)), left

        for batch in batches:
            got = [batch.column(i).to_numpy() for i in range(3)]
            late = got[2] & LATE == LATE
            if late.any():
                yield rows(cut_schema, *(g[late] for g in got))
            carry = [np.concatenate([c, g[~late]]) for c, g in zip(carry, got, strict=True)]
            if len(carry[0]):
                made, carry = send(carry, True)
                if made is not None:
                    yield made
        if len(carry[0]):
            made, _ = send(carry, False)
            if made is not None:
                yield made

    cuts = docs.select("uid", F.col(doc).alias("doc"), "text").mapInArrow(cut, cut_schema).repartition("deal").sortWithinPartitions("deal", "uid", "place")
    parts = cuts.mapInArrow(sift, cut_schema).groupBy("uid").agg(F.collect_list(F.struct("deal", "place")).alias("parts"))  # bounded by the document

    fetch_schema = StructType([*(StructField(c, LongType()) for c in ("deal", "doc", "uid", "place")), StructField("more", BinaryType()), StructField("string", BinaryType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed strings of the super-k-mers that go on; equal ones of a step fold into the earliest document's."""
        fresh()
        for batch in batches:
            for part in steps(batch, 2):
                out: list[list] = []
                seen: dict[bytes, list] = {}
                order = np.argsort(part.column(1).to_numpy(), kind="stable")
                for uid, doc, raw, wanted in zip(*(part.column(i).take(pa.array(order)).to_pylist() for i in range(4)), strict=True):
                    said = raw.split()  # bytes.split() parts words at exactly these six signs
                    for p in sorted(wanted, key=lambda p: p["place"]):
                        begin, n, hot = p["place"] >> START, windows_of(p["place"]), p["place"] & HOT
                        if p["place"] & LATE:
                            out.append([uid, doc, uid, p["place"], [], None])
                            continue
                        for a, k in [(begin + i, 1) for i in range(n)] if hot else [(begin, n)]:
                            string = b" ".join(said[a : a + k + words - 1])
                            lead = seen.get(string)
                            if lead is None or (doc == lead[1] and uid != lead[2]):
                                seen[string] = now = [xxhash.xxh3_64_intdigest(string) - (1 << 63) if hot else p["deal"], doc, uid, (a << START) | (k << COUNT), [], string]
                                out.append(now)
                            elif uid == lead[2]:
                                lead[4].append(a)
                            else:
                                out.append([uid, doc, uid, (a << START) | (k << COUNT), [], None])
                if out:
                    cols = list(zip(*out, strict=True))
                    cols[4] = [np.array(x, dtype="<i8").tobytes() if x else None for x in cols[4]]
                    yield rows(fetch_schema, *cols)

    found_schema = StructType([StructField("uid", LongType()), StructField("start", LongType()), StructField("n", LongType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of windows whose words came with a smaller document before; rows come by bucket and document."""
        fresh()
        held: list[pa.RecordBatch] = []  # the first ``decided`` rows are only there to be compared with
        size, decided, limit = 0, 0, HELD_BYTES

        def decide() -> tuple[pa.RecordBatch, pa.RecordBatch]:
            every = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            deal, doc, uid = (every.column(i).to_numpy() for i in range(3))
            row, offset, leader, is_leader = first_windows(every.column(5), words)
            late = (doc[row] > doc[leader]) & (row >= decided)
            row_late, off_late = row[late], offset[late]
            start = every.column(3).to_numpy() >> START
            more = every.column(4)
            each = pc.fill_null(pc.binary_length(more), 0).to_numpy().astype(np.int64) // 8  # further places in its text
            at = np.frombuffer(b"".join(more.drop_null().to_pylist()), "<i8")
            times = each[row_late]
            pick = np.repeat((np.cumsum(each) - each)[row_late], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            runs = late_runs(np.concatenate([uid[row_late], np.repeat(uid[row_late], times)]), np.concatenate([start[row_late] + off_late, at[pick] + np.repeat(off_late, times)]))
            leads = np.zeros(every.num_rows, dtype=bool)
            leads[row[is_leader]] = True
            return runs, every.filter(pa.array(leads & (deal == deal[-1])))

        for batch in batches:
            whole = batch.column(5).is_valid()
            folded = batch.filter(pc.invert(whole))
            if folded.num_rows:
                place = folded.column(3).to_numpy()
                yield rows(found_schema, folded.column(2).to_numpy(), place >> START, windows_of(place))
            batch = batch.filter(whole)
            for part in steps(batch, 5, HELD_BYTES):
                held.append(part)
                size += part.get_total_buffer_size() if part.num_rows == batch.num_rows else pc.sum(pc.binary_length(part.column(5))).as_py()
                if size > limit:
                    runs, left = decide()
                    yield runs
                    held, decided = [left], left.num_rows
                    size = left.get_total_buffer_size()
                    limit = HELD_BYTES + 2 * size
        if sum(b.num_rows for b in held) > decided:
            yield decide()[0]

    strings = docs.join(parts, "uid").select("uid", F.col(doc).alias("doc"), "text", "parts").mapInArrow(fetch, fetch_schema)
    return strings.repartition("deal").sortWithinPartitions("deal", "doc", "uid").mapInArrow(find, found_schema)


KINDS = {LongType: pa.int64(), BinaryType: pa.binary()}
SPAN = ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())]))


def drop_repeated_windows(df: DataFrame, words: int = WORDS, mmer: int = MMER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_words, n_removed, spans (begin, end in words) and kept (the words left, joined by one blank).

    Words are runs of characters other than blank, tab and line ends, taken
    unchanged.  A word goes when a window of ``words`` words that covers it
    also starts in a document of smaller id; windows are judged on the input,
    and repeats inside one document stay.  Null texts have no words, and texts
    below ``words`` words stay.  Rows that share an id are one document: they
    don't remove each other's words.  Null ids are one id after all others; ids
    of any ordered type will do.  A very long text is worked on in chunks, but
    its words are held by one task.  An empty table gives an empty result;
    other columns are not read.
    """
    if not 1 <= mmer <= words < 1 << 14:
        raise ValueError("a window needs at least the words of a minimiser")
    rows = df.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    id_type = rows.schema["id"].dataType
    integral = id_type.typeName() in ("byte", "short", "integer", "long")
    if not integral or rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").limit(1).count() > 0:
        order = [F.col("id").asc_nulls_last(), F.xxhash64("text"), "text"]
        rows = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("uid", F.monotonically_increasing_id()), "windows-ordered")
        least = rows.groupBy(F.col("id").alias("same")).agg(F.min("uid").alias("doc"))
        rows, doc = rows.join(least, F.col("id").eqNullSafe(F.col("same"))).select("id", "uid", "doc", "text"), "doc"
    else:  # one column for both, so that both joins share one exchange of the texts
        rows, doc = rows.select(F.col("id").cast("long").alias("uid"), "text").where("uid is not null"), "uid"
    runs = repeated_windows(rows, doc, words, mmer).groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("runs"))  # bounded by the document

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                made: list[tuple] = []
                for raw, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    said, spans = raw.split(), []
                    for a, b in sorted((r["start"], r["start"] + r["n"] + words - 1) for r in found or ()):
                        if spans and a <= spans[-1]["end"]:
                            spans[-1]["end"] = max(spans[-1]["end"], b)
                        else:
                            spans.append({"begin": a, "end": b})
                    edges = [0, *(x for s in spans for x in (s["begin"], s["end"])), len(said)]
                    kept = b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in said[a:b])
                    made.append((len(said), sum(s["end"] - s["begin"] for s in spans), spans, kept))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(zip(*made, strict=True), kinds, strict=True))], schema.names)

    schema = StructType([StructField(id_col, id_type), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("spans", SPAN), StructField("kept", BinaryType())])
    shown = F.col("id") if doc == "doc" else F.col("uid").cast(id_type)
    out = rows.join(runs, "uid", "left").select(shown, "text", "runs").mapInArrow(assemble, schema)
    return out.withColumn("kept", F.col("kept").cast("string"))
