"""N-gram Jaccard join: MinHash banding proposes, full n-gram sets decide.

Documents with equal n-gram sets are one class.  Classes that agree on all
rows of a band meet in a band-hash bucket; a bucket ties its members to its
smallest one, so it gives as many rows as members and no pairs.  What hangs
together by such ties is a candidate group.  A group is cut into blocks, and
each pair of blocks is verified on the full sets inside one task, which
returns link counts and a spanning forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.chunks import Memory
from panelwright.llm.common import col, connected_components, fresh, steps
from panelwright.llm.links import forest
from panelwright.session import materialize

#: Words of an n-gram, least similarity that links, and the recall wanted for a pair that is just similar enough.
WORDS, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.99999, 6
#: A block of a candidate group holds about so many classes and n-grams.
BLOCK_CLASSES, BLOCK_GRAMS = 1024, 1 << 20


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """The fewest bands of ``rows`` rows that catch a pair of this similarity with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


class Shingler:
    """Sorted distinct 64-bit hashes of all runs of ``n`` words; a shorter text is one run, a text without words none."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, n: int = WORDS):
        self.n, self.known = n, Memory()

    def grams(self, text: str) -> np.ndarray:
        words = text.split()
        for w in self.known.missing(set(words)):
            self.known.now[w] = xxhash.xxh3_64_intdigest(w.encode())
        h = np.fromiter(map(self.known.now.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.n, len(h))
        if not k:
            return h
        out = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for i in range(k):
            out = (out ^ h[i : i + len(out)]) * self.MIX
            out ^= out >> np.uint64(29)
        return np.unique(out)


@lru_cache(maxsize=4)
def coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_24)
    return rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature; the band's number is part of it."""
    a, b = coefficients(bands * rows)
    least = np.full(bands * rows, 0xFFFFFFFF, dtype=np.uint32)
    short = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    for i in range(0, len(short), 1024):
        np.minimum(least, (short[i : i + 1024, None] * a + b).min(axis=0), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64) * Shingler.MIX
    for r in least.reshape(bands, rows).T:
        out = (out ^ r) * Shingler.MIX
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def linked_sets(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard similarity reaches the threshold, on the full sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, gram, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[gram] > 1  # a gram of one set is in no intersection
    owner, gram = owner[shared], np.unique(gram[shared], return_inverse=True)[1]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = max(64, (8 << 20) // max(1, len(sets)))
    last = int(gram[-1]) + 1 if len(gram) else 0
    for at in range(0, last, width):
        lo, hi = np.searchsorted(gram, [at, at + width])
        part = np.zeros((len(sets), min(width, last - at)), dtype=np.float32)
        part[owner[lo:hi], gram[lo:hi] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * union - 1e-9 * union
    np.fill_diagonal(linked, False)
    return linked & (common > 0)


def similar_documents(df: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, class_id, n_links, component_id, kept.

    Words are runs of characters that are not white space, as they stand.
    Documents whose sets of ``words``-grams have a Jaccard similarity of at
    least ``similarity`` link.  class_id is the smallest id with an equal set,
    n_links the number of other documents linked (copies included),
    component_id the smallest id reachable by links; kept marks it.  A text of
    fewer words is one n-gram; null, empty and blank texts have none and link
    with nothing, and so do rows with a null id (they stay).  Rows that repeat
    an id with an equal text are one document; with another text, a document
    of its own that shares the id.  Ids are integers; a text id that is none
    fails the job with CAST_INVALID_INPUT.  An empty table gives an empty
    result; other columns are not read.
    """
    bands = bands_for(similarity, rows, recall)
    docs = df.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        shingler = Shingler(words)
        for batch in batches:
            for part in steps(batch, 1):
                keys, sizes, signed = [], [], []
                for text in part.column(1).to_pylist():
                    grams = shingler.grams(text)
                    keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                    sizes.append(len(grams))
                    signed.append(band_hashes(grams, bands, rows).tobytes() if len(grams) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signed, pa.binary())], ["id", "key", "grams", "bands"])

    signed = materialize(docs.mapInArrow(sign, "id long, key binary, grams long, bands binary"), "ngram-signed")
    usable = signed.where("id is not null and key is not null")
    classes = usable.groupBy("key").agg(F.min("id").alias("least"), F.countDistinct("id").alias("size"), F.first("grams").alias("grams"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "ngram-classes")

    def explode_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                hashes = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.repeat(part.column(0).to_numpy(), bands))], ["band", "cid"])

    buckets = classes.select("cid", "bands").mapInArrow(explode_bands, "band long, cid long")
    heads = buckets.groupBy("band").agg(F.min("cid").alias("head"), F.count("*").alias("n")).where("n > 1")
    ties = buckets.join(heads, "band").where("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    groups = connected_components(ties, "ngram-groups")

    members = classes.select("cid", "least", "key", "size", "grams").join(groups.withColumnRenamed("node", "cid"), "cid")
    whole = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    members = members.join(whole, "root").withColumn("block", F.expr("cast(pmod(xxhash64(cid), blocks) as int)"))
    texts = docs.join(members.withColumnRenamed("least", "id"), "id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = texts.select("root", "block", "cid", "size", "key", "text", other)
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "size", "key", "text")
    dealt = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "cid")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, now, held = Shingler(words), None, {}

        def close() -> pa.RecordBatch:
            rows_ = list(held.values())
            linked = linked_sets([r[3] for r in rows_], similarity)
            ids, sizes, block = (np.array([r[k] for r in rows_], dtype=np.int64) for k in (0, 1, 2))
            if now[1] != now[2]:  # pairs inside a block belong to that block alone
                linked &= block[:, None] != block[None, :]
            counts = linked @ sizes
            hit, edges = np.flatnonzero(counts), forest(linked)
            made = [[*ids[hit].tolist(), *(int(ids[i]) for i, _ in edges)], [None] * len(hit) + [int(ids[j]) for _, j in edges], [*counts[hit].tolist(), *[0] * len(edges)]]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in made], ["a", "b", "n"])

        for batch in batches:
            for root, i, j, block, cid, size, key, text in zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "block", "cid", "size", "key", "text")), strict=True):
                if now != (root, i, j):
                    if len(held) > 1:
                        yield close()
                    now, held = (root, i, j), {}
                if cid not in held:
                    grams = shingler.grams(text)
                    if hashlib.blake2b(grams.tobytes(), digest_size=16).digest() == key:  # an id may be repeated with another text
                        held[cid] = (cid, size, block, grams)
        if len(held) > 1:
            yield close()

    found = materialize(dealt.mapInArrow(verify, "a long, b long, n long"), "ngram-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("b is not null").select("a", "b"), "ngram-components").withColumnRenamed("node", "cid")
    least = roots.join(classes.select("cid", "least"), "cid").groupBy("root").agg(F.min("least").alias("smallest"))
    per_class = classes.select("cid", "key", "least", "size").join(counts, "cid", "left").join(roots.join(least, "root"), "cid", "left")
    per_class = per_class.select("key", F.col("least").alias("class_id"), (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("smallest", "least").alias("component_id"))
    linked = usable.select("id", "key").join(per_class, "key").select("id", "class_id", "n_links", "component_id")
    alone = signed.where("id is null or key is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "class_id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
