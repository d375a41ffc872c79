"""Exact ranked lexical search by best-first descent of sparse ball trees.

A document is the sparse vector of its weighted term scores, a query the sum of
its axes, so a score is an inner product.  Each task cuts its documents into
blocks and builds a ball tree over each: a node keeps its centroid, its radius
and its radius along each axis.  For a query the nodes are opened by descending
bound; a subtree is pruned when the largest score that its ball admits, rounded
up beyond all rounding of its own, lies below the query's k-th best score so
far.  Leaves are scored in 64-bit integers, so results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from panelwright.llm.common import col, fresh, steps
from panelwright.session import materialize

#: Queries and distinct terms that one pass over the documents answers; a longer query is a pass of its own.
BLOCK_QUERIES, BLOCK_TERMS = 512, 16384
#: Cells of a block's matrix, its most documents, and documents of a leaf.
BLOCK_CELLS, BLOCK_DOCS, LEAF_DOCS = 1 << 21, 2048, 16
#: Bytes of a text that are parted into terms at a time.
PIECE = 4 << 20

#: Letters and digits of ASCII stay, A-Z as a-z; bytes of other characters stay; all else parts terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of about ``PIECE`` bytes."""
    a = 0
    while a < len(raw):
        piece = raw[a : a + PIECE].translate(FOLD)
        a += len(piece)
        cut = piece.rfind(b" ") + 1 if a < len(raw) else len(piece)
        while not cut:  # one long term
            more = raw[a : a + PIECE].translate(FOLD)
            a += len(more)
            end = more.find(b" ") if a < len(raw) else len(more)
            cut = 0 if end < 0 else len(piece) + end
            piece += more
        a -= len(piece) - cut
        yield piece[:cut].split()


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


class BallTree:
    """A ball tree over the rows of a matrix of non-negative integers."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.nodes: list[tuple[np.ndarray, int, int]] = []  # its rows, and its two children or -1
        approx = rows.astype(np.float32)
        square = np.einsum("ij,ij->i", approx, approx)
        self.grow(np.arange(len(rows)), approx, square)
        exact = rows.astype(np.float64)
        self.centre = np.array([exact[i].mean(axis=0) for i, _, _ in self.nodes])
        self.reach = np.array([exact[i].max(axis=0) for i, _, _ in self.nodes])  # the centroid and the radius along each axis
        self.radius = np.array([np.sqrt(((exact[i] - c) ** 2).sum(axis=1).max()) for (i, _, _), c in zip(self.nodes, self.centre, strict=True)])
        self.top = float(exact.max(initial=0.0))

    def grow(self, held: np.ndarray, approx: np.ndarray, square: np.ndarray) -> int:
        me = len(self.nodes)
        self.nodes.append((held, -1, -1))
        if len(held) > LEAF_DOCS:
            own = approx[held]
            gap = lambda v: square[held] - 2 * (own @ v)  # noqa: E731 - squared distance to v, but for a constant
            one = own[np.argmax(gap(own.mean(axis=0)))]
            other = own[np.argmax(gap(one))]
            lean = gap(one) - gap(other)
            side = lean > float(other @ other - one @ one)
            if not len(held) <= 8 * int(side.sum()) <= 7 * len(held):  # lopsided, or equal rows: halves, so the tree stays shallow
                side = np.argsort(np.argsort(lean, kind="stable"), kind="stable") * 2 >= len(held)
            self.nodes[me] = (held, self.grow(held[~side], approx, square), self.grow(held[side], approx, square))
        return me

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(nodes, queries): no row below the node scores more; ``queries``: columns of zeros and ones."""
        size = queries.sum(axis=0)
        ball = self.centre @ queries + np.outer(self.radius, np.sqrt(size))
        # Rounding is below 1e-12 of the largest cell a term; a thousandfold and one keep the bound safe.
        slack = 1e-9 * self.top * (size + 1) + 1
        return np.minimum(ball, self.reach @ queries) + slack

    def search(self, columns: np.ndarray, bound: np.ndarray, floor: int, offer) -> int:
        """Leaves opened.  ``offer(rows, scores)`` takes a leaf's scores and returns the score below which rows don't count."""
        queue, opened = [(-bound[0], 0)], 0
        while queue and -queue[0][0] >= floor:
            best, node = heapq.heappop(queue)
            held, left, right = self.nodes[node]
            if left < 0:
                opened += 1
                floor = offer(held, self.rows[held[:, None], columns].sum(axis=1))
            else:
                for child in (left, right):
                    heapq.heappush(queue, (max(best, -bound[child]), child))
        return opened


class Ranking:
    """The k best (score, id) of one query: the highest score, then the smallest id, null last."""

    def __init__(self, k: int):
        self.k, self.best, self.floor = k, [], 1

    def offer(self, ids: list, scores: np.ndarray) -> int:
        good = np.flatnonzero(scores >= self.floor)
        if len(good):
            self.best += [(-int(scores[i]), ids[i] is None, ids[i]) for i in good.tolist()]
            self.best.sort(key=lambda x: x[:2] if x[1] else x)
            del self.best[self.k :]
            if len(self.best) == self.k:
                self.floor = -self.best[-1][0]
        return self.floor


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Lists of (id, distinct terms), each list of bounded size; the driver holds one at a time."""
    block, held = [], set()
    for row in queries.select(col(id_col), F.coalesce(col(text_col), F.lit("")).cast("binary")).toLocalIterator():
        own = {t for piece in terms(bytes(row[1])) for t in piece}
        if block and (len(block) >= BLOCK_QUERIES or len(held | own) > BLOCK_TERMS):
            yield block
            block, held = [], set()
        block.append((row[0], own))
        held |= own
    if block:
        yield block


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """One row per query and document among its ``k`` best: the query's id, rank (from 1), the document's id, score.

    Terms are runs of ASCII letters and digits and of all other characters
    beyond ASCII, with A-Z in lower case.  With N documents that hold a term, L
    terms in all and n in the document, a term's weight is
    floor(1000 ln((2N+2)/(2df+1))), m = 50 + 50nN div L, and a document scores
    the sum of weight * (10^9 tf div (1000 tf + 20 m)) over the query's
    distinct terms.  Only scores above 0 count; equal scores go by ascending
    document id, null last.  Each row of either table counts as itself, also if
    it repeats an id.  Null texts have no terms; such documents count in no
    statistic and such queries have no rows.  Very long texts are parted in
    pieces.  An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    src = docs.select(col(id_col), F.coalesce(col(text_col).cast("binary"), F.lit(b"")))
    q_type, d_type = queries.select(col(query_id_col)).schema[0].dataType, src.schema[0].dataType
    parts = [_rank_block(src, block, k, d_type) for block in query_blocks(queries, query_id_col, query_text_col)]
    names = [query_id_col, "rank", id_col, "score"]
    if not parts:
        return spark.createDataFrame([], StructType([StructField(n, t) for n, t in zip(names, (q_type, IntegerType(), d_type, LongType()), strict=True)]))
    out = None
    for found, block in parts:
        ids = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(block)], StructType([StructField("query", IntegerType()), StructField("query_id", q_type)]))
        part = found.join(F.broadcast(ids), "query").select(F.col("query_id").alias(names[0]), "rank", F.col("doc").alias(names[2]), "score")  # at most BLOCK_QUERIES ids
        out = part if out is None else out.unionByName(part)
    return out


def _rank_block(src: DataFrame, block: list[tuple], k: int, d_type) -> tuple[DataFrame, list[tuple]]:
    spark = src.sparkSession
    vocab = {t: i for i, t in enumerate(sorted(set().union(*(own for _, own in block))))}
    asked = [np.array(sorted(vocab[t] for t in own), dtype=np.int64) for _, own in block]
    width = len(vocab)
    sc = spark.sparkContext
    words = sc.broadcast(vocab)  # the distinct terms of one block of queries

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        find = words.value.get
        for batch in batches:
            for part in steps(batch, 1):
                sizes, ids, counts = [], [], []
                for raw in part.column(1).to_pylist():
                    n, held = 0, Counter()
                    for piece in terms(raw):
                        n += len(piece)
                        held.update(map(find, piece))
                    held.pop(None, None)
                    sizes.append(n)
                    ids.append(np.fromiter(held.keys(), "<i4", len(held)).tobytes())
                    counts.append(np.fromiter(held.values(), "<i4", len(held)).tobytes())
                made = [part.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["doc", "n", "ids", "tfs"])

    vec = StructType([StructField("doc", d_type), StructField("n", LongType()), StructField("ids", BinaryType()), StructField("tfs", BinaryType())])
    table = materialize(src.mapInArrow(vectors, vec).where("n > 0"), "lexical-vectors")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, dtype=np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=width)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df).astype(np.int32)), pa.array(df[df > 0])], ["term", "df"])

    n_docs, n_terms = table.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(width, dtype=np.int64)
    for term, count in table.select("ids").mapInArrow(frequencies, "term int, df long").groupBy("term").agg(F.sum("df")).toLocalIterator():  # at most one row a term of the block
        df[term] = count
    weights = sc.broadcast(term_weights(n_docs, df))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        weight = weights.value
        best = [Ranking(k) for _ in asked]
        waiting: list[pa.RecordBatch] = []

        def block_of(part: pa.RecordBatch) -> None:
            ids, sizes = part.column(0).to_pylist(), part.column(1).to_pylist()
            per = np.array([len(x) // 4 for x in part.column(2).to_pylist()])
            term = np.frombuffer(b"".join(part.column(2).to_pylist()), "<i4")
            tf = np.frombuffer(b"".join(part.column(3).to_pylist()), "<i4").astype(np.int64)
            long_by = np.repeat(np.array([50 + 50 * n * n_docs // n_terms for n in sizes], dtype=np.int64), per)
            cell = weight[term] * (1000000000 * tf // (1000 * tf + 20 * long_by))
            present, column = np.unique(term, return_inverse=True)
            rows = np.zeros((len(ids), len(present)), dtype=np.int64)
            rows[np.repeat(np.arange(len(ids)), per), column] = cell
            at = [np.searchsorted(present, a) for a in asked]
            at = [p[(p < len(present))] if not len(a) else p[np.append(present, -1)[p] == a] for p, a in zip(at, asked, strict=True)]
            live = [i for i, p in enumerate(at) if len(p)]
            if not live:
                return
            tree = BallTree(rows)
            mask = np.zeros((len(present), len(live)))
            for j, i in enumerate(live):
                mask[at[i], j] = 1
            bound = tree.bounds(mask)
            for j, i in enumerate(live):
                if bound[0, j] >= best[i].floor:
                    tree.search(at[i], bound[:, j], best[i].floor, lambda held, scores, r=best[i]: r.offer([ids[h] for h in held.tolist()], scores))

        rows_of_block = min(max(BLOCK_CELLS // max(width, 1), LEAF_DOCS), BLOCK_DOCS)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = batch.slice(at, rows_of_block - sum(b.num_rows for b in waiting))
                waiting.append(take)
                at += take.num_rows
                if sum(b.num_rows for b in waiting) == rows_of_block:
                    block_of(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting = []
        if waiting:
            block_of(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
        for i, r in enumerate(best):
            if r.best:
                made = [pa.array([i] * len(r.best), pa.int32()), pa.array([b[2] for b in r.best], kind), pa.array([-b[0] for b in r.best], pa.int64())]
                yield pa.RecordBatch.from_arrays(made, ["query", "doc", "score"])

    kind = pa.string() if isinstance(d_type, StringType) else pa.int32() if isinstance(d_type, IntegerType) else pa.int64()
    if kind == pa.int64() and not isinstance(d_type, LongType):
        raise TypeError(f"document ids must be long, int or string, not {d_type.simpleString()}")
    found = table.mapInArrow(search, StructType([StructField("query", IntegerType()), StructField("doc", d_type), StructField("score", LongType())]))
    # k rows a task and query meet in two steps, so that no task reads the rows of all tasks.
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(64)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= k)
    ranked = salted.select("query", "doc", "score", F.row_number().over(Window.partitionBy("query").orderBy(*order)).alias("rank"))
    return ranked.where(F.col("rank") <= k), block
