"""Exact deduplication by Patricia tries over (length, content hash) partitions.

Copies inside one batch of a task fall together first, so a text that very
many rows share moves once per batch and not once per row.  What is left is
dealt by normalised length and content hash and inserted, whole, into a
compressed radix trie; equal texts end in one terminal node, whatever their
hashes say.  A terminal keeps its class number, how many rows ended there and
the smallest owner so far; members go on at once with the class number, so
they never meet in one task.  Since rows come by length and hash, all that a
trie holds is finished when the next hash comes: a trie that is full, or whose
length is over, gives its owners off subtree by subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from panelwright.llm.common import ARROW, col, fresh, steps
from panelwright.session import materialize

#: Fixed value: the characters that do not count when texts are compared.
IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text a trie holds before it gives its subtrees off.
TRIE_BYTES = 24 << 20


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, {}, value


class PatriciaTrie:
    """A compressed radix trie over byte strings; ``node(key)`` finds or makes the node where a key ends."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def node(self, key: bytes) -> Node:
        at, here = 0, self.root
        while at < len(key):
            child = here.children.get(key[at])
            if child is None:
                child = here.children[key[at]] = Node(key[at:])
                self.held += len(key) - at
                return child
            label = child.label
            if not key.startswith(label, at):
                lo, hi = 1, len(label)  # the label's first lo bytes agree, its first hi bytes do not
                while hi - lo > 1:
                    mid = (lo + hi) // 2
                    lo, hi = (mid, hi) if key.startswith(label[:mid], at) else (lo, mid)
                fork = here.children[key[at]] = Node(label[:lo])
                child.label = label[lo:]
                fork.children[child.label[0]] = child
                child, label = fork, fork.label
            at += len(label)
            here = child
        return here

    def give_off(self) -> Iterator:
        """The values of all terminals, subtree by subtree; each subtree is dropped once it has been walked."""
        if self.root.value is not None:
            yield self.root.value
        while self.root.children:
            below = [self.root.children.popitem()[1]]
            while below:
                node = below.pop()
                if node.value is not None:
                    yield node.value
                below += node.children.values()
        self.root, self.held = Node(b""), 0


def owners(rows: list[tuple]) -> list[tuple[bytes, list]]:
    """Group (text, ...) rows by text over one trie; groups in order of first appearance."""
    trie, groups = PatriciaTrie(), []
    for row in rows:
        node = trie.node(row[0])
        if node.value is None:
            node.value = (row[0], [])
            groups.append(node.value)
        node.value[1].append(row[1:])
    return groups


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal when their UTF-8 bytes without blanks, tabs and line ends
    are.  The row with the most code points in its original text stays, then
    the smallest id (null last); of wholly repeated rows exactly one stays.
    A very long text is inserted whole, in a step of its own.
    Null counts as empty, and all empty texts are one group.  An empty table
    gives an empty result; other columns are not read.
    """
    src = df.select(col(id_col), F.coalesce(col(text_col), F.lit("")).cast("binary"), F.coalesce(F.char_length(col(text_col)), F.lit(0)).cast("long"))
    id_type = src.schema[0].dataType
    first = lambda cp, i: (-cp, i is None, i)
    schema = StructType([StructField("length", LongType()), StructField("hash", LongType()), StructField("text", BinaryType()), StructField("points", LongType()), StructField("group", LongType()), StructField("members", ArrayType(id_type)), StructField("sha", StringType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        n = TaskContext.get().partitionId() << 40
        for batch in batches:
            held: list[tuple] = []
            ids, points = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = (t.translate(None, IGNORED) for part in steps(batch, 1) for t in part.column(1).to_pylist())
            for group in owners(list(zip(texts, points, ids, strict=True))):
                text, rows = group[0], sorted(group[1], key=lambda x: first(*x))
                sha = hashlib.sha256(text).digest()
                held.append((len(text), int.from_bytes(sha[:8], "little", signed=True), text, rows[0][0], n, [i for _, i in rows], sha.hex()))
                n += 1
                if len(held) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds, strict=True)], schema.names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds, strict=True)], schema.names)

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(ARROW[type(id_type)]), pa.string()]

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every arriving group with its class, and each class's owner once its subtree is finished; rows come by length and hash."""
        trie, last, n = PatriciaTrie(), (None, None), TaskContext.get().partitionId() << 40

        def finished() -> Iterator[pa.RecordBatch]:
            held = trie.give_off()
            while some := list(islice(held, 4096)):
                classes, sizes, best = zip(*some, strict=True)
                none = pa.nulls(len(some))
                owner = [pa.array([x[i] for x in best], t) for i, t in ((2, kinds[5].value_type), (3, pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), none.cast(pa.int64()), none.cast(kinds[5]), none.cast(pa.string()), *owner, pa.array(sizes, pa.int64())], out.names)

        for batch in batches:
            classes = []
            for size, code, text, points, group, members in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if last != (size, code) and (last[0] != size or trie.held > TRIE_BYTES):
                    yield from finished()
                last = (size, code)
                node, rank = trie.node(text), (*first(points, members[0]), group)
                if node.value is None:
                    node.value = [n, 0, rank]
                    n += 1
                node.value[1] += len(members)
                node.value[2] = min(node.value[2], rank)
                classes.append(node.value[0])
            none = pa.nulls(len(classes))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), *(batch.column(i) for i in range(4, 7)), none.cast(kinds[5].value_type), none.cast(pa.int64()), none.cast(pa.int64())], out.names)
        yield from finished()

    out = StructType([StructField("class", LongType()), *schema.fields[4:], StructField("keep_id", id_type), StructField("won", LongType()), StructField("group_size", LongType())])
    rows = src.mapInArrow(fold, schema).repartition("length", "hash").sortWithinPartitions("length", "hash").mapInArrow(insert, out)
    rows = materialize(rows, "exact-dedup-groups")
    won = rows.where("members is null").select("class", "keep_id", "won", "group_size")
    members = rows.where("members is not null").select("class", "group", "sha", F.posexplode("members").alias("pos", "id"))
    kept = (F.col("group") == F.col("won")) & (F.col("pos") == 0)
    return members.join(won, "class").select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
