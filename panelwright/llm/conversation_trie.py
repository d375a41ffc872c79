"""The prefix trie of conversations, from sorted neighbours.

Conversations are sorted by their sequences of turns.  Neighbours share a
prefix, and its length (LCP) is an edge between them.  A union-find takes the
edges of a run of neighbours in descending depth: every merge of two components
makes or grows the branching node at that depth, and the nodes between it and
the component below have the component's members.  A node whose members all lie
inside the run is finished there.  The prefixes of a run's first and last
conversation may go on in other runs: each run's forest is contracted to these,
and the contracted forests of all runs are merged by prefix.

Nodes of one member need no sorting: below the longest prefix that a
conversation shares, its own turns are its nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import col, fresh
from panelwright.operators.quantiles import global_rank
from panelwright.session import materialize

#: Turns of a conversation that are compared first; those that share them all are compared whole.
FIRST_TURNS = 64
#: Conversations and bytes of their turn codes that one union-find works on.
RUN_CONVS, RUN_BYTES = 8192, 8 << 20
#: Characters of a turn's code: the hexadecimal SHA-256 of role and text, cut to 128 bits.
CODE = 32

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def code_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, code, words) of every turn: its place from 0, a code of role and text, and the words of its text."""
    if turns.select(col(conv_col)).schema[0].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError("conversation ids must be whole numbers")
    role, text = (F.coalesce(col(c), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    coded = turns.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"),
        F.substring(F.sha2(said.cast("binary"), 256), 1, CODE).alias("code"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    coded = materialize(coded, "trie-codes")
    # Places come from global ranks, so a conversation of very many turns meets in no task.
    return global_rank(coded, ["turn", "code"], ["conv"], label="trie-ranked").select("conv", F.col("__r").alias("pos"), "code", "words")


def key_of(prefix: str) -> bytes:
    return hashlib.sha256(prefix.encode()).digest()[:16]


class Forest:
    """The trie over a run of sorted neighbours; ``items``: (conv, turns, path, words of each turn of the path)."""

    def __init__(self, items: list[tuple]):
        self.items = items
        self.nodes: list[list] = []  # conv, depth, parent's conv, parent's key, convs, children, leaves, saved
        self.spine: list[tuple] = []  # key, keys above, depth, least conv, convs, words, children, leaves, saved
        self.members: list[tuple] = []  # conv, shared depth, its node's conv, keys
        paths = [i[2] for i in items]
        depth = [len(p) // CODE for p in paths]
        self.parent = list(range(len(items)))
        # lo, hi, depth, convs, least, children, leaves and saved below, rows of child nodes, items that share no more
        self.top: list[list] = []
        for i, (conv, turns, _, _) in enumerate(items):
            tail = int(turns > depth[i])
            self.top.append([i, i, depth[i], 1, conv, tail, tail, 0, [], []])
        edges = [(self.shared(a, b), i) for i, (a, b) in enumerate(zip(paths, paths[1:], strict=False))]
        for lcp, i in sorted(edges, key=lambda e: (-e[0], e[1])):
            self.merge(i, i + 1, lcp)
        root = self.find(0)
        if self.top[root][2] > 0:
            self.top[root] = self.hung(self.top[root], 0)
        self.close(self.top[root])
        self.to_spine(self.top[root], 0, *self.top[root][5:8])
        for i in sorted({0, len(items) - 1}):
            self.members.append((items[i][0], None, None, [key_of(paths[i][: d * CODE]) for d in range(depth[i] + 1)]))

    @staticmethod
    def shared(a: str, b: str) -> int:
        """Turns that two paths begin with alike."""
        n = min(len(a), len(b)) // CODE
        if a[: n * CODE] == b[: n * CODE]:
            return n
        low, high = 0, n  # alike in low turns, not in high
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if a[: mid * CODE] == b[: mid * CODE] else (low, mid)
        return low

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def on_spine(self, top: list) -> bool:
        return top[0] == 0 or top[1] == len(self.items) - 1

    def to_spine(self, top: list, depth: int, children: int, leaves: int, saved: int) -> None:
        path, words = self.items[top[0]][2], self.items[top[0]][3]
        above = [key_of(path[: d * CODE]) for d in range(depth)]
        self.spine.append((key_of(path[: depth * CODE]), above, depth, top[4], top[3], words[depth - 1] if depth else 0, children, leaves, saved))

    def close(self, top: list) -> None:
        """The node's members are known: tell its children and the items that share no more than it."""
        key = key_of(self.items[top[0]][2][: top[2] * CODE]) if self.on_spine(top) else None
        for row in top[8]:
            self.nodes[row][2:4] = (top[4], None) if key is None else (None, key)
        for i in top[9]:
            self.members.append((self.items[i][0], top[2], *((top[4], None) if key is None else (None, [key]))))

    def hung(self, top: list, depth: int) -> list:
        """The component as seen from a node above it, at ``depth``: the nodes between get their rows."""
        lo, hi, d, n, least, children, leaves, saved, _, _ = top
        singles = [lo] if n == 1 and 0 < lo < len(self.items) - 1 else []
        if self.on_spine(top):
            self.close(top)
            for x in range(d, depth, -1):
                self.to_spine(top, x, *((children, leaves, saved) if x == d else (0, 0, 0)))
            return [lo, hi, depth, n, least, 0, 0, 0, [], singles]
        leaves = leaves if children else 1
        if n == 1:
            return [lo, hi, depth, n, least, 1, 1, 0, [], singles]
        self.close(top)
        words = self.items[lo][3]
        for x in range(d, depth, -1):
            saved += (n - 1) * words[x - 1]
            self.nodes.append([least, x, least, None, n, children if x == d else 1, leaves, saved])
        return [lo, hi, depth, n, least, 1, leaves, saved, [len(self.nodes) - 1], singles]

    def merge(self, i: int, j: int, depth: int) -> None:
        a, b = self.find(i), self.find(j)
        x, y = ((self.hung(t, depth) if t[2] > depth else t if t[3] > 1 else [*t[:9], [t[0]] if 0 < t[0] < len(self.items) - 1 else []]) for t in (self.top[a], self.top[b]))
        big, small = (x, y) if len(x[8]) + len(x[9]) >= len(y[8]) + len(y[9]) else (y, x)
        big[8].extend(small[8])
        big[9].extend(small[9])
        self.parent[b] = a
        self.top[a] = [x[0], y[1], depth, x[3] + y[3], min(x[4], y[4]), x[5] + y[5], x[6] + y[6], x[7] + y[7], big[8], big[9]]


FOUND = "kind string, conv long, depth long, parent long, parent_key binary, n long, children long, leaves long, saved long, key binary, above array<binary>, words long, keys array<binary>"


def local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The finished nodes, the contracted forest and the conversations of each run of sorted items."""
    fresh()
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.list_(pa.binary())]

    def grown(items: list[tuple]) -> pa.RecordBatch:
        f = Forest(items)
        rows = [("node", c, d, p, pk, n, k, lv, s, None, None, None, None) for c, d, p, pk, n, k, lv, s in f.nodes]
        rows += [("spine", c, d, None, None, n, k, lv, s, key, above, w, None) for key, above, d, c, n, w, k, lv, s in f.spine]
        rows += [("member", c, s, node, None, None, None, None, None, None, None, None, keys) for c, s, node, keys in f.members]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    items: list[tuple] = []
    size = 0
    for batch in batches:
        for item in zip(*(batch.column(c).to_pylist() for c in ("conv", "turns", "path", "words")), strict=True):
            items.append(item)
            size += len(item[2])
            if len(items) >= RUN_CONVS or size >= RUN_BYTES:
                yield grown(items)
                items, size = [], 0
    if items:
        yield grown(items)


def ends_of(ends: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) from (node, depth, conv): the digest of a node's ids, streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for node, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (node, depth) != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (node, depth), hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["conv", "depth", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])], ["conv", "depth", "ends_sha256"])

    ordered = ends.select("node", "depth", "conv").repartition("node", "depth").sortWithinPartitions("node", "depth", "conv")
    return ordered.mapInArrow(run, "conv long, depth long, ends_sha256 string")


def trie_of_codes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The trie's nodes from (conv, pos, code, words) and every conversation's (conv, turns); both are read several times."""

    def paths(rows: DataFrame) -> DataFrame:
        path = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "code", "words"))).alias("t"))
        return path.select("conv", F.array_join("t.code", "").alias("path"), F.col("t.words").alias("words"))

    first = sizes.join(paths(turns.where(F.col("pos") < FIRST_TURNS)), "conv", "left")
    items = materialize(first.select("conv", "turns", F.coalesce("path", F.lit("")).alias("path"), F.coalesce("words", F.array().cast("array<long>")).alias("words")), "trie-items")
    longer = items.where(F.col("turns") > FIRST_TURNS).withColumn("same", F.sha2(F.col("path").cast("binary"), 256))
    alike = longer.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same")
    deep = materialize(longer.join(alike, "same").select("conv", "turns"), "trie-deep")
    if deep.limit(1).count():  # these are compared whole
        whole = deep.join(paths(turns.join(deep.select("conv"), "conv", "left_semi")), "conv")
        items = materialize(items.join(deep, "conv", "left_anti").unionByName(whole), "trie-items-whole")
    found = materialize(items.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv").mapInArrow(local_forests, FOUND), "trie-forests")

    # The contracted forests merged by prefix: a few nodes for each run.
    spine = found.where("kind = 'spine'").groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max("words").alias("words"),
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.first("above").alias("above"))
    spine = materialize(spine.withColumn("up", F.when(F.col("depth") > 0, F.element_at("above", -1))), "trie-spine")
    below = spine.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("more"))
    spine_all = spine.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    own = (F.col("n") - 1) * F.col("words")
    gives = spine_all.select(F.explode(F.concat("above", F.array("key"))).alias("key"), (F.col("leaves") + (F.col("children") == 0).cast("long")).alias("l"), (F.col("saved") + own).alias("s"))
    sums = gives.groupBy("key").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    names = spine.select(F.col("key").alias("up"), F.col("conv").alias("up_conv"))
    merged = spine_all.where("n > 1 or depth = 0").join(sums, "key").join(names, "up", "left").select(
        F.col("conv"), "depth", F.col("up_conv").alias("parent"), "n", "children", "n_leaves", "saved_tokens")
    inside = found.where("kind = 'node'").join(names, F.col("parent_key") == F.col("up"), "left").select(
        "conv", "depth", F.coalesce("parent", "up_conv").alias("parent"), "n", "children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))

    # Every conversation's deepest shared node: its own run knows it, or the merged spine does.
    member = found.where("kind = 'member'")
    at_key = member.where("keys is not null").select(F.col("conv").alias("c"), F.explode("keys").alias("key")).join(spine.where("n > 1 or depth = 0").select("key", "depth", "conv"), "key")
    deepest = at_key.groupBy("c").agg(F.max(F.struct("depth", "conv")).alias("d")).select(F.col("c").alias("conv"), F.col("d.depth").alias("depth"), F.col("d.conv").alias("node"))
    known = member.where("keys is null").select("conv", "depth", F.col("parent").alias("node")).unionByName(deepest)
    known = materialize(known.join(sizes, "conv"), "trie-members")

    ends = ends_of(known.where("turns = depth"))
    shared = merged.unionByName(inside).join(ends, ["conv", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    last = F.col("pos") + 1 == F.col("turns")
    private = turns.select("conv", "pos").join(known, "conv").where(F.col("pos") >= F.col("depth")).select(
        "conv", (F.col("pos") + 1).alias("depth"), F.when(F.col("pos") == F.col("depth"), F.col("node")).otherwise(F.col("conv")).alias("parent"),
        F.lit(1).cast("long").alias("n"), (~last).cast("long").alias("children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return shared.unionByName(private).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256")


def sizes_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv").agg(F.count("*").alias("turns"))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct sequence of first turns: conv_id (the smallest member) and depth name the node.

    Further columns: parent_conv_id, n_convs (members), n_children, n_leaves
    (childless nodes of its subtree, which holds the node), saved_tokens (over
    the subtree, (members - 1) times the words of the node's last text) and
    ends_sha256 (digest of the ascending ids, comma-joined, of members that end
    there).  Turns follow ``turn``, null first, then a code of role and text;
    a null role or text counts as empty, and repeated rows are turns of their
    own.  Turns are compared by 128 bits of SHA-256.  Rows without a conversation
    id belong to none and are left out; ids must be whole numbers.  Very long
    texts are hashed where they lie and travel no further.  A conversation of
    very many turns is spread over tasks; only the first ``FIRST_TURNS`` turns
    of it, or all if another one shares these, form one row.  An empty table
    gives an empty result; other columns are not read.
    """
    coded = materialize(code_turns(turns, conv_col, turn_col, role_col, text_col), "trie-turns")
    return trie_of_codes(coded, materialize(sizes_of(coded), "trie-sizes"))


def rebuilt_trie(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """:func:`conversation_trie` of rebuilt conversations.

    Conversation c takes the first h = crc32(decimal c) % ``most`` turns of
    conversation c - c % ``group`` (fewer if it has fewer, none if it is
    absent) and its own turns after its first h.  A conversation that is left
    without turns is a member of the root.
    """
    coded = materialize(code_turns(turns), "trie-turns")
    heads = coded.where((F.col("pos") < most - 1) & (F.col("conv") % group == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "code", "words"))).alias("first"))  # at most ``most`` - 1 turns
    convs = sizes_of(coded).withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")).withColumn("base", F.col("conv") - F.col("conv") % group)
    convs = convs.join(heads, "base", "left").withColumn("head", F.when(F.col("first").isNotNull() & (F.col("h") > 0), F.expr("slice(first, 1, h)")))
    convs = materialize(convs.select("conv", "turns", "h", "head", F.coalesce(F.size("head"), F.lit(0)).alias("n")).withColumn("n", F.greatest("n", F.lit(0))), "trie-convs")
    own = coded.join(convs.select("conv", "h", "n"), "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "code", "words")
    taken = convs.select("conv", F.posexplode("head").alias("pos", "t")).select("conv", F.col("pos").cast("long").alias("pos"), "t.code", "t.words")
    sizes = convs.select("conv", (F.col("n") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns"))
    return trie_of_codes(materialize(own.unionByName(taken), "trie-rebuilt"), sizes)
