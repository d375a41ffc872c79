"""Random forests and boosted regression trees on binned features, for many models at once.

Features are binned once, at up to 255 sketch quantiles; a null is a bin of its
own that each fit reads as the bin of its median.  Trees grow level by level,
all trees of a search together: one pass over the rows sums row weights and
targets per (tree, node, feature, bin), and every node takes its best cut.
Targets are whole numbers of a small unit, so sums are exact and the trees are the
same however the rows lie.

There are two ways to the same trees.  Where the binned table is below
``LOCAL_BYTES`` it is broadcast, and tasks share out the models; compiled loops
(:mod:`panelwright.operators.kernels`) grow them where the session can run these,
NumPy elsewhere.  Beyond that the rows stay where they are: each level is one
Arrow aggregate whose sums meet by node, and only the chosen cuts reach the driver.
"""

from __future__ import annotations

import json
import math
import pickle
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions._util import qcol
from panelwright.operators import kernels
from panelwright.operators.quantiles import column_quantiles
from panelwright.session import materialize

#: Bins of a feature (the last code marks a null), and bytes of a binned table that may be broadcast.
MAX_BINS, NULL_BIN, LOCAL_BYTES = 255, 255, 32 << 20
#: Most leaves of a boosted tree (fixed value of the protocol), and rounds after which boosted scores are written.
BOOST_LEAVES, SCORE_ROUNDS = 31, 10
#: Cells (tree x row x feature) that one step sums at a time.
CELLS = 1 << 22
#: Cells (tree x row x feature) that rows at hand grow together: few, so that they stay in the processor's cache.
STEP_CELLS = 1 << 18
#: Trees of a forest that one task of a search grows, and those that one task of a fit grows.
TASK_TREES, FIT_TREES = 100, 25
#: Most forests that a compiled task grows together, and the depth of a tree without limit.
MOST_TOGETHER, NO_LIMIT = 60, 1 << 30
#: Cells for each of their rows above which the rows are sorted, and for each row up to which all cells of a level are kept.
SPARSE, DENSE = 2, 1
#: Most cells of features that are summed as one code.
PACK_CELLS = 1 << 10
#: A cut must gain more than this share of its own scale.
LEAST_GAIN = 1e-9

POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(19)])
#: Draws by the first 16 bits of a share, and whether the rest of its bits matter.
DRAWS = np.searchsorted(POISSON, np.arange(1 << 16) / (1 << 16), side="right").astype(np.uint8)
MIXED = np.searchsorted(POISSON, np.arange(1, (1 << 16) + 1) / (1 << 16), side="right") != DRAWS


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    h = (np.asarray(h, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bootstrap(rows: np.ndarray, seeds: np.ndarray, fit: dict) -> np.ndarray:
    """(tree, row): how often a tree draws a row, Poisson with mean 1, from the row's and the tree's hashes."""
    if not fit.get("bootstrap", True):
        return np.ones((len(seeds), len(rows)))
    u = mix(rows.astype(np.uint64)[None, :] ^ mix(seeds)[:, None]) >> np.uint64(11)
    top = (u >> np.uint64(37)).astype(np.int64)
    out = DRAWS.take(top).astype(float)
    unsure = MIXED.take(top)
    out[unsure] = np.searchsorted(POISSON, u[unsure] * 2.0**-53, side="right")
    return out


def best_cuts(idx: np.ndarray, g: np.ndarray, h: np.ndarray, width: int, least: np.ndarray, l2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node with rows: (node, its g, its h, slot, bin, g left, h left, gain); slot -1 where no cut gains.

    ``idx`` is (node * width + slot) * 256 + bin, sorted; ``least`` and ``l2`` by node.
    Equal gains go to the first slot and bin.
    """
    seg = idx >> 8
    head = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    size = np.diff(np.append(head, len(idx)))
    cg, ch = np.cumsum(g), np.cumsum(h)  # whole numbers: differences are exact
    base_g, base_h = (np.concatenate([[0], c[head[1:] - 1]]) for c in (cg, ch))
    gl, hl = cg - np.repeat(base_g, size), ch - np.repeat(base_h, size)
    last = head + size - 1
    gt, ht = np.repeat(gl[last], size), np.repeat(hl[last], size)
    node = seg // width
    lam, few = l2[node], least[node]
    left = gl.astype(float) ** 2 / np.maximum(hl + lam, 1e-300)
    right = (gt - gl).astype(float) ** 2 / np.maximum(ht - hl + lam, 1e-300)
    gain = left + right - gt.astype(float) ** 2 / np.maximum(ht + lam, 1e-300)
    gain = np.where((hl >= few) & (ht - hl >= few) & (gain > LEAST_GAIN * (left + right)), gain, -1.0)
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    top = np.maximum.reduceat(gain, first)
    count = np.diff(np.append(first, len(idx)))
    winner = np.flatnonzero(gain == np.repeat(top, count))
    at = winner[np.unique(node[winner], return_index=True)[1]]
    slot = np.where(top > 0, (seg[at] % width), -1)
    return node[first], gt[first], ht[first], slot, idx[at] & 255, gl[at], hl[at], top


class Growth:
    """Trees that grow together; every argument is by tree.  ``features``: how many of the p features a node may cut."""

    def __init__(self, p: int, seed, depth, least, features, l2, leaves):
        self.p, n = p, len(seed)
        self.limit = np.array([d if d is not None else NO_LIMIT for d in depth])
        self.least, self.features = np.maximum(np.asarray(least, float), 1.0), np.asarray(features)
        self.l2, self.leaves_left = np.asarray(l2, float), np.asarray(leaves) - 1
        self.tree, self.key = np.arange(n), mix(np.asarray(seed, dtype=np.uint64))
        self.feature, self.cut = np.zeros(n, np.int16), np.zeros(n, np.uint8)
        self.child, self.g, self.h = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.begin, self.depth = 0, 0
        self.open = self.limit > 0
        self.choose()

    def choose(self) -> None:
        """The features that the nodes of this level may cut, ascending; -1 fills up."""
        width = int(self.features.max(initial=1))
        tree = self.tree[self.begin :]
        if width >= self.p:
            self.chosen = np.tile(np.arange(self.p), (len(tree), 1))
            short = self.features[tree] < self.p
        else:
            short = np.ones(len(tree), bool)
            self.chosen = np.zeros((len(tree), width), dtype=np.int64)
        if short.any():
            draw = mix(self.key[self.begin :][short][:, None] ^ mix(np.arange(1, self.p + 1))[None, :])
            rank = np.argsort(draw, axis=1)[:, : self.chosen.shape[1]]
            kept = np.arange(rank.shape[1])[None, :] < self.features[tree[short]][:, None]
            rank = np.sort(np.where(kept, rank, self.p), axis=1)
            self.chosen[short] = np.where(rank < self.p, rank, -1)

    @property
    def growing(self) -> bool:
        return bool(self.open.any())

    def walk(self, bins: np.ndarray, depths=None):
        """(tree, row): the node that each row lies in; ``depths`` as of :func:`walk`."""
        return walk(bins, np.arange(len(self.limit)), self.feature, self.cut, self.child, depths)

    def sums(self, bins: np.ndarray, nodes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(idx, g, h) over the open nodes, idx sorted; ``target`` and ``weight`` by row or by (tree, row)."""
        live = nodes >= self.begin
        live &= np.broadcast_to(weight, nodes.shape) > 0
        tree, row = np.nonzero(live)
        node = nodes[tree, row] - self.begin
        still = self.open[node]
        tree, row, node = tree[still], row[still], node[still]
        w = np.broadcast_to(weight, nodes.shape)[tree, row]
        return self.cells(Columns(bins), node, row, w, w * np.broadcast_to(target, nodes.shape)[tree, row])

    def cells(self, columns: Columns, node: np.ndarray, row: np.ndarray, w: np.ndarray | None, wg: np.ndarray, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(idx, g, h) of rows that lie in open nodes of this level, counted from its first; ``w`` None: all 1.

        Every (node, slot) has as many cells as its feature has bins.  ``held``: whether a node has rows, where not all open ones have.
        """
        width, count = self.chosen.shape[1], columns.count
        size = np.where(self.chosen >= 0, count[self.chosen], 0)
        size[~(self.open if held is None else held)] = 0
        start = np.zeros(size.size + 1, np.int64)
        np.cumsum(size.ravel(), out=start[1:])
        first, feature = (np.ascontiguousarray(x.T) for x in (start[:-1].reshape(size.shape), self.chosen))
        every = width == len(count) and bool((self.chosen == np.arange(width)).all())
        whole, base = bool((self.chosen >= 0).all()), row * len(count)
        found = []
        for slot in range(width):
            some = slice(None)
            if every:
                at = columns.by_column[slot].take(row)
            else:
                at = feature[slot].take(node)
                some = some if whole else np.flatnonzero(at >= 0)
                at = columns.flat.take(base[some] + at[some])
            found.append((first[slot].take(node[some]) + at, None if w is None else w[some], wg[some]))
        if start[-1] > len(node):  # many small nodes: all slots at once
            found = [tuple(None if x[0] is None else np.concatenate(x) for x in zip(*found, strict=True))]
        if len(found) == 1 and start[-1] > SPARSE * len(found[0][0]):  # most cells are empty: the rows are sorted
            at, w, wg = found[0]
            key = np.sort((at << 32) + np.arange(len(at)))
            at, by = key >> 32, key & 0xFFFFFFFF
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            h = np.diff(np.append(head, len(at))) if w is None else np.add.reduceat(w[by], head)
            held = at[head]
            segment = np.searchsorted(start, held, side="right") - 1
            return (segment << 8) + held - start[segment], np.add.reduceat(wg[by], head).astype(np.int64), h.astype(np.int64)
        g, h = np.zeros(start[-1]), np.zeros(start[-1])
        for at, ws, gs in found:
            h += np.bincount(at, ws, len(h))
            g += np.bincount(at, gs, len(g))
        held = np.flatnonzero(h)
        segment = np.repeat(np.arange(size.size), size.ravel())[held]
        return (segment << 8) + held - start[segment], g[held].astype(np.int64), h[held].astype(np.int64)

    def whole(self, columns: Columns, parents: list | None, still: np.ndarray, h: np.ndarray, node: np.ndarray, row: np.ndarray, w: np.ndarray | None, wg: np.ndarray) -> list[np.ndarray]:
        """g and h by (node, cell of any feature), right for nodes ``still`` open; of two children one is its parent less the other."""
        if parents is None:
            return columns.sums(node, row, w, wg, len(still))
        two, h = still.reshape(-1, 2), h.reshape(-1, 2)
        summed = 2 * np.arange(len(two)) + np.where(two.all(axis=1), h[:, 1] < h[:, 0], two[:, 1])
        place = np.full(len(still), -1)
        place[summed] = np.arange(len(two))
        at = place.take(node)
        mine = np.flatnonzero(at >= 0)
        got = columns.sums(at[mine], row[mine], None if w is None else w[mine], wg[mine], len(two))
        out = [np.empty((len(still), x.shape[1])) for x in got]
        for both, parent, part in zip(out, parents, got, strict=True):
            both[summed], both[summed ^ 1] = part, parent - part
        return out

    def spread(self, of: np.ndarray, idx: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(idx, g, h) of every open node of this level, from those of the twins that hold the rows (``of``: by node)."""
        size = self.chosen.shape[1] << 8
        count = np.bincount(idx // size, minlength=len(of))
        node = np.flatnonzero(self.open)
        twin = of[node]
        n = count[twin]
        at = np.repeat((np.cumsum(count) - count)[twin] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return idx[at] + np.repeat((node - twin) * size, n), g[at], h[at]

    def picked(self, columns: Columns, twins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(idx, g, h) of the chosen features of open nodes, from the sums of all by group of twins."""
        width = self.chosen.shape[1]
        size = np.where(self.chosen >= 0, columns.count[self.chosen], 0)
        size[~self.open] = 0
        size, chosen = size.ravel(), self.chosen.ravel()
        segment = np.repeat(np.arange(len(size)), size)
        cell = np.arange(len(segment)) - (np.cumsum(size) - size)[segment]
        at = twins[segment // width] * columns.first[-1] + columns.first[chosen[segment]] + cell
        h = h.ravel()[at]
        held = np.flatnonzero(h)
        return (segment[held] << 8) + cell[held], g.ravel()[at[held]].astype(np.int64), h[held].astype(np.int64)

    def cuts(self, idx: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        tree = self.tree[self.begin :]
        return best_cuts(idx, g, h, self.chosen.shape[1], self.least[tree], self.l2[tree])

    def split(self, node, g, h, slot, at, gl, hl, gain) -> None:
        """Cut the nodes of this level; where a tree may not have so many leaves, the cuts of most gain."""
        if self.depth == 0:
            self.g[node], self.h[node] = g, h
        cut = slot >= 0
        node, g, h, slot, at, gl, hl, gain = (x[cut] for x in (node, g, h, slot, at, gl, hl, gain))
        tree = self.tree[self.begin + node]
        many = np.bincount(tree, minlength=len(self.limit))
        if (many > self.leaves_left).any():
            order = np.lexsort((node, -gain, tree))
            new = np.concatenate([[True], tree[order][1:] != tree[order][:-1]])
            rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            kept = np.sort(order[rank < self.leaves_left[tree[order]]])
            node, g, h, slot, at, gl, hl, tree = (x[kept] for x in (node, g, h, slot, at, gl, hl, tree))
            many = np.bincount(tree, minlength=len(self.limit))
        self.leaves_left -= many
        parent, first = self.begin + node, len(self.tree)
        self.feature[parent], self.cut[parent] = self.chosen[node, slot], at
        self.child[parent] = first + 2 * np.arange(len(node))
        two = lambda a, b: np.stack([a, b], axis=1).ravel()
        key = self.key[parent]
        self.key = np.concatenate([self.key, two(mix(key ^ np.uint64(1)), mix(key ^ np.uint64(2)))])
        self.tree = np.concatenate([self.tree, np.repeat(tree, 2)])
        self.g, self.h = np.concatenate([self.g, two(gl, g - gl)]), np.concatenate([self.h, two(hl, h - hl)])
        none = np.zeros(2 * len(node))
        self.feature, self.cut = np.concatenate([self.feature, none.astype(np.int16)]), np.concatenate([self.cut, none.astype(np.uint8)])
        self.child = np.concatenate([self.child, np.full(2 * len(node), -1)])
        self.begin, self.depth = first, self.depth + 1
        now = self.tree[first:]
        self.open = (self.depth < self.limit[now]) & (self.h[first:] >= 2 * self.least[now]) & (self.leaves_left[now] > 0)
        self.choose()

    def values(self, unit: float) -> np.ndarray:
        """Each node's prediction: the mean target of its rows, shrunk by l2."""
        return self.g * unit / np.maximum(self.h + self.l2[self.tree], 1e-300)

    def grow(self, bins: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Grow to the end on rows at hand; the node of each (tree, row)."""
        self.fit(Columns(bins), target, weight)
        return self.walk(bins)

    def fit(self, columns: Columns, target: np.ndarray, weight: np.ndarray | None, rows: np.ndarray | None = None, alike: int = 1) -> np.ndarray | None:
        """Grow to the end on rows at hand; rows whose node is closed are left out from then on.

        ``rows``: those that take part, each once; ``target`` has them only, and the node of each (tree, row)
        of them is returned.  While a level has few cells for its
        rows, the sums of all its features are kept, and the larger of two children is their parent less the
        smaller; sums are whole numbers, so that is exact.

        ``alike``: so many trees next to each other have the same seed, features and weights (one row of ``weight``),
        and differ in their limits only.  Their nodes are twins, with the same rows, as long as they are cut alike:
        rows are held and summed once for all twins, and part where the limits make the cuts differ.
        """
        shape = (len(self.limit) // alike, columns.by_column.shape[1] if rows is None else len(rows))
        target = np.broadcast_to(target, shape).ravel()
        if rows is not None:
            at, w, wg = np.arange(target.size), None, target
        else:
            weight = np.broadcast_to(weight, shape).ravel()
            at = np.flatnonzero(weight)
            w = weight.take(at)
            wg = w * target.take(at)
            w = None if (w == 1).all() else w
        node, row = np.divmod(at, shape[1]) if shape[0] > 1 else (np.zeros(len(at), np.int64), at)
        ends, at = (None, None) if rows is None else (node.copy(), at)
        row = row if rows is None else rows.take(row)
        p, held = len(columns.count), None
        dense = 2 * self.chosen.shape[1] > len(columns.packs)
        keep = lambda kept, *xs: tuple(None if x is None else x.take(kept) for x in xs)
        twins = np.arange(len(self.limit)) // alike  # of each node of this level; rows lie in these groups
        while self.growing:
            groups, live = int(twins.max()) + 1, np.flatnonzero(self.open)[::-1]
            first_open, still = np.zeros(groups, np.int64), np.zeros(groups, bool)
            first_open[twins[live]], still[twins[live]] = live, True
            if not still.all():
                node, row, w, wg, at = keep(np.flatnonzero(still.take(node)), node, row, w, wg, at)
            if not len(node):
                break
            first = self.begin
            if dense and groups * columns.cells <= DENSE * len(node) and (held is not None or not self.depth):
                held = self.whole(columns, held, still, self.h[first + first_open], node, row, w, wg)
                sums = self.picked(columns, twins, *held)
            else:
                held = None
                if alike == 1:
                    sums = self.cells(columns, node, row, w, wg)
                else:
                    holds = np.zeros(len(self.open), bool)
                    holds[first_open[still]] = True
                    sums = self.spread(first_open[twins], *self.cells(columns, first_open.take(node), row, w, wg, holds))
            self.split(*self.cuts(*sums))
            feature, cut, child = (x[first : self.begin] for x in (self.feature, self.cut, self.child))
            done = np.flatnonzero(child >= 0)
            if not len(done):
                break
            # Twins that are cut alike stay twins: a group for each (group, feature, cut).
            kinds, new = np.unique((twins[done] * p + feature[done]) * 256 + cut[done], return_inverse=True)
            origin, feature, cut = kinds // (256 * p), kinds // 256 % p, kinds % 256
            twins = np.stack([2 * new, 2 * new + 1], axis=1).ravel()
            if held is not None:
                held = [x[origin] for x in held]
            parts = np.bincount(origin, minlength=groups)
            start = np.cumsum(parts) - parts
            kind = start.take(node)
            if (parts > 1).any():
                n = parts.take(node)
                kind = np.repeat(kind - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row, w, wg, at = keep(np.repeat(np.arange(len(node)), n), row, w, wg, at)
            elif not parts.all():
                kept = np.flatnonzero(parts.take(node))
                kind, row, w, wg, at = keep(kept, kind, row, w, wg, at)
            node = 2 * kind + (columns.flat.take(row * p + feature.take(kind)) > cut.take(kind))
            if at is not None:
                ends[at] = node + self.begin
        return None if rows is None else ends.reshape(shape)


class Columns:
    """Bins of rows at hand as the sums read them, and how many each feature has."""

    def __init__(self, bins: np.ndarray):
        self.flat = np.ascontiguousarray(bins).ravel()
        self.by_column = np.ascontiguousarray(bins.T)
        self.count = bins.max(axis=0, initial=0).astype(np.int64) + 1
        self.first = np.append(0, np.cumsum(self.count))  # of each feature's cells, all features side by side

    @cached_property
    def packs(self) -> list[tuple[list[int], np.ndarray]]:
        """Features of few bins share a code: (features, code by row, the last feature's bins next to each other)."""
        packs: list[list[int]] = []
        for j in np.argsort(-self.count, kind="stable").tolist():
            fits = [x for x in packs if self.count[x].prod() * self.count[j] <= PACK_CELLS]
            if fits:
                fits[0].append(j)
            else:
                packs.append([j])
        return [(x, np.ravel_multi_index(tuple(self.by_column[x].astype(np.int64)), tuple(self.count[x])).astype(np.int32)) for x in packs]

    @cached_property
    def cells(self) -> int:
        """Cells of a node: those of its codes or of its features, whichever are more."""
        return int(max(self.first[-1], sum(self.count[x].prod() for x, _ in self.packs)))

    def sums(self, node: np.ndarray, row: np.ndarray, w: np.ndarray | None, wg: np.ndarray, n: int) -> list[np.ndarray]:
        """g and h by (one of n nodes, cell of any feature)."""
        out = [np.empty((n, self.first[-1])) for _ in range(2)]
        for features, code in self.packs:
            shape = self.count[features]
            at = code.take(row)
            at = at + node * shape.prod() if n > 1 else at
            for to, x in zip(out, (wg, w), strict=True):
                cube = np.bincount(at, x, n * shape.prod()).reshape(n, *shape)
                for i, j in enumerate(features):
                    to[:, self.first[j] : self.first[j + 1]] = cube.sum(axis=tuple(k + 1 for k in range(len(features)) if k != i))
        return out


def walk(bins: np.ndarray, roots: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, depths=None):
    """(tree, row): the node that each row ends in, from each root; rows that have ended go no further.

    ``depths``, rising: a list, with the node at each of these depths (None: the end).
    """
    n, p = bins.shape
    flat = np.ascontiguousarray(bins).ravel()
    out = np.repeat(roots.astype(np.int64), n)
    base = np.tile(np.arange(n) * p, len(roots))
    at, node = None, out
    if depths is not None:
        found, depth = [], 0
        for limit in depths:
            while len(node) and (limit is None or depth < limit):
                below = child[node]
                go = below >= 0
                if not go.all():
                    at = np.flatnonzero(go) if at is None else at[go]
                    node, below, base = node[go], below[go], base[go]
                node = below + (flat[base + feature[node]] > cut[node])
                depth += 1
                if at is None:
                    out = node
                else:
                    out[at] = node
            found.append(out.reshape(len(roots), n).copy())
        return found
    while True:
        below = child[node]
        go = below >= 0
        if not go.all():
            at = np.flatnonzero(go) if at is None else at[go]
            node, below, base = node[go], below[go], base[go]
        if not len(node):
            return out.reshape(len(roots), n)
        node = below + (flat[base + feature[node]] > cut[node])
        if at is None:
            out = node
        else:
            out[at] = node


# ------------------------------------------------------------- binned tables

def seeds_of(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed << 20))


def share_of(share, p: int) -> int:
    return max(1, int(math.sqrt(p)) if share == "sqrt" else int(share * p))


def growth_of(kind: str, p: int, fits: list[dict], seed: int) -> Growth:
    """The trees that the fits grow next: all trees of each forest, or one round of each boosting."""
    if kind == "forest":
        rows = [(s, f) for f in fits for s in seeds_of(f["n_trees"], seed)]
    else:
        rows = [(np.uint64(seed), f) for f in fits]
    return Growth(
        p, [s for s, _ in rows], [f["max_depth"] for _, f in rows], [f["min_leaf"] for _, f in rows],
        [share_of(f.get("feature_share", 1.0), p) for _, f in rows], [f.get("l2", 0.0) for _, f in rows],
        [BOOST_LEAVES if kind == "boost" else 1 << 40 for _ in rows])


@dataclass
class Binned:
    """A binned table (row, fold, y, bins) with its cuts, the bins of the medians by fold (-1: all rows), and its unit."""

    rows: DataFrame
    edges: list[np.ndarray]
    fill: dict[int, np.ndarray]
    base: dict[int, float]
    unit: float
    n: int

    @property
    def p(self) -> int:
        return len(self.edges)

    @property
    def small(self) -> bool:
        return self.n * (self.p + 24) <= LOCAL_BYTES

    @cached_property
    def sent(self):
        """The table in the executors' JVMs for the compiled loops; None where these can not run (its size is checked by the caller)."""
        batches = self.rows.toArrow().combine_chunks().to_batches()
        return kernels.send(self.rows.sparkSession, kernels.table_bytes(*block_of(batches[0], self.p))) if batches else None


def bin_edges(df: DataFrame, cols) -> list[np.ndarray]:
    """Cut points of each column: midpoints of neighbouring sketch quantiles."""
    shares = F.array(*[F.lit(i / (MAX_BINS - 1)) for i in range(MAX_BINS)])
    clean = [F.nanvl(qcol(c).cast("double"), F.lit(None)) for c in cols]
    row = df.agg(*[F.percentile_approx(x, shares, F.lit(100_000)).alias(f"c{i}") for i, x in enumerate(clean)]).first()
    found = [np.unique(np.array(row[f"c{i}"] or [], dtype=float)) for i in range(len(cols))]
    return [(u[1:] + u[:-1]) / 2 for u in found]


def codes_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a matrix of values."""
    out = np.full(x.shape, NULL_BIN, dtype=np.uint8)
    for j, e in enumerate(edges):
        ok = ~np.isnan(x[:, j])
        out[ok, j] = np.searchsorted(e, x[ok, j], side="left")
    return out


def bin_rows(df: DataFrame, id_col: str, xcols, ycol: str, fold: Column, k: int) -> Binned:
    """Bin the rows that have an outcome, once for all fits."""
    xcols = list(xcols)
    plain = df.select(qcol(id_col).alias("__id"), *[qcol(c).cast("double").alias(f"x{i}") for i, c in enumerate(xcols)], F.nanvl(qcol(ycol).cast("double"), F.lit(None)).alias("y"), fold.alias("fold")).where("y is not null")
    names = [f"x{i}" for i in range(len(xcols))]
    edges = bin_edges(plain, names)
    folds = [*range(k), -1]
    masked = {f"{f}|{c}": F.when(F.col("fold") != f, F.col(c)) for f in folds for c in names}
    medians = {r["column"]: r["quantile"] for r in column_quantiles(plain, masked, [0.5]).collect()}
    fill = {f: np.array([int(np.searchsorted(e, medians.get(f"{f}|{c}", 0.0), side="left")) for c, e in zip(names, edges, strict=True)], dtype=np.uint8) for f in folds}
    p = len(names)

    def code(batches):
        for batch in batches:
            x = np.column_stack([batch.column(3 + j).to_numpy(zero_copy_only=False).astype(float) for j in range(p)])
            raw = codes_of(x, edges).tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(3)), pa.array([raw[i * p : (i + 1) * p] for i in range(len(x))], pa.binary())], ["row", "fold", "y", "bins"])

    coded = plain.select(F.xxhash64("__id"), F.col("fold").cast("int"), "y", *names).mapInArrow(code, "row long, fold int, y double, bins binary")
    rows = materialize(coded, "trees-binned")
    total = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.max(F.abs("y")).alias("m")).collect()  # at most k rows
    n, most = sum(r["n"] for r in total), max((r["m"] for r in total), default=0.0)
    # Sums of n targets, each drawn up to 16 times, stay whole numbers below 2 ** 53.
    unit = 2.0 ** (math.ceil(math.log2(max(n, 1) * 64 * max(most, 1e-300))) - 52)
    base = {}
    for f in folds:
        part = [r for r in total if r["fold"] != f]
        base[f] = round(sum(r["s"] for r in part) / max(sum(r["n"] for r in part), 1) / unit) * unit
    return Binned(rows, edges, fill, base, unit, n)


def block_of(batch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, p)
    return tuple(batch.column(c).to_numpy() for c in ("row", "fold", "y")) + (bins,)


def filled(bins: np.ndarray, fill: np.ndarray) -> np.ndarray:
    return np.where(bins == NULL_BIN, fill[None, :], bins)


# --------------------------------------------- the broadcast way: models shared out

def forest_here(block, binned_fill, unit: float, fit: dict, fold: int, seed: int, first: int, last: int, limits: list[dict] | None = None):
    """Trees ``first`` to ``last`` of a forest on rows at hand, in steps.

    ``limits``: forests that differ from ``fit`` in depth and least leaf only, grown together; tree i of
    forest j is tree i * len(limits) + j of its step.
    """
    own = block[1] != fold
    row, y, bins = (block[i][own] for i in (0, 2, 3))
    bins = filled(bins, binned_fill)
    columns = Columns(bins)
    target = np.rint(y / unit)
    width, limits = share_of(fit["feature_share"], bins.shape[1]), limits or [fit]
    step = max(1, STEP_CELLS // max(1, len(y) * width))
    for a in range(first, last, step):
        seeds = seeds_of(min(a + step, last), seed)[a:]
        n, alike = len(seeds), len(limits)
        g = Growth(bins.shape[1], np.repeat(seeds, alike), [f["max_depth"] for f in limits] * n, [f["min_leaf"] for f in limits] * n, [width] * (n * alike), [0.0] * (n * alike), [1 << 40] * (n * alike))
        g.fit(columns, target, bootstrap(row, seeds, fit), alike=alike)
        yield g


def boost_here(block, binned_fill, unit: float, base: float, fits: list[dict], fold: int, seed: int):
    """Rounds of several boostings on rows at hand: (fits that took part, growth, scores of the rows held out by fit)."""
    row, of_fold, y, bins = block
    bins = filled(bins, binned_fill)
    own, out = np.flatnonzero(of_fold != fold), np.flatnonzero(of_fold == fold)
    columns, target, held_out = Columns(bins), y[own], bins[out]
    score, unseen = (np.full((len(fits), len(x)), base) for x in (own, out))
    rate = np.array([f["learning_rate"] for f in fits])
    for r in range(max(f["n_rounds"] for f in fits)):
        on = [i for i, f in enumerate(fits) if r < f["n_rounds"]]
        g = growth_of("boost", bins.shape[1], [fits[i] for i in on], seed)
        ends = g.fit(columns, np.rint((target - score[on]) / unit), None, own)
        value = g.values(unit)
        score[on] += rate[on, None] * value[ends]
        unseen[on] += rate[on, None] * value[g.walk(held_out)]
        yield on, g, unseen


def shared_out(binned: Binned, tasks: list, work, schema: str) -> DataFrame:
    """``work(block, task)`` -> rows, for every task on the broadcast table (its size is checked by the caller)."""
    spark = binned.rows.sparkSession
    held = spark.sparkContext.broadcast(binned.rows.toArrow().combine_chunks().to_batches()[0])
    p = binned.p
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        block = block_of(held.value, p)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                rows = work(block, tasks[i])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, schema)


def forest_task(binned: Binned, fits: list[dict], fold: int, seed: int, first: int, last: int, emit: bool = False) -> bytes:
    """Trees ``first`` to ``last`` of forests that differ in :data:`LIMITS` only: their part of the errors on the fold held out, or their nodes."""
    least = sorted({max(float(f["min_leaf"]), 1.0) for f in fits})
    limits = [(NO_LIMIT if f["max_depth"] is None else f["max_depth"], least.index(max(float(f["min_leaf"]), 1.0)), max(0, min(f["n_trees"], last) - first), f["n_trees"]) for f in fits]
    return kernels.words(0, fold, *binned.fill[fold], share_of(fits[0]["feature_share"], binned.p), fits[0].get("bootstrap", True), emit, first == 0, binned.unit, LEAST_GAIN,
                         seeds_of(last, seed)[first:], POISSON, least, len(fits), *[x for limit in limits for x in limit])


def boost_task(binned: Binned, fits: list[dict], fold: int, emit: bool = False) -> bytes:
    """Boostings that differ in their rounds only, the fewest first: the errors of each on the fold held out, or the nodes of every round."""
    f = fits[0]
    return kernels.words(1, fold, *binned.fill[fold], emit, BOOST_LEAVES, NO_LIMIT if f["max_depth"] is None else f["max_depth"], float(f["learning_rate"]), float(binned.base[fold]),
                         max(float(f["min_leaf"]), 1.0), float(f["l2"]), binned.unit, LEAST_GAIN, [x["n_rounds"] for x in fits])


def trees_of_bytes(raw: bytes) -> list[tuple]:
    """(feature, cut, child, value) of every tree that a compiled task wrote."""
    out, at = [], 0
    while at < len(raw):
        n = int(np.frombuffer(raw, "<i8", 1, at)[0])
        at, parts = at + 8, []
        for kind, size in (("<f8", 8), ("<i4", 4), ("<i2", 2), ("u1", 1)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * size
        value, child, feature, cut = parts
        out.append((feature, cut, child, value))
    return out


def side_by_side(grown: list[tuple]) -> tuple:
    """(roots, feature, cut, child, value) of several trees, their roots first."""
    n, out = len(grown), []
    start = n - 1 + np.cumsum([0, *[len(t[0]) - 1 for t in grown]])
    parts = [(f, c, np.where(child >= 0, child + at, -1).astype(np.int32), v) for (f, c, child, v), at in zip(grown, start, strict=False)]
    for x in zip(*parts, strict=True):
        out.append(np.concatenate([np.array([a[0] for a in x], x[0].dtype), *[a[1:] for a in x]]))
    return n, *out


# ------------------------------------------------ the distributed way: rows stay put

def grow_by_levels(rows: DataFrame, growths: dict[int, Growth], p: int, fill: dict, prepare) -> None:
    """Grow the trees of each fold to the end; one job a level.

    ``prepare(block, fold, bins)`` gives a block's targets (by tree or not) and
    weights; it runs in the tasks.
    """
    sc = rows.sparkSession.sparkContext
    while any(g.growing for g in growths.values()):
        state = sc.broadcast({f: g for f, g in growths.items() if g.growing})

        def sums(batches, state=state):
            held: dict[int, tuple] = {}
            for batch in batches:
                whole = block_of(batch, p)
                for f, g in state.value.items():
                    step = max(1, CELLS // max(1, len(g.limit) * g.chosen.shape[1]))
                    for a in range(0, len(whole[0]), step):
                        block = tuple(x[a : a + step] for x in whole)
                        bins = filled(block[3], fill[f])
                        extra = batch.slice(a, step)
                        target, weight = prepare(extra, block, f, bins)
                        got = g.sums(bins, g.walk(bins), target, weight)
                        if f in held:
                            got = tuple(np.concatenate(x) for x in zip(held[f], got, strict=True))
                            idx, at = np.unique(got[0], return_inverse=True)
                            folded = [np.zeros(len(idx), np.int64) for _ in range(2)]
                            for out, x in zip(folded, got[1:], strict=True):
                                np.add.at(out, at, x)
                            got = (idx, *folded)
                        held[f] = got
            for f, (idx, gs, hs) in held.items():
                if not len(idx):
                    continue
                size = state.value[f].chosen.shape[1] << 8
                node = idx // size
                head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
                tail = np.append(head[1:], len(idx))
                blobs = [[x[a:b].tobytes() for a, b in zip(head, tail, strict=True)] for x in (idx % size, gs, hs)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(head), f, np.int32)), pa.array(node[head]), *(pa.array(x, pa.binary()) for x in blobs)], ["fold", "node", "idx", "g", "h"])

        def choose(batches, state=state):
            now, parts = None, []

            def done():
                f, node = now
                g = state.value[f]
                idx, gs, hs = (np.concatenate([np.frombuffer(x[i], np.int64) for x in parts]) for i in range(3))
                idx, at = np.unique(idx, return_inverse=True)
                sums_ = [np.zeros(len(idx), np.int64) for _ in range(2)]
                np.add.at(sums_[0], at, gs)
                np.add.at(sums_[1], at, hs)
                size = g.chosen.shape[1] << 8
                return (f, *(x[0] for x in g.cuts(idx + node * size, *sums_)))

            found = []
            for batch in batches:
                for f, node, idx, gs, hs in zip(*(batch.column(c).to_pylist() for c in ("fold", "node", "idx", "g", "h")), strict=True):
                    if (f, node) != now:
                        if parts:
                            found.append(done())
                        now, parts = (f, node), []
                    parts.append((idx, gs, hs))
            if parts:
                found.append(done())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), CUT_KINDS, strict=True)], CUT_NAMES)

        met = rows.mapInArrow(sums, "fold int, node long, idx binary, g binary, h binary").repartition("fold", "node").sortWithinPartitions("fold", "node")
        cuts = met.mapInArrow(choose, CUT_SCHEMA).toPandas().sort_values(["fold", "node"])  # one row an open node
        for f, g in growths.items():
            if g.growing:
                part = cuts[cuts["fold"] == f]
                if part.empty:
                    g.open[:] = False
                else:
                    g.split(*(part[c].to_numpy() for c in CUT_NAMES[1:]))
        state.unpersist()


CUT_NAMES = ["fold", "node", "total_g", "total_h", "slot", "bin", "left_g", "left_h", "gain"]
CUT_KINDS = [pa.int32(), *[pa.int64()] * 7, pa.float64()]
CUT_SCHEMA = "fold int, node long, total_g long, total_h long, slot long, bin long, left_g long, left_h long, gain double"


def forest_by_levels(binned: Binned, fit: dict, folds: list[int], seed: int) -> dict[int, Growth]:
    growths = {f: growth_of("forest", binned.p, [fit], seed) for f in folds}
    seeds, unit = seeds_of(fit["n_trees"], seed), binned.unit

    def prepare(batch, block, fold, bins):
        return np.rint(block[2] / unit), bootstrap(block[0], seeds, fit) * (block[1] != fold)

    grow_by_levels(binned.rows, growths, binned.p, binned.fill, prepare)
    return growths


def boost_by_levels(binned: Binned, fits: list[dict], folds: list[int], seed: int):
    """(rows with a column of scores, rounds): every round of all fits and folds in lockstep.

    Scores of a row are worked out from the rounds since they were last
    written, so a lost executor costs its tasks only.
    """
    unit, p, fill, base = binned.unit, binned.p, binned.fill, binned.base
    rate = np.array([f["learning_rate"] for f in fits])
    rows, since, rounds = binned.rows, [], []
    sc = binned.rows.sparkSession.sparkContext

    def scores(batch, block, fold, bins, past):
        n = len(block[0])
        if "score" in batch.schema.names:
            held = np.frombuffer(b"".join(batch.column("score").to_pylist()), float).reshape(n, len(folds), len(fits))
            score = held[:, folds.index(fold), :].T.copy()
        else:
            score = np.full((len(fits), n), base[fold])
        for on, growths in past:
            g = growths[fold]
            score[on] += rate[on, None] * g.values(unit)[g.walk(bins)]
        return score

    def written(rows, past):
        def run(batches):
            for batch in batches:
                block = block_of(batch, p)
                made = np.stack([scores(batch, block, f, filled(block[3], fill[f]), past.value).T for f in folds], axis=1)
                blobs = [x.tobytes() for x in np.ascontiguousarray(made)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "fold", "y", "bins")), pa.array(blobs, pa.binary())], ["row", "fold", "y", "bins", "score"])

        return materialize(rows.mapInArrow(run, "row long, fold int, y double, bins binary, score binary"), "trees-scores")

    for r in range(max(f["n_rounds"] for f in fits)):
        on = [i for i, f in enumerate(fits) if r < f["n_rounds"]]
        growths = {f: growth_of("boost", p, [fits[i] for i in on], seed) for f in folds}
        past = sc.broadcast(list(since))

        def prepare(batch, block, fold, bins, past=past, on=on):
            return np.rint((block[2] - scores(batch, block, fold, bins, past.value)[on]) / unit), (block[1] != fold).astype(float)

        grow_by_levels(rows, growths, p, fill, prepare)
        since.append((on, growths))
        rounds.append((on, growths))
        if len(since) == SCORE_ROUNDS:
            rows, since = written(rows, sc.broadcast(list(since))), []
    if since:
        rows = written(rows, sc.broadcast(list(since)))
    return rows, rounds


# ------------------------------------------------------------------ search

ERRORS, PARTS = "draw int, fold int, sse double, n long", "draw int, fold int, first int, errors binary"


def deep(depth: int | None) -> float:
    return math.inf if depth is None else depth


#: Limits of a forest: its seeds and draws do not depend on them.
LIMITS = ("n_trees", "max_depth", "min_leaf")


def nested(fits: list[dict], but=LIMITS[:2]) -> list[list[int]]:
    """Forests that are equal ``but`` for these limits, which have the same seeds and draws.

    A tree of less depth is the top of the deeper one, few trees are the first of many, and trees of other
    least leaves are twins as far as they are cut alike.
    """
    groups: dict[str, list[int]] = {}
    for d, fit in enumerate(fits):
        groups.setdefault(params_text({k: v for k, v in fit.items() if k not in but}), []).append(d)
    return list(groups.values())


def met(parts: pd.DataFrame) -> pd.DataFrame:
    """The squared errors of a fit on a fold, from the parts of its errors."""
    error = sum(np.frombuffer(x) for x in parts.sort_values("first")["errors"])
    return pd.DataFrame({"draw": parts["draw"][:1], "fold": parts["fold"][:1], "sse": float(error @ error), "n": len(error)})


def compiled_errors(binned: Binned, kind: str, fits: list[dict], k: int, seed: int) -> DataFrame:
    """:func:`fold_errors` by the compiled loops: tasks of forests that differ in limits only, or of boostings that differ in rounds only."""
    tasks = []
    for some in nested(fits, LIMITS if kind == "forest" else ("n_rounds",)):
        some = sorted(some, key=lambda d: fits[d]["n_trees" if kind == "forest" else "n_rounds"])
        for a in range(0, len(some), MOST_TOGETHER):
            part = some[a : a + MOST_TOGETHER]
            for first in range(0, fits[part[-1]]["n_trees"], TASK_TREES) if kind == "forest" else (0,):
                tasks += [([d for d in part if kind == "boost" or fits[d]["n_trees"] > first], f, first) for f in range(k)]
    depth = lambda d: min(deep(fits[d]["max_depth"]), 20)
    cost = lambda t: share_of(fits[t[0][0]]["feature_share"], binned.p) * sum(map(depth, t[0])) if kind == "forest" else fits[t[0][-1]]["n_rounds"] * depth(t[0][-1])
    tasks.sort(key=lambda t: (-cost(t), t))
    if kind == "forest":
        raw = [forest_task(binned, [fits[d] for d in some], f, seed, first, min(first + TASK_TREES, fits[some[-1]]["n_trees"])) for some, f, first in tasks]
    else:
        raw = [boost_task(binned, [fits[d] for d in some], f) for some, f, _ in tasks]

    def parts(batches):
        for batch in batches:
            for i, found in zip(*(batch.column(c) for c in ("id", "found")), strict=True):
                some, f, first = tasks[i.as_py()]
                held = found.as_buffer()
                size = held.size // len(some)
                rows = [(np.int32(d), np.int32(f), np.int32(first), held[j * size : (j + 1) * size].to_pybytes()) for j, d in enumerate(some)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], [c.split()[0] for c in PARTS.split(", ")])

    return kernels.run_tasks(binned.rows.sparkSession, binned.sent, raw).mapInArrow(parts, PARTS).groupBy("draw", "fold").applyInPandas(met, ERRORS)


def fold_errors(binned: Binned, kind: str, fits: list[dict], k: int, seed: int) -> DataFrame:
    """(draw, fold, sse, n): squared errors of every fit on the fold that it did not see."""
    p, fill, unit, base = binned.p, binned.fill, binned.unit, binned.base
    folds = list(range(k))
    if binned.small and binned.sent is not None:
        return compiled_errors(binned, kind, fits, k, seed)
    if binned.small:
        if kind == "forest":
            tasks = [(tuple(some), f, first) for some in nested(fits, LIMITS) for first in range(0, max(fits[d]["n_trees"] for d in some), TASK_TREES) for f in folds]
            cells = lambda t: share_of(fits[t[0][0]]["feature_share"], p) * sum(min(deep(fits[d]["max_depth"]), 20) for d in t[0] if fits[d]["n_trees"] > t[2])
            tasks.sort(key=lambda t: (-cells(t), t))

            def work(block, task):
                some, f, first = task
                some = [d for d in some if fits[d]["n_trees"] > first]
                val = block[1] == f
                held_out = filled(block[3][val], fill[f])
                total = {d: np.zeros(int(val.sum())) for d in some}
                begin = first
                for last in sorted({min(fits[d]["n_trees"], first + TASK_TREES) for d in some}):
                    now = [d for d in some if fits[d]["n_trees"] >= last]
                    groups = [[now[i] for i in x] for x in nested([fits[d] for d in now])]
                    depths = [sorted({fits[d]["max_depth"] for d in x}, key=deep) for x in groups]
                    limits = [{**fits[x[0]], "max_depth": to[-1]} for x, to in zip(groups, depths, strict=True)]
                    for g in forest_here(block, fill[f], unit, fits[now[0]], f, seed, begin, last, limits):
                        value = g.values(unit)
                        for i, same in enumerate(groups):
                            roots = np.arange(i, len(g.limit), len(groups))
                            for depth, nodes in zip(depths[i], walk(held_out, roots, g.feature, g.cut, g.child, depths[i]), strict=True):
                                for tree in value[nodes]:
                                    for d in same:
                                        if fits[d]["max_depth"] == depth:
                                            total[d] += tree
                    begin = last
                # The trees of a forest are grown by several tasks; their parts of its errors meet below.
                return [(np.int32(d), np.int32(f), np.int32(first), ((block[2][val] if first == 0 else 0.0) - total[d] / fits[d]["n_trees"]).tobytes()) for d in some]

            return shared_out(binned, tasks, work, PARTS).groupBy("draw", "fold").applyInPandas(met, ERRORS)
        else:
            order = sorted(range(len(fits)), key=lambda i: (-fits[i]["n_rounds"], fits[i]["max_depth"] or 99, i))
            together = min(5, max(1, STEP_CELLS // (binned.n * p)))
            tasks = [(order[a : a + together], f) for a in range(0, len(order), together) for f in folds]

            def work(block, task):
                some, f = task
                val = block[1] == f
                for _, _, score in boost_here(block, fill[f], unit, base[f], [fits[i] for i in some], f, seed):
                    pass
                error = block[2][val] - score
                return [(np.int32(i), np.int32(f), float(e @ e), len(e)) for i, e in zip(some, error, strict=True)]

        return shared_out(binned, tasks, work, ERRORS)

    if kind == "boost":
        rows, _ = boost_by_levels(binned, fits, folds, seed)

        def score(batches):
            for batch in batches:
                _, of_fold, y, _ = block_of(batch, p)
                held = np.frombuffer(b"".join(batch.column("score").to_pylist()), float).reshape(len(y), k, len(fits))
                for f in np.unique(of_fold).tolist():
                    own = of_fold == f
                    error = ((y[own, None] - held[own, f, :]) ** 2).sum(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fits), dtype=np.int32)), pa.array(np.full(len(fits), f, np.int32)), pa.array(error), pa.array(np.full(len(fits), own.sum()))], ["draw", "fold", "sse", "n"])

        return rows.mapInArrow(score, ERRORS).groupBy("draw", "fold").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n"))

    out = None
    for d, fit in enumerate(fits):
        growths = binned.rows.sparkSession.sparkContext.broadcast(forest_by_levels(binned, fit, folds, seed))

        def score(batches, d=d, growths=growths):
            for batch in batches:
                _, of_fold, y, bins = block_of(batch, p)
                for f in np.unique(of_fold).tolist():
                    g, own = growths.value[f], np.flatnonzero(of_fold == f)
                    step = max(1, CELLS // len(g.limit))
                    parts = [own[a : a + step] for a in range(0, len(own), step)]
                    error = sum(float(((y[i] - g.values(unit)[g.walk(filled(bins[i], fill[f]))].mean(axis=0)) ** 2).sum()) for i in parts)
                    yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([f], pa.int32()), pa.array([error]), pa.array([len(own)])], ["draw", "fold", "sse", "n"])

        part = materialize(binned.rows.mapInArrow(score, ERRORS).groupBy("draw", "fold").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n")), "trees-errors")
        out = part if out is None else out.unionByName(part)
    return out


def search_trees(train: DataFrame, id_col: str, xcols, ycol: str, kind: str, fits: list[dict], fold: Column, k: int, seed: int, binned: Binned | None = None) -> list[dict]:
    """Every fit's RMSE on each fold and their mean over the folds; ``kind`` is ``forest`` or ``boost``.

    ``binned``: what :func:`bin_rows` made of the same arguments, where several searches share it.
    """
    binned = binned or bin_rows(train, id_col, xcols, ycol, fold, k)
    scores: dict[int, dict[int, float]] = {}
    for r in fold_errors(binned, kind, fits, k, seed).collect():  # fits x folds rows
        if r["n"]:
            scores.setdefault(r["draw"], {})[r["fold"]] = math.sqrt(r["sse"] / r["n"])
    return [{"draw": d, "params": fits[d], "fold_rmse": [s[f] for f in sorted(s)], "cv_rmse": float(np.mean([s[f] for f in sorted(s)]))} for d, s in sorted(scores.items())]


# ------------------------------------------------------------- fitted models

@dataclass
class TreeModel:
    """A fitted forest or boosting: its trees side by side, with the cuts and medians that its features need."""

    kind: str
    params: dict
    edges: list[np.ndarray]
    fill: np.ndarray
    base: float
    rate: float
    trees: list[tuple]  # roots, feature, cut, child, value
    sent: tuple | None = None  # the application that :meth:`predict` last ran in, and the model there (None: the compiled loops can not run)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Predictions of a matrix of values (NaN: missing)."""
        bins = filled(codes_of(x, self.edges), self.fill)
        out = np.zeros(len(x))
        n = 0
        for roots, feature, cut, child, value in self.trees:
            step = max(1, CELLS // max(1, len(x)))
            for a in range(0, roots, step):
                nodes = walk(bins, np.arange(a, min(a + step, roots)), feature, cut, child)
                out += value[nodes].sum(axis=0)
            n += roots
        return self.base + self.rate * out if self.kind == "boost" else out / n

    def predict(self, df: DataFrame, cols) -> DataFrame:
        """``df`` plus ``prediction``; the model is broadcast (its size is the trees', not the rows')."""
        values = [qcol(c).cast("double") for c in cols]
        if self.sent is None or self.sent[0] != df.sparkSession.sparkContext.applicationId:
            self.sent = df.sparkSession.sparkContext.applicationId, kernels.send(df.sparkSession, kernels.model_bytes(self))
        if self.sent[1] is not None:
            return df.withColumn("prediction", kernels.scores(df.sparkSession, self.sent[1], F.array(*values)))
        held = df.sparkSession.sparkContext.broadcast(replace(self, sent=None))

        @F.pandas_udf("double")
        def prediction(x: pd.Series) -> pd.Series:
            m = np.array(x.tolist(), dtype=float).reshape(len(x), -1)
            return pd.Series(np.concatenate([held.value.score(m[a : a + 4096]) for a in range(0, len(m), 4096)]) if len(m) else np.zeros(0))

        return df.withColumn("prediction", prediction(F.array(*values)))


def fit_trees(train: DataFrame, id_col: str, xcols, ycol: str, kind: str, params: dict, seed: int, binned: Binned | None = None) -> TreeModel:
    """One forest or boosting on all rows; ``binned``: what :func:`bin_rows` made of them, with any folds."""
    binned = binned or bin_rows(train, id_col, xcols, ycol, F.lit(0), 0)
    p, unit, fill, base = binned.p, binned.unit, binned.fill[-1], binned.base[-1]
    bare = lambda g: (len(g.limit), g.feature, g.cut, g.child, g.values(unit))
    if not binned.small:
        grown = [forest_by_levels(binned, params, [-1], seed)[-1]] if kind == "forest" else [g[-1] for _, g in boost_by_levels(binned, [params], [-1], seed)[1]]
        trees = [bare(g) for g in grown]
    elif binned.sent is not None:
        if kind == "forest":
            tasks = [forest_task(binned, [params], -1, seed, a, min(a + FIT_TREES, params["n_trees"]), emit=True) for a in range(0, params["n_trees"], FIT_TREES)]
        else:
            tasks = [boost_task(binned, [params], -1, emit=True)]
        found = {r["id"]: trees_of_bytes(r["found"]) for r in kernels.run_tasks(binned.rows.sparkSession, binned.sent, tasks).collect()}
        trees = [side_by_side(x) for i in sorted(found) for x in ([found[i]] if kind == "forest" else [[t] for t in found[i]])]
    else:
        tasks = [(a, min(a + FIT_TREES, params["n_trees"])) for a in range(0, params["n_trees"], FIT_TREES)] if kind == "forest" else [(0, 0)]

        def work(block, task):
            if kind == "forest":
                made = [g for g in forest_here(block, fill, unit, params, -1, seed, *task)]
            else:
                made = [g for _, g, _ in boost_here(block, fill, unit, base, [params], -1, seed)]
            return [(task[0], pickle.dumps([bare(g) for g in made]))]

        found = shared_out(binned, tasks, work, "first long, trees binary").orderBy("first").collect()
        trees = [t for r in found for t in pickle.loads(r["trees"])]
    return TreeModel(kind, params, binned.edges, fill, base if kind == "boost" else 0.0, params.get("learning_rate", 1.0), trees)


def params_text(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


__all__ = ["Binned", "Growth", "TreeModel", "best_cuts", "bin_rows", "fit_trees", "fold_errors", "params_text", "search_trees"]
