"""Per-task memory of text chunks, so that each distinct chunk is tokenised once and not once per occurrence."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the pattern by which byte-level BPE of this family cuts text before merging.  White space is spelt
#: out (the Unicode property), since Python counts four more control characters as space.
WHITE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memory:
    """A bounded memory in two generations: what a full generation saw and the next does not use is dropped.

    ``missing(keys)`` brings all known ones of ``keys`` into ``now`` and
    returns the rest, which the caller puts there.
    """

    def __init__(self, limit: int = 600_000):
        self.limit = limit
        self.now: dict = {}
        self.before: dict = {}

    def missing(self, keys: set) -> set:
        if len(self.now) > self.limit // 2:
            self.now, self.before = {}, self.now
        new = keys.difference(self.now)
        known = {k for k in new if k in self.before}  # not intersection(), which walks the whole memory
        for k in known:
            self.now[k] = self.before.pop(k)
        return new.difference(known)

    def forget(self, keys: set, longest: int = 200) -> None:
        """Drop the long ones of ``keys``: few and large."""
        for k in [k for k in keys if len(k) > longest]:
            self.now.pop(k, None)


#: Longest chunk (bytes) that is remembered, and the random weights of the two 64-bit sums that tell chunks apart.
CHUNK_BYTES = 64
WEIGHTS = np.random.default_rng(99).integers(0, 1 << 64, (2, CHUNK_BYTES + 1), dtype=np.uint64) | np.uint64(1)


def chunk_keys(chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit keys per chunk, and the chunk sizes in bytes; keys of empty and too long chunks mean nothing."""
    ends = np.frombuffer(chunks.buffers()[1], dtype=np.int32)[chunks.offset : chunks.offset + len(chunks) + 1].astype(np.int64)
    size = np.diff(ends)
    fit = np.flatnonzero((size > 0) & (size <= CHUNK_BYTES))
    keys = np.zeros((2, len(size)), dtype=np.uint64)
    if len(fit):
        n = size[fit]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        signs = np.frombuffer(chunks.buffers()[2], dtype=np.uint8)[np.repeat(ends[fit], n) + place].astype(np.uint64) + np.uint64(1)
        for k in range(2):
            keys[k, fit] = np.add.reduceat(signs * WEIGHTS[k][place], first) + n.astype(np.uint64) * WEIGHTS[k][-1]
    return keys[0], keys[1], size


class IdTable:
    """A bounded memory from chunk keys to runs of ids, all in numpy arrays; the longest unused half goes when it is full."""

    def __init__(self, limit: int):
        self.limit, self.clock = limit, 0
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.start, self.size, self.used = (np.empty(0, np.int64) for _ in range(3))
        self.ids = np.empty(0, "<u4")

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is not known."""
        self.clock += 1
        if not len(self.key):
            return np.full(len(key), -1)
        row = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = (self.key[row] == key) & (self.check[row] == check)
        self.used[row[known]] = self.clock
        return np.where(known, row, -1)

    def add(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Put new runs in (a size of -1 has no ids: the chunk can't stand for itself)."""
        length = np.maximum(size, 0)
        start = len(self.ids) + np.cumsum(length) - length
        parts = ((self.key, key), (self.check, check), (self.start, start), (self.size, size), (self.used, np.full(len(key), self.clock)))
        key, check, start, size, used = (np.concatenate(x) for x in parts)
        ids = np.concatenate([self.ids, ids])
        order = np.argsort(key, kind="stable")
        if len(key) > self.limit:
            order = order[used[order] > np.median(used)]
            length = np.maximum(size[order], 0)
            first = np.cumsum(length) - length
            ids = ids[np.repeat(start[order] - first, length) + np.arange(int(length.sum()))]
            start = np.empty(len(key), np.int64)
            start[order] = first
        self.key, self.check, self.start, self.size, self.used, self.ids = key[order], check[order], start[order], size[order], used[order], ids


class ChunkCache:
    """Token ids of texts from the ids of their chunks " word" and "\\nword", each encoded once while it is remembered.

    A space or line end between two characters that are not white space always
    starts a new pre-token, so the ids of a text are those of its chunks in a
    row.  A text in which that does not hold (white space at an end or
    doubled) is encoded whole.  Cutting and finding the distinct chunks of a
    batch is Arrow's work, finding and laying out their ids numpy's; Python
    sees chunks that are new, first in a text, or long.
    """

    def __init__(self, many: Callable[[list[str]], list[bytes]], limit: int = 900_000):
        self.many, self.table = many, IdTable(limit)

    def _encoded(self, chunks: list[str], prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' ids in a row, and how many each has: -1 for one with white space at an end."""
        odd = [not x or x[-1].isspace() or x[0].isspace() and not (prefix and x[0] == "\n" and not x[1].isspace()) for x in chunks]
        made = self.many([x if x[0] == "\n" else prefix + x for x, k in zip(chunks, odd, strict=True) if not k])
        size = np.full(len(chunks), -1)
        size[~np.array(odd, dtype=bool)] = [len(x) // 4 for x in made]
        return np.frombuffer(b"".join(made), dtype="<u4"), size

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit bytes."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not len(texts):
            return []
        parts = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" \n"), pattern=" ")
        bounds = parts.offsets.to_numpy()
        flat = parts.values.dictionary_encode()
        which, chunks = flat.indices.to_numpy().astype(np.int64), flat.dictionary
        heads = chunks.take(pa.array(which[bounds[:-1]])).to_pylist()
        which[bounds[:-1]] = np.arange(len(chunks), len(chunks) + len(heads))

        key, check, length = chunk_keys(chunks)
        short = length <= CHUNK_BYTES
        row = np.where(length == 0, -1, self.table.find(key, check))
        new = np.flatnonzero((row < 0) & short & (length > 0))
        if len(new):
            ids, size = self._encoded(chunks.take(pa.array(new)).to_pylist(), " ")
            self.table.add(key[new], check[new], ids, size)
            row = self.table.find(key, check)
        long = np.flatnonzero(~short)
        extra = [self._encoded(chunks.take(pa.array(long)).to_pylist(), " "), self._encoded(heads, "")]
        sizes = np.concatenate([np.where(length == 0, -1, self.table.size[row] if len(self.table.key) else -1), extra[1][1]])
        sizes[long] = extra[0][1]
        starts = np.concatenate([self.table.start[row] if len(self.table.key) else np.zeros(len(chunks), np.int64), np.zeros(len(heads), np.int64)])
        at = len(self.table.ids)
        for places, (more, n) in zip((long, np.arange(len(chunks), len(sizes))), extra, strict=True):
            n = np.maximum(n, 0)
            starts[places] = at + np.cumsum(n) - n
            at += len(more)
        ids = np.concatenate([self.table.ids, extra[0][0], extra[1][0]])

        odd = np.flatnonzero(np.add.reduceat((sizes < 0)[which], bounds[:-1]))
        size = np.maximum(sizes, 0)[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        shift, out = starts[which] - ends[:-1], []
        for i in range(0, len(texts), 500):
            a, b = bounds[i], bounds[min(i + 500, len(texts))]
            raw = ids[np.repeat(shift[a:b], size[a:b]) + np.arange(ends[a], ends[b])].tobytes()
            cut = (4 * (ends[bounds[i : i + 501]] - ends[a])).tolist()
            out += [raw[x:y] for x, y in zip(cut, cut[1:], strict=False)]
        for i in odd.tolist():
            out[i] = self.many([texts[i].as_py()])[0]
        return out


class LibraryEncoder:
    """The tokenizers library behind a chunk memory; ids as little-endian 32-bit bytes, no special tokens added.

    Distinct pre-tokens of plain Latin chunks go to the library's model one by
    one and are remembered; every other chunk, and every tokenizer file of
    another make, goes through the library's whole encode.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.lower, self.pattern = self._plain_rules(spec)
        self.signs = {b: c for c, b in byte_signs().items()}
        self.words = Memory(400_000)
        self.chunks = ChunkCache(self._many)

    @staticmethod
    def _plain_rules(spec: dict) -> tuple[bool, regex.Pattern | None]:
        """(lower case, pre-token pattern) of the two makes of file that are known; no pattern for others."""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
            return False, regex.compile(PATTERN)
        parts = before.get("pretokenizers", [])
        if kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]:
            return True, regex.compile(parts[0]["pattern"]["Regex"].replace(r"\s", WHITE))
        return False, None

    def _many(self, chunks: list[str]) -> list[bytes]:
        if self.pattern is None:
            return self._whole(chunks)
        # Below U+0250 every character is in normal form C and lower-cases on its own.
        plain = [x.isascii() or max(x) < "\u0250" for x in chunks]
        for mark in self.added:
            plain = [k and mark not in x for k, x in zip(plain, chunks, strict=True)]
        cut = [self.pattern.findall(x.lower() if self.lower else x) if k else () for k, x in zip(plain, chunks, strict=True)]
        words, model, signs = {w for x in cut for w in x}, self.tokenizer.model, self.signs
        for w in self.words.missing(words):
            ids = [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(signs))]
            self.words.now[w] = array("I", ids).tobytes()
        out = [b"".join(map(self.words.now.__getitem__, x)) for x in cut]
        self.words.forget(words)
        rest = [i for i, k in enumerate(plain) if not k]
        for i, ids in zip(rest, self._whole([chunks[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _whole(self, chunks: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(chunks), 4096):
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(chunks[i : i + 4096], add_special_tokens=False)]
        return out

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        return self.chunks.encode(texts)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One encoder per worker process and file."""
    return LibraryEncoder(path)
