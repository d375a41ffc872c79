"""BPE encoding and decoding: propose by longest match, verify neighbours in numpy, merge only what fails.

A token sequence is the byte-pair encoding of its text exactly when every
token encodes to itself and every two neighbours keep their border, that is
when encoding the two tokens' joined bytes gives these two tokens again.
Words that pass this check keep the proposal; the others are merged pair by
pair in rank order.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType

from panelwright.llm.chunks import PATTERN, ChunkCache, Memory, byte_signs
from panelwright.llm.common import map_texts

class BpeCodec:
    """Encoder and decoder for a byte-level BPE tokenizer file.

    Tokens are numbered by rank inside: the 256 bytes, then one per merge in
    order.  ``encode`` treats added tokens found in a text as the tokenizers
    library does by default (they become their own id).
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        signs, vocab = byte_signs(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(signs[c] for c in t) for t, i in vocab.items() if all(c in signs for c in t)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        sign_of = {b: c for c, b in signs.items()}
        names = [sign_of[b] for b in range(256)] + [a + b for a, b in merges]
        rank = {t: r for r, t in enumerate(names)}
        if len(rank) != len(names):
            raise ValueError("two merges make the same token; this codec needs one merge per token")
        self.id_of = np.array([vocab[t] for t in names], dtype="<u4")
        self.left = np.array([*range(256), *(rank[a] for a, _ in merges)], dtype=np.int64)
        self.right = np.array([*range(256), *(rank[b] for _, b in merges)], dtype=np.int64)
        keys = (self.left[256:] << 32) | self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[order], order + 256
        self.merge_of = {(int(a), int(b)): 256 + i for i, (a, b) in enumerate(zip(self.left[256:], self.right[256:], strict=True))}
        raw = [bytes(signs[c] for c in t) for t in names]
        self.longest = max(map(len, raw))
        # A token that does not encode to itself can never be in an encoding: its two halves must keep together.
        halves = ~self.borders_hold(self.left[256:], self.right[256:], np.arange(256, len(names)))
        self.rank_of = {b: r for r, b in enumerate(raw) if r < 256 or not halves[r - 256]}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for t in spec.get("added_tokens", []):
            self.bytes_of[t["id"]] = t["content"].encode()
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.words = Memory()
        self.chunks = ChunkCache(self._encode_chunks)

    def borders_hold(self, left: np.ndarray, right: np.ndarray, forbid_from: np.ndarray | None = None) -> np.ndarray:
        """For each pair of ranks, whether no merge across its border ever takes place.

        Both tokens are taken apart in the reverse order of their merges; a
        border merge with a rank below that moment would have come first.
        ``forbid_from`` starts the clock at a rank instead of at the end, which
        asks whether the pair survives until that merge.
        """
        ok = np.ones(len(left), dtype=bool)
        at = np.arange(len(left))
        l, r = left.copy(), right.copy()
        clock = np.full(len(left), len(self.left) + 1, dtype=np.int64) if forbid_from is None else forbid_from.astype(np.int64)
        while len(at):
            key = (l << 32) | r
            pos = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            early = (self.pair_keys[pos] == key) & (self.pair_rank[pos] < clock)
            ok[at[early]] = False
            undo_left = l > r
            go = ~early & (np.maximum(l, r) >= 256)
            at, l, r, undo_left = at[go], l[go], r[go], undo_left[go]
            clock = np.where(undo_left, l, r + 1)
            l, r = np.where(undo_left, self.right[l], l), np.where(undo_left, r, self.left[r])
        return ok

    def propose(self, word: bytes) -> list[int]:
        out, i, n, known, longest = [], 0, len(word), self.rank_of, self.longest
        while i < n:
            j = min(n, i + longest)
            while (got := known.get(word[i:j])) is None:
                j -= 1
            out.append(got)
            i = j
        return out

    def merge_exactly(self, word: bytes) -> list[int]:
        """Merge the neighbours of lowest rank first, the leftmost of equals; long words over a linked list and a heap."""
        if len(word) <= 24:
            tok, never = list(word), len(self.left)
            while len(tok) > 1:
                found = [self.merge_of.get(p, never) for p in zip(tok, tok[1:], strict=False)]
                m = min(found)
                if m == never:
                    break
                i = found.index(m)
                tok[i : i + 2] = [m]
            return tok
        tok, nxt, prv = list(word), [*range(1, len(word)), -1], [-1, *range(len(word) - 1)]
        heap = [(m, i, tok[i], tok[i + 1]) for i in range(len(word) - 1) if (m := self.merge_of.get((tok[i], tok[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] != a or j < 0 or tok[j] != b:
                continue
            tok[i], tok[j], nxt[i] = m, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and (n := self.merge_of.get((tok[x], tok[y]))) is not None:
                    heapq.heappush(heap, (n, x, tok[x], tok[y]))
        return [t for t in tok if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, each as little-endian 32-bit bytes."""
        if not words:
            return []
        ranks = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, ranks), dtype=np.int64, count=len(ranks))
        flat = np.fromiter((t for x in ranks for t in x), dtype=np.int64, count=int(sizes.sum()))
        word_at = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(word_at[1:] == word_at[:-1])
        pairs, which = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
        holds = self.borders_hold(pairs >> 32, pairs & 0xFFFFFFFF)
        for w in np.unique(word_at[inner[~holds[which]]]).tolist():
            ranks[w] = self.merge_exactly(words[w])
        sizes = np.fromiter(map(len, ranks), dtype=np.int64, count=len(ranks))
        flat = np.fromiter((t for x in ranks for t in x), dtype=np.int64, count=int(sizes.sum()))
        raw, ends = self.id_of[flat].tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _encode_pieces(self, pieces: list[list[bytes]]) -> list[bytes]:
        words = {w for p in pieces for w in p}
        new = sorted(self.words.missing(words))
        self.words.now.update(zip(new, self.encode_words(new), strict=True))
        out = [b"".join(map(self.words.now.__getitem__, p)) for p in pieces]
        self.words.forget(words)
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if self.split_added is None or not any(a in x for a in self.added for x in chunks):
            return self._encode_pieces([[w.encode() for w in self.pattern.findall(x)] for x in chunks])
        cut = [self.split_added.split(x) for x in chunks]
        plain = iter(self._encode_pieces([[w.encode() for w in self.pattern.findall(s)] for x in cut for s in x[::2]]))
        out = []
        for x in cut:
            out.append(b"".join(next(plain) if i % 2 == 0 else self.added[s].to_bytes(4, "little") for i, s in enumerate(x)))
        return out

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> str:
        of = self.bytes_of
        return b"".join([of[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """One codec per worker process and file."""
    return BpeCodec(path)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, ``ids`` (binary, little-endian unsigned 32-bit token ids) and ``n_tokens``.

    Null and empty texts give no ids.  Repeated rows give repeated results,
    an empty table gives an empty one; other columns are not read.
    """

    def make():
        c = codec(path)

        def work(texts):
            ids = c.encode(texts)
            return [ids, [len(x) // 4 for x in ids]]

        return work

    return map_texts(df, id_col, text_col, make, {"ids": BinaryType(), "n_tokens": LongType()})


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Columns: the id and ``decoded``, the text of its ids (special tokens kept; null ids: empty text)."""

    def make():
        c = codec(path)
        return lambda rows: [[c.decode(x) for x in rows.to_pylist()]]

    return map_texts(df, id_col, ids_col, make, {"decoded": StringType()})


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: the id, ``ids``, ``n_tokens`` and ``decoded``, row by row without a join."""

    def make():
        c = codec(path)

        def work(texts):
            ids = c.encode(texts)
            return [ids, [len(x) // 4 for x in ids], [c.decode(x) for x in ids]]

        return work

    return map_texts(df, id_col, text_col, make, {"ids": BinaryType(), "n_tokens": LongType(), "decoded": StringType()})
