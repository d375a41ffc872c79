"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

The forward score of a prefix (the best log probability of a segmentation of
its characters) depends on the prefix alone.  So the distinct pre-tokens of a
batch are put in a trie and each node's score is computed once, however many
pre-tokens run through it; terminal nodes keep the token count.  The trie is
walked depth first as the sorted pre-tokens come, so only the path to the
current node is held.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType

from panelwright.llm.chunks import Memory
from panelwright.llm.common import map_texts

#: The sign that marks a word start in the piece vocabulary, and the penalty of a character that no piece covers.
WORD_START = "▁"
UNKNOWN_PENALTY = 10.0


def zipf_pieces(model_file: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with log scores by Zipf's rule: the n-th best piece has -ln n."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    return {sp.id_to_piece(i): -math.log(n) for n, i in enumerate(ids, 1)}


class TrieCounter:
    """Counts tokens of the best segmentation; a character without a piece counts its UTF-8 bytes."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.terminal = Memory()

    def learn(self, words: set[str]) -> None:
        pieces, longest, unknown = self.pieces, self.longest, self.unknown
        best, count, before = [0.0], [0], ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):  # a node that no earlier pre-token reached
                top, n = -math.inf, 0
                for start in range(max(0, end - longest), end):
                    score = pieces.get(word[start:end])
                    if score is not None and best[start] + score > top:
                        top, n = best[start] + score, count[start] + 1
                if word[end - 1] not in pieces and best[end - 1] + unknown > top:
                    top, n = best[end - 1] + unknown, count[end - 1] + len(word[end - 1].encode())
                best.append(top)
                count.append(n)
            self.terminal.now[word] = count[-1]
            before = word

    def count(self, texts: list[str]) -> list[int]:
        split = [[WORD_START + w for w in t.split(" ")] if t else [] for t in texts]
        words = set(chain.from_iterable(split))
        self.learn(self.terminal.missing(words))
        out = [sum(map(self.terminal.now.__getitem__, x)) for x in split]
        self.terminal.forget(words)
        return out


@lru_cache(maxsize=2)
def counter(model_file: str) -> TrieCounter:
    """One counter per worker process and file."""
    return TrieCounter(zipf_pieces(model_file))


def token_counts(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id and ``n_tokens`` of the whole text, row by row, without a shuffle.

    A pre-token is the word-start sign and the run of characters up to the
    next space (an empty run between two spaces counts as one).  Null and
    empty texts have 0 tokens; repeated rows repeat their count; an empty
    table gives an empty one; other columns are not read.
    """

    def make():
        c = counter(model_file)
        return lambda texts: [c.count(texts.to_pylist())]

    return map_texts(df, id_col, text_col, make, {"n_tokens": LongType()})
