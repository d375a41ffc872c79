"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax on top.

Everything in the model is linear up to the average, so at scoring time a
word adds one number (its vectors' part of the logit) and one count.  Words
are remembered per task, and a text costs a lookup per word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from panelwright.llm.chunks import Memory
from panelwright.llm.common import col, fresh, map_texts, steps


@dataclass(frozen=True)
class Settings:
    """All parameters.  ``max_docs`` bounds the labelled rows that are learned from (the smallest hashes of their ids)."""

    max_docs: int = 4000
    buckets: int = 1 << 17
    dim: int = 8
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 10
    rate: float = 2.0
    seed: int = 7


def word_features(word: str, s: Settings) -> list[int]:
    """Buckets of one word: itself, its shape, its character n-grams; bucket 0 marks a word that repeats the one before."""
    marked, hashed, n = f"<{word}>", zlib.crc32, s.buckets - 1
    shape = re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
    out = [1 + hashed(b"w" + word.encode()) % n, 1 + hashed(b"s" + shape.encode()) % n]
    out += [1 + hashed(marked[i : i + k].encode()) % n for k in s.grams for i in range(len(marked) - k + 1)]
    return out


def repeats(words: list[str]) -> int:
    return sum(map(eq, words, words[1:]))


def bag(text: str, s: Settings, memory: dict) -> tuple[bytes, bytes]:
    """Distinct buckets (int32) and their shares of all features (float32)."""
    words = text.split()
    for w in set(words).difference(memory):
        memory[w] = np.array(word_features(w, s), dtype=np.int32)
    flat = np.concatenate([*(memory[w] for w in words), np.zeros(repeats(words), np.int32)]) if words else np.empty(0, np.int32)
    ids, n = np.unique(flat, return_counts=True)
    if len(memory) > 100_000:
        memory.clear()
    return ids.astype("<i4").tobytes(), (n / max(1, len(flat))).astype("<f4").tobytes()


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent, one document a step; the rate falls in a line to zero."""
    rng = np.random.default_rng(s.seed)
    emb = rng.normal(0, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    top, bias = rng.normal(0, 0.3, (s.dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    total, step = max(1, s.epochs * len(bags)), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            rate, step = s.rate * (1 - step / total), step + 1
            mean = share @ emb[ids] if len(ids) else np.zeros(s.dim, np.float32)
            z = mean @ top + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = top @ error
            top -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            if len(ids):
                emb[ids] -= (rate * share * len(ids) ** 0.5)[:, None] * back
    return emb, top, bias


def fit_quality(df: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> bytes | None:
    """Learn from at most ``s.max_docs`` labelled documents; returns the model, or None when there is no labelled text.

    Labels other than 0 and 1 and null ids do not count; a document labelled
    twice counts by its larger label, and of rows that share an id one counts
    (the text of smallest hash), found before any task collects them, so a
    repeated id can't grow the training task.  Texts become bags of buckets on the
    executors (bounded by the bucket count, however long a text is); one task
    learns from the bounded sample.
    """
    usable = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    sample = usable.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(s.max_docs)
    docs = df.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(sample), "id")  # max_docs rows of two numbers
    docs = docs.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "label")

    def to_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for part in steps(batch, 1):
                made = [bag(t or "", s, memory) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.string()), part.column(2), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())], ["id", "label", "ids", "share"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["id"], r["ids"], r["share"], r["label"]) for b in batches for r in b.to_pylist())
        if rows:
            emb, top, bias = train([(np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4")) for r in rows], np.array([r[3] for r in rows]), s)
            yield pa.RecordBatch.from_pydict({"model": [np.concatenate([emb.ravel(), top.ravel(), bias]).astype("<f4").tobytes()]})

    bags = docs.mapInArrow(to_bags, "id string, label int, ids binary, share binary")
    found = bags.repartition(1).mapInArrow(learn, "model binary").first()
    return bytes(found["model"]) if found else None


def scorer(model: bytes | None, s: Settings) -> Callable[[list[str]], list[float]]:
    """Probability of label 1 per text; without a model 0.5."""
    if model is None:
        return lambda texts: [0.5] * len(texts)
    flat = np.frombuffer(model, "<f4").astype(np.float64)
    n = s.buckets * s.dim
    emb, top, bias = flat[:n].reshape(s.buckets, s.dim), flat[n : n + 2 * s.dim].reshape(s.dim, 2), flat[-2:]
    part = (emb @ (top[:, 1] - top[:, 0])).tolist()
    shift, memory = bias[1] - bias[0], Memory()

    def score(texts: list[str]) -> list[float]:
        split = [t.split() for t in texts]
        words_here = set().union(*split)
        for w in memory.missing(words_here):
            found = word_features(w, s)
            memory.now[w] = complex(sum(map(part.__getitem__, found)), len(found))  # logit part and feature count, added up together
        out = []
        for words in split:
            total = sum(map(memory.now.__getitem__, words), repeats(words) * complex(part[0], 1))
            z = total.real / max(1.0, total.imag) + shift
            out.append(float(1 / (1 + np.exp(-np.clip(z, -700, 700)))))
        memory.forget(words_here)
        return out

    return score


def quality_score(model: bytes | None, text: Column, s: Settings = Settings()) -> Column:
    """The score as a column (0 to 1, higher: label 1 likelier); null counts as empty, an empty text has the prior's score."""
    shipped = _broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fresh()
        score = scorer(shipped.value, s)
        for batch in batches:
            made: list[float] = []
            for i in range(0, len(batch), 500):
                made += score(["" if x is None else x for x in batch.iloc[i : i + 500]])
            yield pd.Series(made, dtype="float64")

    return of(text)


def _broadcast(model: bytes | None):
    """The model's size is fixed by the settings: buckets x dim floats."""
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(model)


def score_documents(df: DataFrame, model: bytes | None, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``score`` of every whole text, row by row, without a shuffle; other columns are not read."""
    shipped = _broadcast(model)

    def make():
        score = scorer(shipped.value, s)
        return lambda texts: [[x for i in range(0, len(texts), 500) for x in score(texts[i : i + 500].to_pylist())]]

    return map_texts(df, id_col, text_col, make, {"score": DoubleType()})
