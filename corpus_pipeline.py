"""Corpus pipeline: quality filter, exact and near deduplication, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import exact_dedup, ngram_join, packing, quality, suffix_dedup
from panelwright.llm.common import col, held_out, table
from panelwright.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is below one half; learns from labelled rows that are not held out.

    Each row is judged by its text alone, so repeated rows go or stay alike.
    Null and empty texts have the prior's score; a score of one half stays.
    Rows with a null id are scored, never learnt from.  Without a labelled
    text every score is one half; an empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.where(~held_out()))
    return docs.where(quality.quality_score(model, col("text")) >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays (white space aside); of wholly repeated rows one.

    The longest original text stays, then the smallest id; null counts as
    empty, so null, empty and blank texts are one group.  Rows that share an
    id but no text are groups of their own.  An empty table stays empty.
    """
    won = exact_dedup.exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__won"))
    bare = F.regexp_replace(F.coalesce(col("text"), F.lit("")), r"[\x20\x09-\x0D]", "")
    marked = docs.withColumn("__sha", F.sha2(bare.cast("binary"), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__won"))
    return marked.join(won, same, "left_semi").dropDuplicates(["doc_id", "__sha"]).drop("__sha")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies stays.

    Null, empty and blank texts and rows with a null id link with nothing and
    stay.  Rows that share an id stay together if one of them stays.  An empty
    table stays empty.
    """
    won = ngram_join.similar_documents(docs).where("kept").select(F.col("doc_id").alias("__id"))
    return docs.join(won, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus go; n_chars follows the text that is left.

    No row goes, even if nothing of its text is left; a null text becomes
    empty.  Rows with a null id count as last, rows that share an id follow a
    hash of their text.  An empty table stays empty.
    """
    left = suffix_dedup.remove_repeats(docs, as_text=True, carry=True)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return left.select(*(made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the pieces of every document that is left.

    A null or empty text is one piece, the end id alone; repeated rows and
    rows with a null id are packed each.  An empty table gives no piece.
    """
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", drop_passages),
    ("packing", pack),
]

#: The classifier is trained by gradient descent, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
