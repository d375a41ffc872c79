"""Registered queries of this subpackage: each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import bpe_codec, chat_format, conversation_trie, embedding_dedup, exact_dedup, lexical_search, ngram_join, packing, quality, substring_dedup, suffix_dedup, token_counts, token_files
from panelwright.llm.common import held_out, table

def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: The conversation that every run adds: control strings inside texts.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def read_windows(windows: DataFrame) -> DataFrame:
    """Read formatted conversations back: per conversation the digests of its turns and of what the loss mask covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        now, state = None, None

        def row() -> pa.RecordBatch:
            n, turns, loss_chars, loss, chars, n_windows = state
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([n]), pa.array([turns.hexdigest()]), pa.array([loss_chars]), pa.array([loss.hexdigest()]), pa.array([chars]), pa.array([n_windows])], names)

        for batch in batches:
            for conv, text, begin, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "new_from", "loss")), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        yield row()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in chat_format.read_turns(text[begin:]):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = chat_format.unescape(text[span["begin"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += 1
        if state is not None:
            yield row()

    ordered = windows.select("conv_id", "window", "formatted", "new_from", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, turns.schema)
    windows = chat_format.format_conversations(turns.unionByName(control), public_tokenizers.path("byte_bpe_50k.json"))
    return read_windows(windows)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    docs = token_files.read_token_files(manifest)
    return docs.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the packing with their ids as a checksum."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.where(~held_out()))
    return quality.score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substring_dedup.drop_repeated_windows(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_join": op2_ngram_join,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_files": op6_token_files,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_trie": op13_conversation_trie,
}

SQL = {
    "op2_ngram_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x0B]+'), lambda w: w <> '') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
), half AS (
  SELECT c.a, c.b, c.both = na.n AND c.both = nb.n AS equal FROM c JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
  WHERE 10 * c.both >= 8 * (na.n + nb.n - c.both)
), link AS (SELECT a, b, equal FROM half UNION ALL SELECT b, a, equal FROM half),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
k AS (SELECT a AS doc_id, count(*) AS n_links, min(b) FILTER (WHERE equal) AS twin FROM link GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(twin, doc_id)) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN k USING (doc_id)
""",
    "op5_suffix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS i FROM d)
), late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM w) WHERE r > 1
), runs AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM late
), grp AS (
  SELECT doc_id, i, sum(CASE WHEN gap IS NULL OR gap > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM runs
), span AS (
  SELECT doc_id, k, min(i) AS a, max(i) + 100 AS b FROM grp GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte FROM span
), kept AS (
  SELECT d.doc_id, coalesce(string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a), '') || substr(any_value(h), 2 * coalesce(max(b), 0) + 1) AS h,
         length(any_value(h)) // 2 AS n_bytes, coalesce(sum(b - a), 0) AS n_removed, count(a) AS n_spans
  FROM d LEFT JOIN gaps USING (doc_id) GROUP BY d.doc_id
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256 FROM kept
""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)
""",
    "op7_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op11_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 12, 0))) AS i FROM d)
), late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first_id FROM win) WHERE first_id < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + j AS place FROM late CROSS JOIN (SELECT unnest(range(13)) AS j)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS k, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM d) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) SEMI JOIN q USING (term) GROUP BY doc_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n_docs
), m AS (
  SELECT doc_id, 50 + (50 * len(t) * n_docs) // n_terms AS m FROM d, s WHERE len(t) > 0
), score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0) WHERE rank <= 50
""",
    "op13_conversation_trie": r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS code, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, code, CAST(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, code) - 1 AS p FROM t
), bits AS (
  SELECT c, list_reduce(flatten([[CAST(4294967295 AS BIGINT)], flatten(list_transform(range(len(CAST(c AS VARCHAR))), lambda i: [CAST(ascii(CAST(c AS VARCHAR)[i + 1]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc FROM (SELECT DISTINCT c FROM own)
), conv AS (
  SELECT c, xor(crc, CAST(4294967295 AS BIGINT)) % 4 AS h FROM bits
), turns AS (
  SELECT conv.c, 0 AS half, own.p, code, words FROM conv JOIN own ON own.c = conv.c - conv.c % 20 WHERE own.p < h
  UNION ALL SELECT conv.c, 1, own.p, code, words FROM conv JOIN own ON own.c = conv.c WHERE own.p >= h
), path AS (
  SELECT c, row_number() OVER w AS d, string_agg(code, '') OVER w AS k, words, count(*) OVER (PARTITION BY c) AS n FROM turns WINDOW w AS (PARTITION BY c ORDER BY half, p)
), place AS (
  SELECT c, d, k, words, d = n AS last FROM path
  UNION ALL SELECT conv.c, 0, '', 0, conv.c NOT IN (SELECT c FROM turns) FROM conv
), node AS (
  SELECT k, any_value(d) AS d, min(c) AS c, count(*) AS n, any_value(words) AS words, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends FROM place GROUP BY k
), kids AS (
  SELECT k[:length(k) - 32] AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children, up.c AS parent FROM node LEFT JOIN kids USING (k) LEFT JOIN (SELECT k AS up_k, c FROM node) up ON d > 0 AND up_k = node.k[:length(node.k) - 32]
), below AS (
  SELECT a.k, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.words) AS saved FROM full_node a JOIN full_node b ON starts_with(b.k, a.k) GROUP BY a.k
)
SELECT CAST(c AS BIGINT) AS conv_id, CAST(d AS BIGINT) AS depth, CAST(parent AS BIGINT) AS parent_conv_id, CAST(n AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM full_node JOIN below USING (k)
""",
}
