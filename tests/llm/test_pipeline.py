"""The pipeline's stages on a small table with planted cases, and its run on the smallest tables."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest

from panelwright.llm import quality
from panelwright.llm.common import held_out, table
from test_operators import WORD, brute_repeats, by_id, components, library, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    a, passage = prose(150), prose(70)
    texts = [a, a + " ", a.replace(a.split()[75], "changed", 1), prose(90) + " " + passage, passage + " " + prose(90), prose(40), None, ""]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, uid string")


def test_stages_drop_what_is_planted_and_nothing_else(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    one = stages["exact dedup"](spark, docs, SF)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == [1, 2, 3, 4, 5, 6]
    two = stages["n-gram Jaccard join"](spark, one, SF)
    assert sorted(r["doc_id"] for r in two.collect()) == [1, 3, 4, 5, 6]
    three = stages["suffix-array dedup"](spark, two, SF)
    left = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == docs.columns and len(left[4]["text"]) < len(docs.where("doc_id = 4").first()["text"]) - 60
    assert all(r["n_chars"] == len(r["text"]) and r["uid"] == "extra" for r in left.values())
    assert {r["doc_id"] for r in stages["packing"](spark, three, SF).collect()} == {1, 3, 4, 5, 6}


def test_run_packs_only_documents_that_stay(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len({r["doc_id"] for r in rows}) < spark.read.parquet(f"{SF}/documents.parquet").count()


def brute_keeps(rows):
    """(id, text) that exact and n-gram dedup leave, by all pairs; and the text without 100-byte repeats."""
    bare = {i: "".join((t or "").translate(dict.fromkeys([32, *range(9, 14)], ""))) for i, t in rows}
    rows = [(i, t) for i, t in rows if i == min((-len(u or ""), j) for j, u in rows if bare[j] == bare[i])[1]]
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    n = range(len(rows))
    root = components(len(rows), [(a, b) for a in n for b in n if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    return {i: kept.decode() for (i, _), (*_, kept) in zip(rows, brute_repeats([t for _, t in rows], 100), strict=True)}


def test_all_stages_against_brute_force(spark):
    rnd, words = random.Random(21), [f"w{k}" for k in range(400)]
    plain = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages, texts = [plain(60) for _ in range(3)], [None, "", " \t"]
    for _ in range(12):
        t = plain(rnd.randint(60, 160))
        texts += [t, rnd.choice([t + " ", t.replace(" ", "\n")]), t.replace(t.split()[30], "changed", 1), plain(30) + " " + rnd.choice(passages) + " " + plain(30)]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = sorted(zip(order, texts, strict=True))
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long").repartition(5)
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality classifier"](spark, docs, SF)
    score = quality.scorer(quality.fit_quality(docs, table(spark, SF, "labels").where(~held_out())), quality.Settings())
    kept = [(i, t) for i, t in rows if score([t or ""])[0] >= 0.5]
    assert good.columns == docs.columns and sorted((r["doc_id"], r["text"]) for r in good.collect()) == kept

    left = docs  # the other stages on all rows, whatever the classifier thinks of made-up words
    for name in ("exact dedup", "n-gram Jaccard join", "suffix-array dedup"):
        left = stages[name](spark, left, SF)
    want = brute_keeps(rows)
    assert {i: r["text"] for i, r in by_id(left).items()} == want
    lib, pieces = library(WORD), {}
    for r in stages["packing"](spark, left, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == want.keys()
    for i, t in want.items():
        ids, at = np.array([*lib.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(ids[at : at + r["length"]].tobytes()))
            at += r["length"]
        assert at == len(ids)


def test_stages_of_empty_tables_null_ids_and_repeated_ids(spark, docs):
    a, b = prose(80), prose(90)
    rows = [(None, a), (None, b), (7, prose(70)), (7, prose(60)), (7, None), (8, a), (8, a)]
    odd = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    stages = [s for s in corpus_pipeline.STAGES if s[0] != "quality classifier"]
    for _, stage in stages:
        odd = stage(spark, odd, SF)
    found = {r["doc_id"] for r in odd.collect()}
    assert {None, 7} <= found  # a copy of a row without an id may be the one that stays
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
