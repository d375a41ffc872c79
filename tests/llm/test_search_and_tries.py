"""Substring dedup, lexical search and the conversation trie against brute force, on small awkward tables."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from panelwright.llm import conversation_trie, lexical_search, substring_dedup


@pytest.fixture
def shipped():
    """Module constants changed by a test also reach the Python workers."""
    modules = (conversation_trie, lexical_search, substring_dedup, sys.modules[__name__])
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    yield
    for m in modules:
        cloudpickle.unregister_pickle_by_value(m)


# ----------------------------------------------------------- substring dedup

def word_texts():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + [f"longer_word_{i}_abcdefghij" for i in range(10)] + ["é", "日本"]
    texts = [None, "", " ", "a b", "v" * 3000]
    for _ in range(150):
        if rnd.random() < 0.5 or len(texts) < 10:
            texts.append(rnd.choice([" ", "\n\t", "  ", "\x0b"]).join(rnd.choice(vocab) for _ in range(rnd.randint(0, 200))))
        else:
            t = rnd.choice([t for t in texts if t and t.split()]).split()
            a = rnd.randrange(len(t))
            texts.append(" ".join(t[a : a + rnd.randint(1, 60)] * rnd.randint(1, 3) + [rnd.choice(vocab) for _ in range(rnd.randint(0, 30))]))
    return [*texts, texts[20], texts[20], " ".join("abc") + " " + " ".join(["x y"] * 30)]


def brute_windows(ids, texts, k):
    """Words, words removed and the text left of each row; rows of one id are one document, null is the last."""
    rank = [float("inf") if i is None else i for i in ids]
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    first = {}
    for r, w in zip(rank, words, strict=True):
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, r), r)
    out = []
    for r, w in zip(rank, words, strict=True):
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < r:
                gone[a : a + k] = [True] * k
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("words, mmer", [(13, 5), (4, 2), (3, 1), (13, 13)])
def test_substring_dedup_against_brute_force(spark, words, mmer):
    texts = word_texts()
    rows = [(i, t, 7, "k", "u") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string, uid string").repartition(5)
    got = {r["doc_id"]: r for r in substring_dedup.drop_repeated_windows(df, words, mmer).collect()}
    for i, want in enumerate(brute_windows(range(len(texts)), texts, words)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == want, i
        assert sum(s["end"] - s["begin"] for s in got[i]["spans"]) == want[1]
    assert substring_dedup.drop_repeated_windows(df.where("false"), words, mmer).collect() == []


def test_substring_dedup_deals_hot_minimisers_window_by_window(spark, shipped, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_STRINGS", 3)
    monkeypatch.setattr(substring_dedup, "HELD_BYTES", 300)
    monkeypatch.setattr(substring_dedup, "CHUNK", 50)
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([f"a{rnd.randrange(10**6)}" for _ in range(9)] + passage + [f"b{rnd.randrange(10**6)}" for _ in range(9)]) for _ in range(150)] + word_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in substring_dedup.drop_repeated_windows(df).collect()}
    for i, want in enumerate(brute_windows(range(len(texts)), texts, 13)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == want, i


def test_substring_dedup_tells_windows_of_one_hash_apart(spark, shipped, monkeypatch):
    """The sorted windows are compared by words: a hash that says nothing changes no result."""
    monkeypatch.setattr(substring_dedup, "MIX", [np.uint64(0)] * 4)
    monkeypatch.setattr(substring_dedup, "string_hashes", lambda h, first, n_words: n_words.astype(np.uint64))
    texts = word_texts()[:60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in substring_dedup.drop_repeated_windows(df, 4, 2).collect()}
    for i, want in enumerate(brute_windows(range(len(texts)), texts, 4)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == want, i


@pytest.mark.parametrize("kind", ["long", "string"])
def test_substring_dedup_of_rows_that_share_ids(spark, kind):
    said = " ".join(f"w{i}" for i in range(20))
    ids = [1, 1, 2, None, None]
    texts = [said, said, said + " tail", said, "tail " + said]
    rows = [(None if i is None else i if kind == "long" else f"a{i}", t) for i, t in zip(ids, texts, strict=True)]
    got = [tuple(r) for r in substring_dedup.drop_repeated_windows(spark.createDataFrame(rows, f"doc_id {kind}, text string")).select("doc_id", "n_words", "n_removed", "kept").collect()]
    want = [(r[0], *w) for r, w in zip(rows, brute_windows(ids, texts, 13), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ------------------------------------------------------------ lexical search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_ranking(docs, queries, k):
    parted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    parted = [(i, c) for i, c in parted if c]
    n_docs, n_terms = len(parted), sum(sum(c.values()) for _, c in parted)
    df = Counter(t for _, c in parted for t in c)
    out = []
    for q, text in queries:
        asked, scored = set(TERM.findall((text or "").translate(LOWER))), []
        for i, c in parted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def search_tables(spark):
    rnd = random.Random(3)
    vocab = [f"W{i}" for i in range(200)] + [f"é{i}" for i in range(10)] + ["x-y", "İ", "日本", "ÀÉ", "_"]
    docs = [(i, rnd.choice([None, "", "-- !"]) if i % 50 == 0 else rnd.choice([" ", "\x00", "_"]).join(rnd.choice(vocab[: rnd.randint(5, 215)]) for _ in range(rnd.randint(1, 80)))) for i in range(900)]
    docs += [(900 + i, docs[7][1]) for i in range(70)]  # ties beyond the last rank
    queries = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 20)))) for i in range(30)] + [(40, None), (41, "nothing zz"), (42, ""), (43, docs[7][1])]
    dd = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, score int, rank string").repartition(5)
    qq = spark.createDataFrame([(i, t, 1) for i, t in queries], "item_id long, text string, doc_id int")
    return docs, queries, dd, qq


@pytest.mark.parametrize("k", [50, 3])
def test_lexical_search_against_brute_force(spark, k):
    docs, queries, dd, qq = search_tables(spark)
    got = sorted(tuple(r) for r in lexical_search.rank_documents(dd, qq, k).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_ranking(docs, queries, k)


def test_lexical_search_in_blocks_of_queries_and_documents(spark, shipped, monkeypatch):
    docs, queries, dd, qq = search_tables(spark)
    for name, value in {"BLOCK_QUERIES": 20, "BLOCK_TERMS": 150, "BLOCK_DOCS": 40, "LEAF_DOCS": 2, "PIECE": 7}.items():
        monkeypatch.setattr(lexical_search, name, value)
    got = sorted(tuple(r) for r in lexical_search.rank_documents(dd, qq, 5).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_ranking(docs, queries, 5)


def test_lexical_search_of_empty_tables_and_repeated_rows(spark):
    docs, queries, dd, qq = search_tables(spark)
    assert lexical_search.rank_documents(dd.where("false"), qq).collect() == []
    assert lexical_search.rank_documents(dd, qq.where("false")).collect() == []
    twice = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    asked = spark.createDataFrame([(None, "one"), (1, "ONE one"), (1, "one")], "item_id int, text string")
    got = [tuple(r) for r in lexical_search.rank_documents(twice, asked, 4).collect()]
    assert sorted((r[0] or 0, r[1], r[2]) for r in got if r[0] != 1) == [(0, 1, "a"), (0, 2, "a"), (0, 3, "b"), (0, 4, None)]
    assert len(got) == 12 and len({r[3] for r in got}) == 1


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    near = [rng.integers(0, 10**10, size=30) * (rng.random(30) < 0.3) for _ in range(6)]
    rows = np.array([c + rng.integers(0, 10**5, size=30) for c in near for _ in range(60)], dtype=np.int64)
    rows[100:140] = rows[100]
    tree = lexical_search.BallTree(rows)
    mask = (rng.random((30, 40)) < 0.2).astype(float)
    bound = tree.bounds(mask)
    exact = rows @ mask.astype(np.int64)
    for (held, left, right), b in zip(tree.nodes, bound, strict=True):
        assert (exact[held].max(axis=0) <= b).all()
        assert (left < 0) == (len(held) <= lexical_search.LEAF_DOCS) == (right < 0)
    opened = 0
    for j in range(40):
        best = lexical_search.Ranking(5)
        columns = np.flatnonzero(mask[:, j])
        opened += tree.search(columns, bound[:, j], best.floor, lambda held, scores, r=best: r.offer(held.tolist(), scores))
        assert [-b[0] for b in best.best] == [int(s) for s in sorted(exact[:, j].tolist(), reverse=True)[:5] if s > 0]
    leaves = sum(left < 0 for _, left, _ in tree.nodes)
    assert opened < 0.5 * leaves * 40


# --------------------------------------------------------- conversation trie

def brute_trie(convs):
    node, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            node.setdefault(tuple(turns[:d]), []).append(c)
    for p in node:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(node, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + ((len(node[p]) - 1) * len(p[-1][1].encode().split()) if p else 0)
    ends = {p: ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))) for p, m in node.items()}
    return sorted((min(m), len(p), min(node[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in node.items())


def rebuilt(convs):
    head = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
    return {c: convs.get(c - c % 20, [])[: head[c]] + turns[head[c] :] for c, turns in convs.items()}


def conversations():
    rnd = random.Random(4)
    said = [("u", "a b"), ("a", "c d e"), ("", "x"), ("u", ""), ("a", "q\tq\nq"), ("u:", "1"), ("u", ":1")]
    convs = {c: [rnd.choice(said) for _ in range(rnd.randint(1, 7))] for c in range(200)}
    convs[500] = convs[3] * 40  # long, and shared whole
    convs[501], convs[502] = list(convs[500]), convs[500][:70] + [("z", "zz z")] * 9
    convs[777], convs[779] = [("u", "solo")], [("u", "solo")]  # some of these are left without turns
    convs[903] = [("u", f"own {i}") for i in range(90)]  # long, and shared with none
    return convs


def conversation_rows(convs):
    rnd = random.Random(6)
    rows = [(c, None if i == 0 and c % 3 == 0 else i, r or None, t or None, 1) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [(None, 1, "user", "belongs to none", 1)] * 3
    rnd.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, depth int"


@pytest.mark.parametrize("run", [8192, 7, 1])
def test_conversation_trie_against_brute_force(spark, shipped, monkeypatch, run):
    monkeypatch.setattr(conversation_trie, "RUN_CONVS", run)
    convs = conversations()
    df = spark.createDataFrame(conversation_rows(convs), SCHEMA).repartition(4)
    order = lambda r: (r[0], r[1])
    assert sorted((tuple(r) for r in conversation_trie.rebuilt_trie(df).collect()), key=order) == sorted(brute_trie(rebuilt(convs)), key=order)
    if run == 7:
        assert sorted((tuple(r) for r in conversation_trie.conversation_trie(df).collect()), key=order) == sorted(brute_trie(convs), key=order)


def test_conversation_trie_of_small_tables_and_repeated_turns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_trie.conversation_trie(none).collect() == [] and conversation_trie.rebuilt_trie(none).collect() == []
    same = [(5, 1, "u", "b", 0), (5, 1, "u", "b", 0), (5, 1, "u", "b", 0), (8, 0, "u", "b", 0)]
    got = sorted(tuple(r) for r in conversation_trie.conversation_trie(spark.createDataFrame(same, SCHEMA)).collect())
    assert got == brute_trie({5: [("u", "b")] * 3, 8: [("u", "b")]})
    with pytest.raises(TypeError):
        conversation_trie.conversation_trie(spark.createDataFrame([("a", 1, "u", "b")], "conv_id string, turn long, role string, text string"))
