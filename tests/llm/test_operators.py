"""Training-data operators against brute force, the tokenizers library and round trips, on small awkward tables."""

import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from panelwright.llm import bpe_codec, chat_format, embedding_dedup, exact_dedup, ngram_join, packing, quality, suffix_dedup, token_counts, token_files

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
RND = random.Random(5)
VOCAB = ["".join(RND.choice("abcdeé ß日.'") for _ in range(RND.randint(1, 9))).replace(" ", "") or "x" for _ in range(300)]


def prose(n):
    return " ".join(RND.choice(VOCAB) for _ in range(n))


PASSAGE = prose(60)
LONG = prose(6000)
TEXTS = [None, "", " ", "one two", "one\ttwo ", "a <|endoftext|> b", "x  y\n\n z", "日本語 😀 İΣ é", "w" * 5000, LONG, LONG + " tail", prose(80) + " " + PASSAGE + " " + prose(80), PASSAGE + "\n" + prose(50), prose(120)]
TEXTS += [TEXTS[-1].replace(TEXTS[-1].split()[60], "changed", 1), TEXTS[-1], "[INST] </s> \\[ <\\ <<SYS>>"]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns clash with the operators' own names
    rows = [(i, t, "en", 1, "k", 2.0) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_tokens int, uid string, ids double").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_bpe_codec_equals_library(docs, none):
    lib = library(BYTE)
    got = by_id(bpe_codec.encode_texts(docs, BYTE))
    back = by_id(bpe_codec.decode_ids(bpe_codec.encode_texts(docs, BYTE), BYTE))
    for i, t in enumerate(TEXTS):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == want and got[i]["n_tokens"] == len(want)
        assert back[i]["decoded"] == lib.decode(want, skip_special_tokens=False)
    assert bpe_codec.round_trip(none, BYTE).collect() == []


def test_every_pair_check_agrees_with_exact_merging():
    c, rnd = bpe_codec.codec(BYTE), random.Random(9)
    words = ["".join(rnd.choice("etaoin sh'é日1!") for _ in range(rnd.randint(1, 40))).encode() for _ in range(3000)]
    exact = [c.id_of[c.merge_exactly(w)].tobytes() for w in words]
    assert c.encode_words(words) == exact


def test_token_counts_equal_unigram_library(docs, none):
    pieces = token_counts.zipf_pieces(PIECE)
    lib = Tokenizer(Unigram([("<unk>", 0.0), *pieces.items()], unk_id=0, byte_fallback=False))
    got = by_id(token_counts.token_counts(docs, PIECE))
    for i, t in enumerate(TEXTS):
        want = 0
        for w in (t or "").split(" ") if t else []:
            e = lib.encode("▁" + w)
            want += sum(len(w2.encode()) if i2 == 0 else 1 for w2, i2 in zip(e.tokens, e.ids, strict=True))
        assert got[i]["n_tokens"] == want, (i, t)
    assert token_counts.token_counts(none, PIECE).collect() == []


def test_token_files_round_trip_and_random_access(spark, docs, none, tmp_path):
    lib = library(BYTE)
    manifest = token_files.write_token_files(docs, BYTE, out_uri=str(tmp_path / "f"))
    at = 0
    got = by_id(token_files.read_token_files(manifest))
    for i, t in enumerate(TEXTS):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i]["start"], np.frombuffer(got[i]["ids"], "<u4").tolist()) == (at, ids)
        at += len(ids)
    assert token_files.read_token_files(token_files.write_token_files(none, BYTE)).collect() == []
    for bits in (1, 7, 16, 17, 31):
        x = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
        assert (token_files.unpack_bits(token_files.pack_bits(x, bits), bits, 1000) == x).all()
    clash = spark.createDataFrame([(None, "n"), (3, "b"), (3, "a"), (3, "a")], "doc_id long, text string")
    assert [r["start"] for r in token_files.read_token_files(token_files.write_token_files(clash, BYTE)).orderBy("start").collect()] == [0, 2, 4, 6]


def test_packing_covers_every_id_once(docs, none):
    lib = library(WORD)
    pieces = [r.asDict() for r in packing.pack_documents(docs, WORD).collect()]
    for i, t in enumerate(TEXTS):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        mine = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in mine) == ids and [p["doc_tokens"] for p in mine] == [len(ids) // 4] * len(mine)
        assert [p["start"] for p in mine] == np.cumsum([0, *(p["length"] for p in mine)])[:-1].tolist()
    windows = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert windows.get(p["sequence_id"], 0) == p["offset"]
        windows[p["sequence_id"]] = p["offset"] + p["length"]
        assert windows[p["sequence_id"]] <= p["sequence_length"]
    assert all(n & (n - 1) == 0 and n <= 2048 for n in windows.values())  # no padding at all
    assert packing.pack_documents(none, WORD).collect() == []


def test_packing_balances_step_groups_over_tasks(spark):
    rnd = random.Random(8)
    rows = [(i, "a " * rnd.choice([0, 3, 40, 200, 500, 900, 5000])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(60)
    pieces = [r.asDict() for r in packing.pack_documents(df, WORD).collect()]
    windows = {p["sequence_id"]: (p["step_group"], p["sequence_length"]) for p in pieces}
    filled, groups = {}, {}
    for p in pieces:
        filled[p["sequence_id"]] = filled.get(p["sequence_id"], 0) + p["length"]
    assert all(filled[s] == size and size & (size - 1) == 0 for s, (_, size) in windows.items())
    for group, size in windows.values():
        groups.setdefault(group % 5, {}).setdefault(group // 5, []).append(size)
    assert set(groups[0]) == set(range(len(groups[0]))) and len(groups[0]) > 2
    for tier, mine in groups.items():
        assert all(sum(sizes) == packing.STEP_TOKENS for g, sizes in mine.items() if g < max(mine)) or tier == 4
        assert {size for sizes in mine.values() for size in sizes} <= ({packing.TIERS[tier]} if tier < 4 else {1, 2, 4, 8, 16, 32, 64, 128})
    assert sum(len(x) for x in groups.get(4, {}).values()) <= 8  # what 60 tasks left was packed together


def test_packing_gives_the_same_pieces_by_a_join_that_is_not_broadcast(docs, monkeypatch):
    want = sorted(packing.pack_documents(docs.coalesce(1), WORD).collect(), key=str)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    assert sorted(packing.pack_documents(docs.coalesce(1), WORD).collect(), key=str) == want


def test_exact_dedup_gives_full_tries_off_by_subtree(spark, monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("ab") for _ in range(6)) + " " * rnd.randint(0, 3) for _ in range(400)] + ["", None, " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    best = {}
    for i, t in enumerate(texts):
        best.setdefault((t or "").replace(" ", ""), []).append((-len(t or ""), i))
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 20)
    cloudpickle.register_pickle_by_value(exact_dedup)
    try:
        got = by_id(exact_dedup.exact_duplicates(df))
    finally:
        cloudpickle.unregister_pickle_by_value(exact_dedup)
    assert len(got) == len(texts)
    for members in best.values():
        assert all((got[i]["keep_id"], got[i]["group_size"]) == (min(members)[1], len(members)) for _, i in members)


def test_exact_dedup_of_text_ids(spark):
    df = spark.createDataFrame([("a2", "x y"), ("a1", "xy "), (None, "xy "), ("b", None)], "doc_id string, text string")
    assert by_id(exact_dedup.exact_duplicates(df))["a2"]["keep_id"] == "a1"


def test_exact_dedup_against_brute_force(spark, docs, none):
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault((t or "").translate(strip), []).append((-len(t or ""), i))
    got = by_id(exact_dedup.exact_duplicates(docs))
    assert len(got) == len(TEXTS)
    for norm, members in groups.items():
        for _, i in members:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (min(members)[1], len(members), i == min(members)[1], hashlib.sha256(norm.encode()).hexdigest())
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a b"), (None, None)], "doc_id long, text string")
    assert sum(r["kept"] for r in exact_dedup.exact_duplicates(repeated).collect()) == 3
    assert exact_dedup.exact_duplicates(none).collect() == []


def test_patricia_trie_shares_and_splits():
    trie, rnd = exact_dedup.PatriciaTrie(), random.Random(1)
    keys = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    nodes = {k: trie.node(k) for k in keys}
    assert len({id(n) for n in nodes.values()}) == len(nodes) and all(trie.node(k) is nodes[k] for k in keys)
    for k, node in nodes.items():
        node.value = k
    assert sorted(trie.give_off()) == sorted(nodes) and not trie.root.children and trie.held == 0


def components(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_ngram_join_against_brute_force(spark, none):
    rnd = random.Random(4)
    base = [rnd.choice(VOCAB) for _ in range(150)]
    texts = [" ".join(base)]
    for k in range(40):
        w = list(rnd.choice(texts).split())
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"n{k}"
        texts.append(" ".join(w))
    texts += [None, "", "one two", "two one", "one two", prose(200)]
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(a, b) for a in range(len(texts)) for b in range(len(texts)) if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = components(len(texts), links)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = by_id(ngram_join.similar_documents(df))
    for i in range(len(texts)):
        twins = [j for j in range(len(texts)) if sets[j] == sets[i] and sets[i]] or [i]
        assert (got[i]["class_id"], got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (min(twins), sum(a == i for a, _ in links), root[i], root[i] == i)
    assert ngram_join.similar_documents(none).collect() == []


def test_ngram_blocks_give_the_same_links(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(60):
        w = list(base)
        w[rnd.randrange(120)] = f"n{k}"
        texts.append((k, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    whole = sorted(map(tuple, ngram_join.similar_documents(df).collect()))
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 16)
    assert sorted(map(tuple, ngram_join.similar_documents(df).collect())) == whole


def test_embedding_join_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(12, 8))
    x = np.vstack([x + rng.normal(scale=s, size=x.shape) for s in (0, 0.05, 0.12, 0.2, 0)] + [x[:3]])
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 1), (n + 3, [None] * 8, 1), (n + 4, rows[0][1], None), (n + 5, [1.0, 0.0], 0), (n + 6, [2.0, 0.0], 0), (None, rows[0][1], 0), (n + 7, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    u = [np.array(v, float) / np.linalg.norm(v) if v and None not in v and np.isfinite(v).all() and np.any(v) else None for _, v, _ in rows]
    ok = [i for i, r in enumerate(rows) if u[i] is not None and r[2] is not None and r[0] is not None]
    links = [(a, b) for a in ok for b in ok if a != b and rows[a][2] == rows[b][2] and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.93]
    root = components(len(rows), links)
    got = by_id(embedding_dedup.near_duplicates(df), "vec_id")
    for i, (vec, _, _) in enumerate(rows):
        want = (0, None) if vec is None else (sum(a == i for a, _ in links), rows[root[i]][0])
        assert (got[vec]["n_links"], got[vec]["component_id"]) == want and got[vec]["kept"] == (want[1] == vec)
    assert embedding_dedup.near_duplicates(df.where("false")).collect() == []


def test_embedding_join_draws_its_sample_from_low_hashes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(rng.normal(size=(1500, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    whole = sorted(map(tuple, embedding_dedup.near_duplicates(df, 0.999).collect()))
    sorted_rows, plain = [], type(df).orderBy

    def counted(self, *by, **kw):
        sorted_rows.append(self.count())
        return plain(self, *by, **kw)

    monkeypatch.setattr(embedding_dedup, "FIT_ROWS", 100)
    monkeypatch.setattr(type(df), "orderBy", counted)
    got = embedding_dedup.near_duplicates(df, 0.999)
    monkeypatch.undo()
    assert len(sorted_rows) == 1 and 50 <= sorted_rows[0] <= 250, "the sample's order takes the whole table"
    assert sorted(map(tuple, got.collect())) == whole


def test_embedding_join_over_many_blocks_and_tiles(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(60, 20))  # more components than a box has axes
    x = np.vstack([base + rng.normal(scale=s, size=base.shape) for s in (0, 0.1, 0.25)])
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = [(a, b) for a in range(len(x)) for b in range(len(x)) if a != b and a % 2 == b % 2 and u[a] @ u[b] >= 0.93]
    root = components(len(x), links)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 4)
    monkeypatch.setattr(embedding_dedup, "TILE_BITS", 1)
    got = by_id(embedding_dedup.near_duplicates(df), "vec_id")
    assert len(links) > 50
    assert all((got[i]["n_links"], got[i]["component_id"]) == (sum(a == i for a, _ in links), root[i]) for i in range(len(x)))


@pytest.mark.parametrize("run", [ngram_join.similar_documents, suffix_dedup.remove_repeats, lambda df: embedding_dedup.near_duplicates(df, id_col="doc_id", vector_col="v", label_col="text")])
def test_ids_that_are_no_numbers_fail_the_job(spark, run):
    df = spark.createDataFrame([("a2", "some text", [1.0])], "doc_id string, text string, v array<double>")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run(df).collect()


def brute_repeats(texts, length):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(raw[i : i + length])
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), kept))
    return out


@pytest.mark.parametrize("length", [40, 100])
def test_suffix_dedup_against_brute_force(spark, none, length):
    rnd = random.Random(length)
    texts = [*TEXTS, "ab" * 400, "é" * 300, "x" + PASSAGE, PASSAGE[:-3] + prose(30)]
    for _ in range(60):
        t = rnd.choice([t for t in texts if t])
        a = rnd.randrange(len(t))
        texts.append(prose(rnd.randint(0, 20)) + t[a : a + rnd.randint(1, 900)] + prose(rnd.randint(0, 20)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = by_id(suffix_dedup.remove_repeats(df, length))
    for i, want in enumerate(brute_repeats(texts, length)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want, i
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_suffix_dedup_deals_a_hot_seed_again(spark, monkeypatch):
    """A passage that all documents share amid different surroundings: no merge holds all segments of its edge."""
    rnd, plain = random.Random(9), suffix_dedup.repeated_windows
    other = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    shared = other(150)
    texts = [other(rnd.randint(90, 120)) + shared + other(rnd.randint(90, 120)) for _ in range(3000)]
    texts[2000:2100] = texts[:100]
    bound = suffix_dedup.MERGE_BYTES + 40_000

    def bounded(strings, base, length):
        assert sum(map(len, strings)) <= bound, "one merge holds a whole hot seed"
        return plain(strings, base, length)

    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 30_000, raising=False)
    monkeypatch.setattr(suffix_dedup, "FOLD_WINDOWS", 50, raising=False)  # many copies come to one merge
    monkeypatch.setattr(suffix_dedup, "MERGE_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "repeated_windows", bounded)
    for module in (suffix_dedup, sys.modules[__name__]):  # so that workers get the changed names
        cloudpickle.register_pickle_by_value(module)
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = by_id(suffix_dedup.remove_repeats(df))
    finally:
        for module in (suffix_dedup, sys.modules[__name__]):
            cloudpickle.unregister_pickle_by_value(module)
    for i, want in enumerate(brute_repeats(texts, 100)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want, i


def test_suffix_dedup_of_rows_that_share_ids(spark):
    df = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, "é" + PASSAGE)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, as_text=True).collect()
    assert sorted(len(r["kept"]) for r in got) == [0, 0, 1, len(PASSAGE)]


def test_chat_format_round_trip(spark):
    rnd, rows = random.Random(6), []
    for conv in range(6):
        for turn in range(conv * 9):
            role = "system" if turn == 0 and conv % 2 else rnd.choice(["user", "assistant", "tool[x]", None])
            rows.append((conv, turn, role, rnd.choice([None, "", TEXTS[-1], prose(rnd.randint(1, 60)), prose(300)])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    made = [r.asDict(recursive=True) for r in chat_format.format_conversations(df, BYTE, budget=256, history=64).collect()]
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        windows = sorted((m for m in made if m["conv_id"] == conv), key=lambda m: m["window"])
        assert [x for m in windows for x in chat_format.read_turns(m["formatted"][m["new_from"] :])] == turns
        under = [chat_format.unescape(m["formatted"][s["begin"] : s["end"]]) for m in windows for s in m["loss"]]
        assert under == [t for r, t in turns if r == "assistant"]
        assert all(m["n_tokens"] <= 256 or m["n_new"] == 1 for m in windows)
        if turns[0][0] == "system":
            assert all(m["formatted"].startswith("<s><<SYS>>") for m in windows)
    assert chat_format.format_conversations(df.where("false"), BYTE).collect() == []
    alone = spark.createDataFrame([(None, 1, "user", "a"), (None, 1, "user", "a")], "conv_id long, turn long, role string, text string")
    assert [r["n_new"] for r in chat_format.format_conversations(alone, BYTE).collect()] == [2]


def test_conversations_read_back_with_control_strings(spark):
    from panelwright.llm import queries

    rows = [*queries.CONTROL_TURNS, (5, 2, "assistant", "x" * 9000), (5, 1, "user", None), (5, 0, None, "s"), (5, 3, "assistant", "</s>"), (6, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = by_id(queries.read_windows(chat_format.format_conversations(df, BYTE)), "conv_id")
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for c, _, r, t in sorted(rows, key=lambda r: r[:2]) if c == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[conv])[:5] == (conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss))


def test_quality_learns_once_from_a_repeated_id(spark):
    base = [(i, f"good clean text {i}" if i % 2 else f"BAD!!! bad {i} {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = spark.createDataFrame(base, "doc_id long, text string")
    often = spark.createDataFrame(base + [base[3]] * 500 + [base[4]] * 300, "doc_id long, text string").repartition(5)
    assert quality.fit_quality(once, labels) == quality.fit_quality(often, labels)


def test_quality_gradient_agrees_with_finite_differences():
    s = quality.Settings(buckets=16, dim=3, epochs=1, rate=1e-3)
    ids, share = np.array([1, 4, 9], np.int32), np.array([0.5, 0.25, 0.25], np.float32)
    rng = np.random.default_rng(s.seed)
    emb = rng.normal(0, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    top = rng.normal(0, 0.3, (s.dim, 2)).astype(np.float32)

    def loss(e, t):
        z = (share.astype(float) @ e[ids]) @ t
        return float(np.log(np.exp(z).sum()) - z[1])

    after, top_after, _ = quality.train([(ids, share)], np.array([1]), s)
    for k, bucket in enumerate(ids):
        for d in range(s.dim):
            up, down = emb.astype(float), emb.astype(float)
            up[bucket, d] += 1e-4
            down[bucket, d] -= 1e-4
            slope = (loss(up, top.astype(float)) - loss(down, top.astype(float))) / 2e-4
            moved = float(emb[bucket, d] - after[bucket, d]) / s.rate / len(ids) ** 0.5
            assert abs(moved - slope) < 2e-3
    assert np.array_equal(np.delete(emb, ids, 0), np.delete(after, ids, 0)) and not np.array_equal(top, top_after)


def test_quality_learns_held_out_labels_and_keeps_empty_rows(spark, docs, none):
    sf = "/root/testdata/sf0.01"
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = {r[0] for r in labels.select("doc_id").collect() if zlib.crc32(str(r[0]).encode()) % 3 == 1}
    model = quality.fit_quality(d, labels.where(~labels.doc_id.isin(list(held))))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = {r["doc_id"]: r["score"] >= 0.5 for r in quality.score_documents(d, model).collect() if r["doc_id"] in held}
    assert np.mean([got[i] == bool(truth[i]) for i in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in quality.score_documents(docs, model).collect())
    assert quality.fit_quality(none, labels) is None and quality.score_documents(none, model).collect() == []
