"""Operators on documents against brute force, with the defined cases: nulls, empties, long texts, ties, extra columns."""

import collections
import hashlib
import itertools
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm import common, op1_token_counts, op2_decontaminate, op3_packing, op4_neardup, op5_binary, op6_quality, op7_suffix, oracles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, id string, key int, count long, ranges string, rank string, n long"


def passage(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghé"), rng.integers(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base, other = passage(1, 300), passage(2, 200)
    words = base.split()
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, base), (6, base), (7, base.upper()),
        (8, " ".join(["x"] + words[1:])), (9, " ".join(words[:150] + ["zz"] + words[151:])), (10, other),
        (11, passage(3, 60) + " " + base[200:900] + " " + passage(4, 60)), (12, "a" * 2500), (13, "café <|endoftext|> it's 12 中文"),
        (14, other + "  two  blanks\n\n" + other), (15, passage(5, 9000)), (16, "é" * 500), (16, "é" * 500), (None, passage(6, 80)),
        (17, "one one one one " * 30), (18, "aaa" * 40 + " aaaa! don't\x1fstop"),
    ]
    return [(d, t, "x", 1, 2, "r", None, 3) for d, t in texts]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC)


def shingles(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = WORDS.findall(low)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_token_counts(spark, docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter((r[0], len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    got = op1_token_counts.count_tokens(docs).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert op1_token_counts.count_tokens(empty(spark)).count() == 0


def test_memos_are_bounded_in_bytes(monkeypatch):
    """Texts with a rare white space, long chunks and many words leave no more in a worker than the bound."""
    from blotter.llm import tokens
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(2)
    texts = [f"{passage(i, 400)}\u00a0{passage(i + 1000, 20)}" for i in range(40)] + ["x" * 5000 + str(i) + " y" for i in range(50)]
    texts += [" ".join("".join(rng.choice(list("abcdefghij"), 9)) for _ in range(3000)) for _ in range(4)] + ["", None, "\u3000", "a\x1fb<|endoftext|>\u00a0c"]
    monkeypatch.setattr(op1_token_counts, "MEMO_BYTES", 200_000)
    monkeypatch.setattr(op1_token_counts, "ROW_CHUNKS", 700)
    counter = op1_token_counts.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
    want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for at in range(0, len(texts), 7):
        assert counter.count_batch(texts[at:at + 7]) == want[at:at + 7]
        # one look-up of at most ROW_CHUNKS chunks (and the last of a text before it) may pass the bound
        assert sum(len(k) + tokens.ENTRY_BYTES for m in (counter.memo, counter.pre_memo) for k in m) < 200_000 + 2 * 2 * 700 * 400
    monkeypatch.setattr(tokens, "MEMO_BYTES", 100_000)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        enc, lib = tokens.ChunkEncoder(path), Tokenizer.from_file(path)
        for t in texts:
            assert np.frombuffer(enc.encode(t), np.uint32).tolist() == lib.encode(t or "", add_special_tokens=False).ids
            assert sum(len(k) + len(v) for k, v in enc.memo.items()) < 100_000 + 1000 and all(len(k) <= tokens.LONG_CHUNK for k in enc.memo)


def test_a_full_memo_keeps_what_it_met_first(monkeypatch):
    """Rare words don't drive out the frequent ones, and ids stay the library's."""
    from blotter.llm import tokens
    monkeypatch.setattr(tokens, "MEMO_BYTES", 20_000)
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, lib = tokens.ChunkEncoder(path), Tokenizer.from_file(path)
    common_text = "the usual words, of ünsere texts"
    for t in [common_text, *(passage(i, 40) for i in range(20))]:
        assert np.frombuffer(enc.encode(t), np.uint32).tolist() == lib.encode(t, add_special_tokens=False).ids
        assert {"the", " usual", " words,", " texts"} <= enc.memo.keys()


def test_chunks_tell_what_must_be_encoded_whole():
    """White space and special strings anywhere in a text, next to words already known, give the library's ids."""
    from blotter.llm import tokens
    rng = np.random.default_rng(6)
    parts = ["ab", "Ünß", "ªº", "naïve.", "don't", "x1", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\n\n", "\t", "\r", "\x0b", "\x0c", "\0", "\x1c",
             "\x85", "\u00a0", "\u2003", "\u200b", "\u3000", "\ufeff", "…", "é", "e\u0301", "日本", "😀", ".", "\xad", "\x7f"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        enc, lib = tokens.ChunkEncoder(path), Tokenizer.from_file(path)
        for _ in range(6000):
            t = "".join(p + " " * int(rng.random() < .6) for p in rng.choice(parts, int(rng.integers(1, 7))))
            assert np.frombuffer(enc.encode(t), np.uint32).tolist() == lib.encode(t, add_special_tokens=False).ids, (name, t)


def test_merges_one_by_one():
    """Simultaneous merging equals merging the leftmost lowest-rank pair again and again."""
    pairs = [(0, 0), (0, 1), (2, 1), (2, 2), (3, 0)]
    made = np.array([2, 3, 4, 5, 6])
    table = op1_token_counts.MergeTable(np.array([(a << 32) | b for a, b in pairs]), made)
    rng = np.random.default_rng(0)
    seqs = [rng.integers(0, 3, rng.integers(1, 12)).tolist() for _ in range(300)]

    def plain(s):
        while True:
            ranks = [pairs.index(p) if p in pairs else 99 for p in zip(s, s[1:])]
            if not ranks or min(ranks) == 99:
                return len(s)
            k, out, i = min(ranks), [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == pairs[k]:
                    out.append(int(made[k]))
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            s = out
    offs = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    assert op1_token_counts.merge_counts(np.concatenate(seqs), offs, table).tolist() == [plain(s) for s in seqs]


def best_fit(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= x]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= x
        else:
            free.append(capacity - x)
    return sorted(free)


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for capacity in (10, 64, 100):
        lengths = rng.integers(1, capacity + 1, 400).tolist()
        runs = op3_packing.plan_runs(collections.Counter(lengths), capacity)
        free, seen = collections.Counter(), collections.Counter()
        for length, first, last, per, b, at in runs:
            for r in range(first, last):
                free[b + (r - first) // per] += length
                assert at + (r - first) % per * length + length <= capacity
                seen[length] += 1
        assert seen == collections.Counter(lengths)
        assert sorted(capacity - f for f in free.values()) == best_fit(lengths, capacity)


def test_packing(spark, docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want[(r[0], k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()))] += 1
    got = op3_packing.pack_documents(docs).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) == len(best_fit([k[3] for k in want.elements()], 2048))
    assert op3_packing.pack_documents(empty(spark)).count() == 0


def test_binary_round_trip(spark, docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = collections.defaultdict(list)
    for r in rows:
        ids[r[0]].append(tok.encode(r[1] or "", add_special_tokens=False).ids + [2])
    want, at = collections.Counter(), 0
    for d in sorted(ids, key=lambda x: (x is not None, x)):
        for i in ids[d]:  # the repeated rows are equal here, so their order does not matter
            want[(d, at, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))] += 1
            at += len(i)
    got = op5_binary.write_and_read(docs).collect()
    assert collections.Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    assert op5_binary.write_and_read(empty(spark)).count() == 0


def test_index_lookup(spark, docs):
    folder = common.work_dir(spark, "ids-test")
    locators = common.materialize(op5_binary.write_payload(docs, folder, "word_bpe_49k.json", 2), "loc")
    index = common.materialize(op5_binary.write_index(locators, folder), "idx")
    keys = spark.createDataFrame([(5,), (None,), (16,), (999,)], "doc_id long")
    found = op5_binary.read_runs(op5_binary.lookup(keys, index, folder), folder, with_ids=True).collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 5, 16, 16]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert next(list(r.ids) for r in found if r.doc_id == 5) == tok.encode(passage(1, 300), add_special_tokens=False).ids + [2]


def test_perfect_hash_is_minimal():
    keys = common.mix64(np.arange(5000, dtype=np.uint64))
    f = op5_binary.PerfectHash.build(keys)
    assert sorted(op5_binary.PerfectHash.slots(f, keys).tolist()) == list(range(5000))


@pytest.mark.parametrize("percent", [85, 50])
def test_near_duplicates(spark, docs, rows, percent):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = op4_neardup.near_duplicates(docs, percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
        else:
            assert r.component_id is None and r.kept
    assert op4_neardup.near_duplicates(empty(spark)).count() == 0


def test_blocks_find_links_the_hubs_miss(spark, monkeypatch):
    """A star of variants: only the middle links them, in blocks of two members."""
    monkeypatch.setattr(op4_neardup, "BLOCK", 2)
    words = passage(9, 120).split()
    texts = [" ".join(words)] + [" ".join(words[:k] + [f"v{k}"] + words[k + 1:]) for k in range(10, 110, 10)]
    df = spark.createDataFrame([(i + 100, t) for i, t in enumerate(texts[::-1])], "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    percent = 90
    assert all(100 * len(sets[0] & s) >= percent * len(sets[0] | s) for s in sets[1:])
    assert not any(100 * len(a & b) >= percent * len(a | b) for i, a in enumerate(sets[1:]) for b in sets[i + 2:])
    got = op4_neardup.near_duplicates(df, percent=percent).collect()
    assert {r.component_id for r in got} == {100}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    b = np.concatenate([a[:320], np.unique(rng.integers(0, 1 << 62, 80).astype(np.uint64))])
    sig = op4_neardup.superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 200)
    assert abs((sig[0] == sig[1]).mean() - 320 / 480) < 0.12


def test_keep_one(spark, docs, rows):
    kept = op4_neardup.keep_one(docs, percent=85)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 7, 10, 11, 12, 13, 15, 16, 17, 18]  # 14 says 10 twice
    assert op4_neardup.keep_one(empty(spark)).count() == 0


def test_quality_statistics(spark, docs, rows):
    labels = spark.createDataFrame([(5, 1, 0), (10, 1, 0), (12, 0, 0), (17, 0, 1), (17, 1, 1), (None, 0, 0), (6, None, 0)],
                                   "doc_id long, quality int, toxic int")
    want = collections.Counter()
    for r in rows:
        t = r[1] or ""
        w = WORDS.findall(t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        often = collections.Counter(grams)
        cover = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        want[(r[0], len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
              len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    got = op6_quality.judge(docs, labels).collect()
    assert collections.Counter(tuple(r)[:-1] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    nothing = labels.where("false")
    assert all(r.kept != r.base_failed for r in op6_quality.judge(docs, nothing).collect())
    stay = op6_quality.keep_documents(docs, nothing)
    assert stay.columns == docs.columns
    assert stay.count() == sum(1 for r in got if not r.base_failed)
    assert op6_quality.judge(empty(spark), labels).count() == 0


def test_decision_list_separates(spark, sf_dir):
    """Held-out agreement with the labels, on a table with some hundred of them."""
    sf_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    stats = op6_quality.with_stats(common.table(spark, sf_dir, "documents")).select("doc_id", "q.*")
    labels = common.table(spark, sf_dir, "labels")
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    rules = op6_quality.learn_from(stats, labels.where(half), min_cover=0.0)
    told = stats.join(labels.where(~half), "doc_id").select("quality", rules.keeps().alias("kept")).collect()
    good = [r.kept for r in told if r.quality == 1]
    bad = [r.kept for r in told if r.quality == 0]
    assert sum(good) >= 0.95 * len(good)
    assert sum(bad) <= 0.5 * len(bad)


def repeats(texts, window):
    seen = collections.Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t) + 1, int)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                hit[i] += 1
                hit[i + window] -= 1
        out.append(np.cumsum(hit)[:-1] > 0)
    return out


@pytest.mark.parametrize("hot", [op7_suffix.HOT, 1])
def test_repeated_strings(spark, docs, rows, hot):
    texts = [(r[1] or "").encode() for r in rows]
    want = collections.Counter()
    for r, t, hit in zip(rows, texts, repeats(texts, 400)):
        kept = bytes(np.frombuffer(t, np.uint8)[~hit])
        spans = int((hit[1:] & ~hit[:-1]).sum() + hit[:1].sum())
        want[(r[0], len(t), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    got = op7_suffix.removals(docs, hot=hot).collect()
    assert collections.Counter(map(tuple, got)) == want
    assert op7_suffix.removals(empty(spark)).count() == 0


def test_repeats_in_small_alphabets(spark):
    """Many overlaps, short windows, texts cut into slices."""
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("ab"), rng.integers(0, 300))) for _ in range(40)] + ["ab" * 80, "a" * 90, "a" * 91]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = [t.encode() for t in texts]
    want = {i: int(h.sum()) for i, h in enumerate(repeats(raw, 12))}
    for hot in (op7_suffix.HOT, 1):
        got = {r.doc_id: r.n_removed for r in op7_suffix.removals(df, window=12, gram=5, hot=hot).collect()}
        assert got == want


def test_remove_repeats_keeps_characters_whole(spark, docs):
    out = op7_suffix.remove_repeats(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[5] == "" and texts[10] == "" and texts[16] == ""
    assert texts[15] == passage(5, 9000)


@pytest.fixture(scope="module")
def benchmark_items(spark):
    rows = [(1, passage(21, 40)), (2, passage(22, 15)), (3, "short item of five words"), (4, None), (5, "..."), (6, passage(21, 40))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination(spark, benchmark_items):
    one = passage(21, 40).split()
    swapped = [w if i % 7 != 6 else "zz" for i, w in enumerate(one)]
    rows = [
        (1, passage(31, 50) + " " + " ".join(one).upper() + ". " + passage(32, 50)), (2, passage(33, 30) + " " + " ".join(swapped)),
        (3, "Some SHORT item, of five words!"), (4, passage(34, 200)), (5, None), (6, ""), (7, passage(22, 15)), (7, passage(22, 15)),
        (8, " ".join(one[:20]) + " " + passage(35, 60)), (9, " ".join(one[:8]) + " " + passage(36, 60)), (None, passage(22, 15)),
    ]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, item_id int")
    for block in (op2_decontaminate.BLOCK_SEEDS, 40):
        got = {(r.doc_id, r.item_id) for r in op2_decontaminate.contaminated(df, benchmark_items, block_seeds=block).collect()}
        assert got == {(1, 1), (1, 6), (2, 1), (2, 6), (3, 3), (7, 2), (8, 1), (8, 6), (None, 2)}
    clean = op2_decontaminate.clean_documents(df, benchmark_items)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 9]
    assert op2_decontaminate.contaminated(df, benchmark_items.where("false")).count() == 0
    assert op2_decontaminate.contaminated(df.where("false"), benchmark_items).count() == 0


def test_decontamination_broadcast_is_bounded(spark):
    """Seeds have a fixed width and one item's seeds, or one seed's places, are split over blocks."""
    rows = [(1, passage(41, 3000)), (2, passage(41, 3000)), (3, " ".join(["la"] * 2000))]
    items = spark.createDataFrame(rows, "item_id long, text string")
    seeds, _ = op2_decontaminate.item_seeds(op2_decontaminate.item_words(items))
    assert {t for _, t in seeds.dtypes} <= {"bigint", "int"}
    blocks = op2_decontaminate.seed_blocks(seeds, 2000)
    sizes = [b.count() for b in blocks]
    assert sum(sizes) == seeds.count() >= 3 * (2989 + 1989) and max(sizes) < 2400
    docs = spark.createDataFrame([(1, passage(42, 30) + " " + rows[0][1]), (2, " ".join(["la"] * 40)), (3, passage(43, 500))], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in op2_decontaminate.contaminated(docs, items, block_seeds=4000).collect()}
    assert got == {(1, 1, 3000), (1, 2, 3000), (2, 3, 40)}


def qualifying(n: int, need: int):
    """Least sets of equal places of an ``n``-word item that score ``need``."""
    for others in range((n - need) // 2 + 1):
        for start in range(n - need - 2 * others + 1):
            for out in itertools.combinations(range(start + 1, start + need + 2 * others - 1), others):
                yield [j for j in range(start, start + need + 2 * others) if j not in out]


def test_decontamination_sure_runs(spark):
    """Every qualifying pattern of items of up to 22 words holds the run that is sought, by enumeration."""
    items = spark.createDataFrame([(n, passage(n, n)) for n in range(1, 23)], "item_id long, text string")
    items = op2_decontaminate.item_words(items)
    runs = {r.n: r.run for r in items.select(F.size("item").alias("n"), op2_decontaminate.sure_run(
        op2_decontaminate.words_needed(13, 0.8)).alias("run")).collect()}
    for n, run in runs.items():
        least = min(max(len(list(g)) for hit, g in itertools.groupby(j in p for j in range(n)) if hit)
                    for p in map(set, qualifying(n, min(13, -(-4 * n // 5)))))
        assert least >= run, n


def test_decontamination_short_items_match_sql(spark):
    """Items of 8 to 20 words: every single substitution, and patterns of up to three, as the SQL finds them."""
    rng, items, docs = np.random.default_rng(5), [], []
    for n in range(8, 21):
        words = [f"w{n}x{j}" for j in range(n)]
        items.append((n, " ".join(words)))
        patterns = [set(range(n)) - {j} for j in range(n)] + [set(range(n)) - {j, j + 1} for j in range(n - 1)]
        every = list(qualifying(n, min(13, -(-4 * n // 5))))
        patterns += [set(every[i]) for i in rng.permutation(len(every))[:40]] + [set(range(1, n)), set(range(n - 1))]
        patterns += [set(rng.permutation(n)[:n - 4].tolist())]
        docs += [" ".join(w if j in p else "zz" for j, w in enumerate(words)) for p in patterns]
    docs = list(enumerate(f"lead {d} tail" for d in docs))
    got = op2_decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = con.execute(oracles.LEAKS).fetchall()
    assert len(want) > 500
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_decontamination_needs_no_python(spark, benchmark_items):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = op2_decontaminate.contaminated(df, benchmark_items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_cuts_lie_in_the_middle_of_a_gap():
    """Neither class is held to the last of its rows: 0 of the good, 8 and more of the bad, gives a cut near 4."""
    grid = {"x": op6_quality._with_middles([0.0, 8.0, 9.0, 10.0])}
    rows = [{"f": 0, "b": sum(c < v for c in grid["x"]), "bad": bad, "count": n}
            for v, bad, n in ((0.0, 0, 50), (8.0, 1, 20), (9.0, 1, 5), (10.0, 1, 5))]
    best = op6_quality._best(rows, ["x"], grid, 30, 50)
    assert (best.feature, best.above, best.cut) == ("x", True, 4.0)


@pytest.mark.parametrize("block, block_shingles", [(3, 2_000_000), (600, 150), (2, 40)])
def test_blocks_are_bounded_in_members_and_shingles(spark, monkeypatch, block, block_shingles):
    """Near copies of one text in small blocks, with far longer texts in the same buckets: the groups of brute force."""
    monkeypatch.setattr(op4_neardup, "BLOCK", block)
    monkeypatch.setattr(op4_neardup, "BLOCK_SHINGLES", block_shingles)
    base, rows = passage(50, 120).split(), []
    rng = np.random.default_rng(7)
    for i in range(24):
        w = list(base)
        for at in rng.choice(120, int(rng.integers(0, 5)), replace=False):
            w[int(at)] = f"w{i}"
        rows.append((i, " ".join(w if i % 6 else w + passage(60 + i, 900).split())))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        inter = len(sets[i] & sets[j])
        if 100 * inter >= 85 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op4_neardup.near_duplicates(df, bands=40, rows=2).collect()}
    assert got == {i: find(i) for i in range(len(rows))} and len(set(got.values())) > 3
