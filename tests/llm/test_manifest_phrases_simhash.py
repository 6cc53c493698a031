"""Merkle manifest, collocations and SimHash against brute force, with the defined cases."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
import xxhash

from blotter.llm import op11_merkle, op12_collocations, op13_simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = ("doc_id long, text string, lang string, source string, n_chars long, leaf string, part int, tree long, pos long, n int, "
       "key string, fp long, first int, size string, a string, w1 string, id int, skey string, hash string, told string")
EXTRA = ("x", 1, 2, 3, 4, "k", 5, 6, "s", "a", "w", 7, "sk", "h", "t")


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOC).repartition(parts)


# ---- op11 ------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def beside(lv, i):
    out = []
    for nodes in lv[:-1]:
        run = i // 3 * 3
        out.append((nodes[run:i], nodes[i + 1:run + 3]))
        i //= 3
    return out


def plain_manifest(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = {s: levels([leaf(*r) for r in by[s]]) for s in sources}
    top, out = levels([trees[s][-1][0] for s in sources]), collections.Counter()
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path, folded = beside(trees[s], i) + beside(top, k), leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                folded = leaf(r[0], r[1].replace("\n", ""), *r[2:])
            for a, b in path:
                folded = H(*a, folded, *b)
            root = top[-1][0]
            out[(r[0], leaf(*r), trees[s][-1][0], root, H(*[x for a, b in path for x in a + b]), folded, folded == root)] += 1
    return out


@pytest.fixture(scope="module")
def merkle_rows():
    rng = np.random.default_rng(5)
    rows = [(i, f"té {i}\nx" * int(rng.integers(0, 3)), "en", ["a", "b", "hot", "hot", "hot", "é", "~"][i % 7], i) for i in range(400)]
    rows += [(None, "no id\n", None, None, None), (None, None, "en", "hot", 1), (-5, None, None, None, None), (1000, "", "", "", 0),
             (1001, "lone\n" * 50000, "en", "lone", 7), *[(2, "twice\n", "en", "hot", 1)] * 5]
    return rows


@pytest.mark.parametrize("part_rows, block_levels", [(4_000, 7), (5, 1), (7, 2), (1, 3)])
def test_merkle_proofs(spark, merkle_rows, monkeypatch, part_rows, block_levels):
    monkeypatch.setattr(op11_merkle, "PART_ROWS", part_rows)
    monkeypatch.setattr(op11_merkle, "BLOCK_LEVELS", block_levels)
    got = collections.Counter(tuple(r) for r in op11_merkle.verify_tampered(docs_of(spark, merkle_rows)).collect())
    assert got == plain_manifest(merkle_rows)


def test_merkle_small_and_empty(spark):
    assert op11_merkle.verify_tampered(docs_of(spark, [])).count() == 0
    for rows in ([(1, "a", "en", "s", 1)], [(1, "a", "en", "s", 1), (2, "b", "en", None, 1)], [(i, "a", "en", str(i), 1) for i in range(30)]):
        assert collections.Counter(tuple(r) for r in op11_merkle.verify_tampered(docs_of(spark, rows)).collect()) == plain_manifest(rows)


def test_lacking_nodes_are_enough_and_no_more():
    for n, (lo, hi) in ((n, span) for n in (1, 2, 3, 4, 10, 27, 28, 40) for span in itertools.combinations_with_replacement(range(n), 2)):
        lv = levels([str(i) for i in range(n)])
        need = op11_merkle.lacking(n, lo, hi)
        got = {(0, level, i): lv[level][i] for level, i in need}
        own, root = op11_merkle.derive(0, n, lo, lv[0][lo:hi + 1], got)
        assert root == lv[-1][0]
        for level, i in need:  # not to be had from the leaves themselves
            assert not lo // 3 ** level <= i <= hi // 3 ** level
        for at in range(lo, hi + 1):
            assert op11_merkle.beside(own, at) == [("".join(a), "".join(b)) for a, b in beside(lv, at)]


def test_merkle_siblings_and_wrong_node(spark, merkle_rows):
    docs = docs_of(spark, merkle_rows)
    for r in op11_merkle.proofs(op11_merkle.build_manifest(docs), siblings=True).collect():
        assert r.verified and H(*r.siblings) == r.proof_sha256
    m = op11_merkle.build_manifest(docs)
    bad = m.nodes.withColumn("hash", op11_merkle.F.lit("0" * 64))
    with pytest.raises(Exception, match="do not lead to the manifest's root"):
        op11_merkle.proofs(op11_merkle.Manifest(m.leaves, bad, m.trees)).collect()


# ---- op12 ------------------------------------------------------------------

def plain_phrases(rows, least, top, subsumed):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und" if lang != "" else ""] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        around = collections.Counter()
        for p, a in cands.items():
            for i, j in itertools.combinations(range(len(p) + 1), 2):
                if 1 < j - i < len(p):
                    around[p[i:j]] = max(around[p[i:j]], a)
        found = []
        for p, a in cands.items():
            if 100 * around[p] < subsumed * a:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = np.random.default_rng(9)
    words = ["a", "B", "ç", "the", "of", "x1", "zz", "\xa0q", "中"]
    rows = []
    for i in range(60):
        body = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"])) for _ in range(int(rng.integers(0, 120))))
        rows.append((body, [None, "und", "en", "en", "en", "", "fr"][i % 7]))
    rows += [(None, "en"), ("", None), (" \t.,;\n", "en"), ("of the of the of the " * 40, "en"), ("ha " * 300, "fr"), ("new york city hall " * 30, "de")]
    rows += [("same Row, twice", "en")] * 2
    return rows


def phrase_docs(spark, rows):
    return docs_of(spark, [(1, t, lang, "s", 1) for t, lang in rows])


@pytest.mark.parametrize("slice_bytes, entries", [(4 << 20, 1_500_000), (16, 20)])
def test_collocations(spark, phrase_rows, monkeypatch, slice_bytes, entries):
    monkeypatch.setattr(op12_collocations, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(op12_collocations, "ENTRIES", entries)
    got = sorted(tuple(r) for r in op12_collocations.collocations(phrase_docs(spark, phrase_rows), least=5, top=25).collect())
    want = plain_phrases(phrase_rows, 5, 25, 80)
    assert got == want and len(want) > 60


def test_collocations_do_not_need_right_bits(spark, phrase_rows, monkeypatch):
    """A full bit array (no pruning at all) and a tiny one give the same phrases."""
    want = plain_phrases(phrase_rows, 5, 2000, 80)
    docs = phrase_docs(spark, phrase_rows)
    with monkeypatch.context() as m:
        m.setattr(op12_collocations, "pair_bits", lambda pairs: b"\xff" * (op12_collocations.BITS // 8))
        assert sorted(tuple(r) for r in op12_collocations.collocations(docs, least=5).collect()) == want
    assert sorted(tuple(r) for r in op12_collocations.collocations(docs, least=5).collect()) == want


def test_collocations_long_text_and_empty(spark):
    long = "one two three four " * 60000 + "five. " + "x" * 300000   # no end of a piece for over a megabyte
    got = [tuple(r) for r in op12_collocations.collocations(docs_of(spark, [(1, long, "en", "s", 1)])).collect()]
    assert got == plain_phrases([(long, "en")], 30, 2000, 80)
    assert op12_collocations.collocations(docs_of(spark, [])).count() == 0
    assert op12_collocations.collocations(docs_of(spark, [(1, None, None, None, None)])).count() == 0


def test_scores_past_64_bits(spark):
    a = 9 * 10 ** 12
    counted = spark.createDataFrame([(1, "en", 1, None, None, None, a + 5, "p"), (1, "en", 2, None, None, None, a + 7, "q"), (2, "en", 1, 2, None, None, a, None)],
                                    "size int, lang string, w1 long, w2 long, w3 long, w4 long, a long, text string")
    assert [tuple(r) for r in op12_collocations.score_phrases(counted).collect()] == [("en", "p q", a, a + 5, a + 7, 2000000 * a // (2 * a + 12))]


# ---- op13 ------------------------------------------------------------------

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids):
    a, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 3, 1)).tolist():
        x, y = find(i), find(j)
        parent[max(x, y)] = min(x, y)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash(spark):
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abcdé"), 5)) for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "ONE Two"), (None, "one two"), (None, "nobody else\xa0here now"),
            (7, " ".join(base)), (8, "  ".join(base)), (9, " ".join(["changed", *base[1:]])), (10, " ".join([*base[:200], "new", *base[200:]])),
            (7, " ".join(base)), (11, "aaa aaa aaa aaa"), (12, "x " * 700000), (13, "Ünï \x1f a b c")]
    docs = docs_of(spark, [(d, t, "en", "s", 1) for d, t in rows])
    got = collections.Counter(tuple(r) for r in op13_simhash.near_duplicates(docs).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    assert got == collections.Counter(zip([d for d, _ in rows], [f"{f:016x}" for f in fps], plain_components(fps, [d for d, _ in rows])))
    assert op13_simhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("block", [4096, 8, 1])
def test_links_among_fingerprints(spark, monkeypatch, block):
    """Every link of at most three bits, wherever the bits lie, with buckets cut again and compared in blocks."""
    monkeypatch.setattr(op13_simhash, "BLOCK", block)
    rng = np.random.default_rng(1)
    half = [int(x) for x in rng.integers(0, 1 << 32, 3)]
    fps = {0, (1 << 64) - 1}
    for _ in range(150):                      # one hot half on either side, and neighbours of these
        fps.add(half[0] << 32 | int(rng.integers(0, 1 << 12)))
        fps.add(int(rng.integers(0, 1 << 12)) << 50 | half[1])
    for x in [int(x) for x in rng.integers(0, 1 << 63, 30)]:
        fps.add(x)
        for k in range(1, 5):
            y = x
            for b in rng.choice(64, k, replace=False).tolist():
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = {(r.a, r.b) for r in op13_simhash.find_links(df).collect()}
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 and a < b for a, b in links)
    parent = {x: x for x in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[find(a)] = find(b)
    want = plain_components(fps, list(range(len(fps))))
    pairs = {(want[i], find(x)) for i, x in enumerate(signed)}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
