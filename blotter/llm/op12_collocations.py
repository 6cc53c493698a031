"""Collocations of two to four words by merged stripes.

Stripes. Each prefix of no, one, two or three words has an associative counter of
the words that come next. A task counts over a bounded run of words and hands its
stripes on in slices: a stripe is cut by the hash of (prefix, next word), so the
stripe of a prefix that holds a third of all words is spread over all buckets, and
equal entries of all tasks meet in one. There they are merged elementwise. An entry
is the count of a phrase; so the merged stripes hold every phrase's extensions, the
totals of its prefixes and of its rests, and the greatest longer phrase around it.

Only phrases that occur ``least`` times matter, and every part of such a phrase
occurs as often. The first pass merges the stripes of no and of one word; the
second keeps the longer phrases whose word pairs all may be frequent, judged by a
bit array of fixed size over the pairs' hashes. Wrong bits only let rare phrases
through to the exact counts.

Words and phrases are told apart by 64-bit hashes that include the language.

Defined cases: a null text is empty, a null language is ``und``; texts without
words count nothing; pieces end with the text; repeated rows count again; a very
long text is worked through in slices that end with a piece; languages without a
candidate give no rows, nor does an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

LEAST, TOP, SUBSUMED = 30, 2000, 80     # least count, phrases a language, percent of a phrase's count that a longer one needs
WORDS = 4                  # longest phrase
SLICE_BYTES = 1 << 20      # text worked on at once, to the next end of a piece
ENTRIES = 1_000_000        # entries of a task's stripes before they are handed on
BUCKET_BYTES = 4 << 20     # text whose entries share a bucket, about
BITS = 1 << 27             # of the array over frequent pairs
SEGMENT = 1 << 15          # bits made in one group
SALT = 64                  # parts of a language in the first choice of the top phrases

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_OUT = _ENDS.copy()
_OUT[[0x20, 0x09]] = True


def words_of(data: np.ndarray, offs: np.ndarray, tongues: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, key, together) of all words; together: the next word follows in the same piece."""
    inside = ~_OUT[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offs[:-1][offs[:-1] < offs[1:]]
    first[at] = inside[at]
    last[at[at > 0] - 1] = inside[at[at > 0] - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(offs, starts, side="right") - 1
    key = C.mix64(C.PrefixHash(data).ranges(starts, stops) ^ tongues[owner]) if len(starts) else np.zeros(0, np.uint64)
    piece = np.cumsum(_ENDS[data], dtype=np.int64)[starts]
    together = np.zeros(len(starts), bool)
    together[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    return starts, stops, key, together


def phrase_key(words: list[np.ndarray]) -> np.ndarray:
    out = words[0]
    for w in words[1:]:
        out = C.mix64(C.mix64(out) ^ w)  # mixed first: a repeated word must not cancel itself
    return out


def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """Lowered bytes, text bounds, language hash and number per text, and the languages, in slices that end with a piece."""
    data, offs = C.text_buffers(batch.column("text"))
    data = C._LOWER[data]
    names, number = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
    tongues = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], np.uint64)
    begin, end = 0, len(data)
    while begin < end:
        upto = min(begin + SLICE_BYTES, end)
        while upto < end and upto not in offs:  # on to the next end of a piece or text, looked for stretch by stretch
            found = np.flatnonzero(_ENDS[data[upto:upto + SLICE_BYTES]])
            limit = int(offs[np.searchsorted(offs, upto)])
            upto = min(limit, upto + int(found[0]) + 1) if len(found) else min(limit, upto + SLICE_BYTES)
            if len(found):
                break
        lo, hi = np.searchsorted(offs, begin, side="right") - 1, np.searchsorted(offs, upto)
        yield data[begin:upto], np.clip(offs[lo:hi + 1], begin, upto) - begin, tongues[number[lo:hi]], number[lo:hi], names.tolist()
        begin = upto


def merged(key: np.ndarray, parts: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Entries of equal key as one, their counts added; in the order of the key."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], [p[order[first]] for p in parts], np.add.reduceat(counts[order], first) if len(key) else counts


def bucket_starts(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers in use and the bounds of their entries, for keys in ascending order."""
    where = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(key) else np.zeros(0, np.int64)
    return where[first].astype(np.int64), np.append(first, len(key))


class Stripes:
    """A task's stripes of one length: entries (prefix words, next word, count), handed on when they are many."""

    def __init__(self, size: int, buckets: int):
        self.size, self.buckets, self.held, self.parts = size, buckets, 0, []

    def add(self, words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.parts.append(merged(phrase_key(words), words, np.ones(len(words[0]), np.int64)))
        self.held += len(self.parts[-1][0])
        if self.held >= ENTRIES:
            yield from self.hand_on()

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        key, words, counts = merged(np.concatenate([p[0] for p in self.parts]), [np.concatenate([p[1][i] for p in self.parts]) for i in range(self.size)],
                                    np.concatenate([p[2] for p in self.parts]))
        self.held, self.parts = 0, []
        where, bounds = bucket_starts(key, self.buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(where), self.size, np.int32)), pa.nulls(len(where), pa.string()), pa.array(where),
             packed(words, counts, bounds), pa.nulls(len(where), pa.list_(pa.string()))], names=ENTRY_NAMES)


def layout(size: int) -> np.dtype:
    """An entry as it is handed on: the words of prefix and next word, and the count (of a task, below 2^32)."""
    return np.dtype([*[(f"w{i}", "<u8") for i in range(1, size + 1)], ("n", "<u4")])


def packed(words: list[np.ndarray], counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value per bucket, with its entries."""
    rec = np.empty(len(counts), layout(len(words)))
    for i, w in enumerate(words, 1):
        rec[f"w{i}"] = w
    rec["n"] = counts
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * rec.itemsize).astype(np.int32)), pa.py_buffer(rec)])


ENTRY = "size int, lang string, bucket long, entries binary, text array<string>"
ENTRY_NAMES = [c.split()[0] for c in ENTRY.split(", ")]
COUNTED = "size int, lang string, w1 long, w2 long, w3 long, w4 long, a long, bit long, text string"
COUNTED_NAMES = [c.split()[0] for c in COUNTED.split(", ")]


class Vocabulary:
    """A task's stripe of the empty prefix, by language, with the words' texts."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.parts = buckets, 0, {}

    def add(self, data, starts, stops, key, lang_of_word, names) -> Iterator[pa.RecordBatch]:
        for number in np.unique(lang_of_word).tolist():
            own = np.flatnonzero(lang_of_word == number)
            k, (at,), n = merged(key[own], [own], np.ones(len(own), np.int64))
            lengths = stops[at] - starts[at]
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths) + np.repeat(starts[at], lengths)
            text = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[flat]))
            self.parts.setdefault(names[number], []).append((k, n, text))
            self.held += len(at) + int(bounds[-1] >> 4)
        if self.held >= ENTRIES:
            yield from self.hand_on()

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.parts.items():
            key = np.concatenate([p[0] for p in parts])
            key, (at,), counts = merged(key, [np.arange(len(key))], np.concatenate([p[1] for p in parts]))
            where, bounds = bucket_starts(key, self.buckets)
            text = pa.chunked_array([p[2] for p in parts]).combine_chunks().take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(where), np.int32)), pa.array([lang] * len(where)), pa.array(where), packed([key], counts, bounds),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), text.cast(pa.string()))], names=ENTRY_NAMES)
        self.held, self.parts = 0, {}


def short_stripes(docs: DataFrame, buckets: int) -> DataFrame:
    """Slices of the stripes of no and of one word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Vocabulary(buckets), Stripes(2, buckets)
        for b in batches:
            for data, offs, tongues, number, names in slices(b):
                starts, stops, key, together = words_of(data, offs, tongues)
                if len(key):
                    yield from words.add(data, starts, stops, key, number[np.searchsorted(offs, starts, side="right") - 1], names)
                    i = np.flatnonzero(together)
                    yield from pairs.add([key[i], key[i + 1]])
        yield from words.hand_on()
        yield from pairs.hand_on()
    return docs.mapInArrow(run, ENTRY)


def long_stripes(docs: DataFrame, buckets: int, bits) -> DataFrame:
    """Slices of the stripes of two and three words, of phrases whose pairs all may be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits.value, np.uint8)
        threes, fours = Stripes(3, buckets), Stripes(4, buckets)
        for b in batches:
            for data, offs, tongues, _, _ in slices(b):
                _, _, key, together = words_of(data, offs, tongues)
                good = np.zeros(len(key) + 2, bool)
                i = np.flatnonzero(together)
                bit = phrase_key([key[i], key[i + 1]]) % np.uint64(BITS)
                good[i] = (known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                i = np.flatnonzero(good[:-2] & good[1:-1])
                yield from threes.add([key[i], key[i + 1], key[i + 2]])
                i = i[good[i + 2]]
                yield from fours.add([key[i + k] for k in range(4)])
        yield from threes.hand_on()
        yield from fours.hand_on()
    return docs.mapInArrow(run, ENTRY)


def merge_stripes(entries: DataFrame, least: int) -> DataFrame:
    """Elementwise sums of the stripes, of ``least`` on; size 0 rows hold a language's words in one bucket."""
    def run(t: pa.Table) -> pa.Table:
        size, lang = t.column("size")[0].as_py(), t.column("lang")[0].as_py()

        rec = np.frombuffer(b"".join(t.column("entries").to_pylist()), layout(size))
        words, counts = [rec[f"w{i}"].astype(np.uint64) for i in range(1, size + 1)], rec["n"].astype(np.int64)
        key, parts, total = merged(phrase_key(words), [*words, np.arange(len(counts))], counts)
        keep = np.flatnonzero(total >= least)
        m, none = len(keep), pa.nulls(len(keep), pa.int64())
        out = [pa.array(np.full(m, size, np.int32)), pa.array([lang] * m, pa.string()),
               *[pa.array(parts[i][keep].view(np.int64)) if i < size else none for i in range(WORDS)], pa.array(total[keep]),
               pa.array((key[keep] % np.uint64(BITS)).astype(np.int64)),
               t.column("text").combine_chunks().flatten().take(pa.array(parts[-1][keep])).cast(pa.string()) if size == 1 else pa.nulls(m, pa.string())]
        table = pa.Table.from_arrays(out, names=COUNTED_NAMES)
        if size > 1:
            return table
        whole = [pa.array([0], pa.int32()), pa.array([lang]), *[pa.nulls(1, pa.int64())] * WORDS, pa.array([int(counts.sum())]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string())]
        return pa.concat_tables([table, pa.Table.from_arrays(whole, names=COUNTED_NAMES)])
    return entries.groupBy("size", "bucket", "lang").applyInArrow(run, COUNTED)


def pair_bits(pairs: DataFrame) -> bytes:
    """The bit array over frequent pairs; its size does not depend on their number."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SEGMENT, np.uint8)
        bits[(pdf["bit"] % SEGMENT).to_numpy()] = 1
        return pd.DataFrame({"segment": [int(pdf["segment"].iloc[0])], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    rows = pairs.select(F.expr(f"bit div {SEGMENT}").alias("segment"), "bit").distinct().groupBy("segment").applyInPandas(pack, "segment long, bits binary")
    out = bytearray(BITS // 8)
    for r in rows.toLocalIterator():  # BITS / 8 bytes in all
        out[r.segment * SEGMENT // 8:(r.segment + 1) * SEGMENT // 8] = r.bits
    return bytes(out)


def count_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(size, lang, w1..w4, a, text): all words and phrases of ``least`` occurrences; size 0: a language's words."""
    spark = docs.sparkSession
    C.bound_batches(spark)
    source = docs.select(C.text_or_empty().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    n_bytes = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // BUCKET_BYTES)
    short = C.materialize(merge_stripes(short_stripes(source, buckets), least), "short-stripes")
    bits = spark.sparkContext.broadcast(pair_bits(short.where("size = 2")))
    long = C.materialize(merge_stripes(long_stripes(source, buckets, bits), least), "long-stripes")
    bits.unpersist()
    return short.unionByName(long).drop("bit")


def key_of(*words: str):
    return F.xxhash64(*words)


# the parts of a phrase that its texts and cuts ask for: (name, its words)
PARTS = {2: [("w1", 1, 1), ("w2", 2, 2)],
         3: [("w1", 1, 1), ("w2", 2, 2), ("w3", 3, 3), ("p1", 1, 2), ("p2", 2, 3)],
         4: [("w1", 1, 1), ("w2", 2, 2), ("w3", 3, 3), ("w4", 4, 4), ("p1", 1, 2), ("p3", 3, 4), ("t1", 1, 3), ("t2", 2, 4)]}
CUTS = {2: [("w1", "w2")], 3: [("w1", "p2"), ("p1", "w3")], 4: [("w1", "t2"), ("p1", "p3"), ("t1", "w4")]}


def by_size(make):
    out = None
    for size in PARTS:
        out = F.when(F.col("size") == size, make(size)) if out is None else out.when(F.col("size") == size, make(size))
    return out


def score_phrases(counted: DataFrame, subsumed: int = SUBSUMED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer candidate subsumes."""
    whole = by_size(lambda size: key_of(*[f"w{i}" for i in range(1, size + 1)]))
    phrases = counted.where("size >= 2").withColumn("id", whole)
    known = counted.where("size between 1 and 3").select(
        F.coalesce(whole, key_of("w1")).alias("key"), F.col("a").alias("f"), F.col("text"), F.col("lang").alias("tongue"))
    # the longest candidates around a phrase: one word more, before or behind, is enough, since counts only fall
    longer = phrases.where("size >= 3").select("a", F.explode(F.array(
        by_size(lambda size: key_of(*[f"w{i}" for i in range(1, size)])), by_size(lambda size: key_of(*[f"w{i}" for i in range(2, size + 1)])))).alias("id"))
    longest = longer.groupBy("id").agg(F.max("a").alias("around"))
    free = phrases.join(longest, "id", "left").where(F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(subsumed) * F.col("a")))
    parts = by_size(lambda size: F.array(*[F.struct(F.lit(name).alias("part"), key_of(*[f"w{i}" for i in range(lo, hi + 1)]).alias("key"))
                                           for name, lo, hi in PARTS[size]]))
    asked = free.select("id", "size", "a", F.explode(parts).alias("x")).select("id", "size", "a", "x.part", "x.key")
    names = sorted({name for parts_ in PARTS.values() for name, _, _ in parts_})
    told = asked.join(known, "key").groupBy("id", "size", "a").agg(
        F.max("tongue").alias("lang"), *[F.max(F.when(F.col("part") == x, F.col("f"))).alias(x) for x in names],
        *[F.max(F.when(F.col("part") == f"w{i}", F.col("text"))).alias(f"s{i}") for i in range(1, WORDS + 1)])
    # 2000000 * a may pass 64 bits
    cut = by_size(lambda size: F.array_min(F.array(*[
        F.struct(F.expr(f"(cast(a as decimal(20, 0)) * 2000000bd) div cast({x} + {y} as decimal(20, 0))").alias("score"),
                 F.lit(k + 1).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, (x, y) in enumerate(CUTS[size])])))
    return told.withColumn("cut", cut).select("lang", F.concat_ws(" ", *[f"s{i}" for i in range(1, WORDS + 1)]).alias("phrase"), "a",
                                              "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counted = count_phrases(docs, least)
    scored = C.materialize(score_phrases(counted, subsumed), "scored-phrases")
    totals = counted.where("size = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT))  # a part's first ``top`` hold all of the language's
    few = scored.withColumn("at", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("at") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
