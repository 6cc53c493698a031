"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints. Every three-word shingle of a text, repeats included, is hashed by
XXH64 (seed 42); a bit of the fingerprint is one if more than half the hashes have
it. Texts of equal fingerprint are one class, so copies never meet as pairs.

Candidates. Fingerprints that differ in at most three bits are cut into two
segments of 32: one of these differs in at most one bit. So each segment is indexed
as it is and with one bit left out, 33 variants, and equal variants meet. In a
variant with a bit left out only fingerprints that differ in that bit are news;
buckets without both are dropped before any row moves.

Hot buckets. A bucket over ``BLOCK`` members is cut again by the same rule in the
other segment: as at most three bits differ there, one of its two quarters differs
in at most one. The parts then share 46 bits at least and have at most 2^18
members, whatever the data. Parts over ``BLOCK`` are compared in pairs of blocks.

In a block task links are found by search from member to member, on all 64 bits,
and only those that join it are handed on, not all pairs. Components: min-label
propagation over these links, each round written.

Defined cases: null, empty and white-space texts have the fingerprint zero and are
linked like any other; one or two words are one shingle; repeated rows are one
class; a null doc_id takes part but names a component only if all its ids are null
(then the name is null); an empty table gives no rows; a very long text is hashed
in stretches; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .op4_neardup import components

SHINGLE_WORDS, SEED, BITS_APART = 3, 42, 3
STRETCH = 200_000          # hashes of a text that are held at once
BLOCK = 4_096              # members of a bucket that are compared in one task
BUNDLE_ROWS = 20_000       # members that share a group, about

_BIT_SUMS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = np.arange(8) * 256


def shingle_hashes(low: bytes, size: int = SHINGLE_WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a lowered text, space-joined, in stretches."""
    words = low.split()  # bytes split at \x20\x09-\x0D
    if not words:
        return
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash_ = xxhash.xxh64_intdigest
    for at in range(0, len(starts), STRETCH):
        spans = zip(starts[at:at + STRETCH].tolist(), ends[at:at + STRETCH].tolist())
        yield np.array([hash_(text[a:b], seed) for a, b in spans], np.uint64)


def fingerprint(low: bytes, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a lowered text."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(low, size):
        lanes = h.astype(">u8").view(np.uint8).reshape(-1, 8) + _LANES  # counts of byte values, then of their bits
        ones += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BIT_SUMS).ravel()
        n += len(h)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = C.text_buffers(b.column("text"))
            low = memoryview(C._LOWER[data])
            fps = np.array([fingerprint(bytes(low[a:e]), size) for a, e in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def variants(rows: DataFrame, value: str, width: int, parts: int, key: str, side: str) -> DataFrame:
    """Each row once for every variant of the ``parts`` segments of ``width`` bits in ``value``.

    ``key``: segment, bit left out (``width``: none) and the remaining bits;
    ``side``: the bit left out, null where none is.
    """
    out = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts * (width + 1) - 1))).alias("__slot"))
    out = out.withColumn("__bit", F.expr(f"__slot % {width + 1}")).withColumn(
        "__seg", F.expr(f"shiftrightunsigned({value}, (__slot div {width + 1}) * {width}) & {(1 << width) - 1}L"))
    one = f"shiftleft(1L, cast(__bit as int))"
    return out.select(
        "*", F.expr(f"shiftleft(cast(__slot as bigint), {width}) | if(__bit = {width}, __seg, __seg & ~{one})").alias(key),
        F.expr(f"if(__bit = {width}, null, cast(shiftrightunsigned(__seg, cast(__bit as int)) & 1L as int))").alias(side),
    ).drop("__slot", "__bit", "__seg")


def met(rows: DataFrame, keys: list[str], sides: list[str], name: str) -> DataFrame:
    """Rows of buckets in which members meet for the first time, with the bucket's size ``n``."""
    aggs = [F.count("*").alias("n")] + [x for s in sides for x in (F.min(s).alias(f"{s}_lo"), F.max(s).alias(f"{s}_hi"))]
    full = rows.groupBy(*keys).agg(*aggs).where("n > 1")
    for s in sides:
        full = full.where(F.col(f"{s}_lo").isNull() | (F.col(f"{s}_lo") < F.col(f"{s}_hi")))
    # written first, so that the join has exchanges of its own, whose skewed partitions Spark can split; rows are a few longs wide
    return rows.join(C.small_side(C.materialize(full.select(*keys, "n"), name)), keys)


def block_links(members: DataFrame, apart: int) -> DataFrame:
    """Links (a, b) that join the members (key, sub, fp, n) of each bucket as far as they are near."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    rows = members.withColumn("own", F.pmod(F.xxhash64("fp"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = C.materialize(rows.select("key", "sub", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"), "simhash-blocks")
    bundles = max(1, rows.count() // BUNDLE_ROWS)
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("key", "sub", "lo", "hi"), F.lit(bundles)))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "sub", "lo", "hi"])
        where, fps = pdf[["key", "sub", "lo", "hi"]].to_numpy(), pdf["fp"].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        out = []
        for left in np.split(fps, cuts):
            while len(left) > 1:  # from one member on to all that it reaches
                todo, left = [left[0]], left[1:]
                while todo and len(left):
                    at = todo.pop()
                    near = np.bitwise_count((left ^ at).view(np.uint64)) <= apart
                    if near.any():
                        new = left[near].tolist()
                        out += [(min(at, x), max(at, x)) for x in new]
                        todo, left = todo + new, left[~near]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bundle").applyInPandas(search, "a long, b long").distinct()


def find_links(fps: DataFrame) -> DataFrame:
    """Links among distinct fingerprints (fp) that connect all that are at most three bits apart."""
    first = C.materialize(met(variants(fps.select("fp"), "fp", 32, 2, "key", "side"), ["key"], ["side"], "simhash-buckets"), "simhash-members")
    small = first.where(F.col("n") <= BLOCK).select("key", F.lit(-1).cast("long").alias("sub"), "fp", "n")
    hot = first.where(F.col("n") > BLOCK).drop("n").withColumn(
        "rest", F.expr("if(shiftrightunsigned(key, 32) < 33, shiftrightunsigned(fp, 32), fp & 4294967295L)"))  # the segment not in the key
    cut = met(variants(hot, "rest", 16, 2, "sub", "side2"), ["key", "sub"], ["side", "side2"], "simhash-parts")
    return C.materialize(block_links(small.unionByName(cut.select("key", "sub", "fp", "n")), BITS_APART), "simhash-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every document; see the module docstring."""
    C.bound_batches(docs.sparkSession)
    marked = C.materialize(fingerprints(docs), "simhash-fingerprints")
    fps = C.materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(find_links(fps), "simhash-cc")
    named = fps.join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = C.materialize(named.join(least, "root").select("fp", "component_id"), "simhash-named")
    return marked.join(by_class, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
