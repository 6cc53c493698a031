"""Best-fit-decreasing packing of token sequences.

Best-fit decreasing looks only at lengths, and all bins with the same free
room are interchangeable. So the packing of the whole corpus is planned on the
histogram of piece lengths (at most ``capacity`` entries, whatever the corpus)
and comes out as a short list of *runs*: "items first..first+n of length L go,
m per bin, into bins b, b+1, ... at this offset". The tightest open room for
each length is found in a segment tree over remaining capacities, in
logarithmic time. Pieces then find their run by their rank within their
length, a join of small rows; no document, and no bin, passes the driver.

Steps on Spark: encode and cut (one pass, written to the shared folder with a
rank per partition and length), count per (length, partition), prefix sums,
plan, join. Executors may be lost at any point: each step reads written files.

Defined cases: null or empty text packs as its end token alone; equal lengths
(ties) are told apart by rank; repeated rows are separate documents; an empty
table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .tokens import encoder, tokenizer_path

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, k long"


class CapacityTree:
    """Segment tree over capacities 0..size: which hold open bins, and the least one >= x."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)

    def set(self, capacity: int, on: bool) -> None:
        i = capacity + self.leaves
        self.open[i] = int(on)
        i //= 2
        while i:
            self.open[i] = self.open[2 * i] | self.open[2 * i + 1]
            i //= 2

    def tightest(self, need: int) -> int | None:
        """Least open capacity >= need, or None."""
        i = need + self.leaves
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def plan_runs(histogram: dict[int, int], capacity: int) -> list[tuple]:
    """Best-fit decreasing over ``{length: count}``.

    Returns runs ``(length, first, last, per_bin, bin, offset)``: the item of
    rank r in first <= r < last goes to bin ``bin + (r - first) // per_bin`` at
    ``offset + (r - first) % per_bin * length``. Identical to placing the items
    one by one, longest first, each into the tightest open bin that takes it.
    """
    tree, rooms, runs, bins = CapacityTree(capacity), defaultdict(list), [], 0

    def give_back(room: int, first_bin: int, n: int) -> None:
        if room > 0 and n > 0:
            rooms[room].append((first_bin, n))
            tree.set(room, True)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                n = -(-left // (capacity // length))
                first_bin, bins = bins, bins + n
            else:
                first_bin, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            per, offset = room // length, capacity - room
            full = min(n, left // per)
            if full:
                runs.append((length, rank, rank + full * per, per, first_bin, offset))
                rank, left = rank + full * per, left - full * per
                give_back(room - per * length, first_bin, full)
            if left and full < n:  # left < per here: one more bin takes the rest
                runs.append((length, rank, rank + left, per, first_bin + full, offset))
                give_back(room - left * length, first_bin + full, 1)
                rank, left, full = rank + left, 0, full + 1
            give_back(room, first_bin + full, n - full)
    return runs


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of every document with a crc of their ids and a rank per (length, partition)."""
    path = tokenizer_path(tokenizer)
    tail = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, seen, part = encoder(path), defaultdict(int), TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].array, b["text"].array):
                ids = enc.encode(text) + tail
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at - 1) % capacity + 1 if at == 0 else capacity
                    rows.append((doc_id, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), part, seen[size]))
                    seen[size] += 1
                    at, piece = at + size, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "k"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInPandas(pieces, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length``, ``part`` and ``k``.

    ``k`` numbers the rows of one (length, part) from 0. The input must be
    re-readable (a written table), since it is counted before it is joined.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg((F.max("k") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most ``capacity`` rows reach the driver, whatever the corpus
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan_runs(histogram, capacity),
                                 "length long, first long, last long, per long, bin long, at long")
    ranked = pieces.join(base, ["length", "part"]).withColumn("r", F.col("base") + F.col("k"))
    # the plan's size depends on ``capacity`` alone (some thousands of rows), so it is broadcast
    placed = ranked.join(F.broadcast(runs), "length").where("r >= first and r < last")
    step = F.col("r") - F.col("first")
    return placed.select(
        *[c for c in pieces.columns if c not in ("part", "k")],
        (F.col("bin") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + step % F.col("per") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
                   capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents; see the module docstring for the cases."""
    C.bound_batches(docs.sparkSession)
    return pack(C.materialize(cut(docs, tokenizer, end_id, capacity), "pieces"), capacity)
