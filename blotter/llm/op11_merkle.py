"""Merkle manifest of a dataset, with proofs by Octopus multiproofs.

Leaves. A row's leaf is the digest of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value. The rows of a source, ordered by doc_id
(then leaf), form its tree: runs of three neighbours become their digest until
one node remains, the subroot. The subroots, ordered by source (null first, then
bytewise), form the top tree in the same way.

Places. Rows are range-partitioned by (source, doc_id, leaf) and written in that
order; counts per partition and source, summed before each, give every row its
place. Trees are built from the bottom in aligned blocks of 3^7 nodes, each in one
group, seven levels a pass, whatever the size of a source.

Proofs. The ordered rows are cut into leaf partitions of a bounded number of
neighbours. For each, the smallest set of nodes that it lacks is worked out from
the places of its first and last leaf alone (in every level at most the rest of the
first and of the last run), all partitions' coordinates are fetched by one join,
and in the partition the inner nodes above its leaves are derived up to the root,
which must be the manifest's. Each leaf's proof is then read off these levels.

Defined cases: null texts, sources and ids are fields ``-``; a null source is a
source of its own, before all others; rows with a null doc_id come first in their
source and are not tampered with; repeated rows are leaves of their own, side by
side; an empty text is the field ``0:``; an empty table gives no rows; further
columns are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

ARITY = 3
BLOCK_LEVELS = 7           # levels built in one group
SMALL, BUNDLE = 200, 64    # trees of so few nodes share a group, so many at most
PART_ROWS = 4_000          # leaves of a leaf partition
TOP = -1                   # tree number of the subroots' tree
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@lru_cache(1 << 16)
def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


@lru_cache(1 << 16)
def width(n: int, level: int) -> int:
    """Nodes at a level of a tree of ``n`` leaves."""
    for _ in range(level):
        n = -(-n // ARITY)
    return n


def leaf_column(fields=FIELDS, **instead: Column) -> Column:
    """Digest of a row's fields; ``instead`` gives other values for some of them."""
    parts = []
    for name in fields:
        v = instead.get(name, F.col(name)).cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def placed(rows: DataFrame, group: str, order: list, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in the order (group, order) with ``mid``, their running number with gaps between partitions,
    and a table (group, pid, first, start, n): the first ``mid`` of a group in a partition, its place, the group's size.

    ``order`` must be total: equal keys must be interchangeable.
    """
    order = [F.col(group), *order]
    ranked = C.materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("mid", F.monotonically_increasing_id()), name)
    pid = F.shiftright("mid", 33).alias("pid")
    runs = ranked.groupBy(group, pid).agg(F.min("mid").alias("first"), F.count("*").alias("rows"))
    own = Window.partitionBy(group)  # a group's partitions, not its rows
    before = own.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(group, "pid", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(own).alias("n"))
    return ranked, C.materialize(runs, f"{name}-runs")


@dataclass
class Manifest:
    """leaves: part, tree, n, pos, doc_id, leaf, told; nodes: tree, level, idx, hash (all but the leaves)."""
    leaves: DataFrame
    nodes: DataFrame
    trees: int


def build_nodes(level0: DataFrame, n_most: int, name: str) -> list[DataFrame]:
    """Inner nodes of trees given as (tree, n, idx, hash); a written table for each seven levels."""
    def build(base: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["tree", "idx"])
            rows, out = list(zip(pdf["tree"].tolist(), pdf["n"].tolist(), pdf["idx"].tolist(), pdf["hash"].tolist())), []
            for level in range(base + 1, base + BLOCK_LEVELS + 1):
                runs: dict[tuple[int, int, int], list[str]] = {}
                for tree, n, idx, h in rows:
                    if width(n, level - 1) > 1:
                        runs.setdefault((tree, n, idx // ARITY), []).append(h)
                rows = [(*k, digest(v)) for k, v in runs.items()]
                out += [(tree, n, level, idx, h, width(n, level) == 1) for tree, n, idx, h in rows]
            return pd.DataFrame(out, columns=["tree", "n", "level", "idx", "hash", "last"])
        return run

    out, now, per = [], level0, ARITY ** BLOCK_LEVELS
    for base in range(0, height(n_most), BLOCK_LEVELS):
        small = F.col("n") <= SMALL * ARITY ** base  # the whole tree is a small part of a block
        cells = now.groupBy(F.when(small, F.lit(-2)).otherwise(F.col("tree")).alias("big"),
                            F.when(small, F.expr(f"tree div {BUNDLE}")).otherwise(F.expr(f"idx div {per}")).alias("cell"))
        out.append(C.materialize(cells.applyInPandas(build(base), "tree long, n long, level int, idx long, hash string, last boolean"), f"{name}-nodes"))
        now = out[-1].where(F.col("level") == base + BLOCK_LEVELS).select("tree", "n", "idx", "hash")
    return out


def subroots(leaves: DataFrame, nodes: list[DataFrame]) -> DataFrame:
    """(tree, hash): the one node that ends each tree."""
    alone = leaves.where("n = 1").select("tree", F.col("leaf").alias("hash"))
    for t in nodes:
        alone = alone.unionByName(t.where("last").select("tree", "hash"))
    return alone


def build_manifest(docs: DataFrame, fields=FIELDS, order: str = "doc_id", group: str = "source", told: Column | None = None) -> Manifest:
    """Trees over all rows; ``told`` is a row's leaf as a reader finds it (null: as it was)."""
    C.bound_batches(docs.sparkSession)
    key = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))  # '-' sorts first
    rows = docs.select(key.alias("skey"), F.col(order).cast("long").alias("doc_id"), leaf_column(fields).alias("leaf"),
                       (F.lit(None).cast("string") if told is None else told).alias("told"))
    rows = C.materialize(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-rows")
    ranked, runs = placed(rows, "skey", ["doc_id", "leaf", "tie"], "merkle-leaves")
    one = F.lit(0).alias("one")
    sources = runs.groupBy("skey").agg(F.max("n").alias("n")).select(one, "skey", "n")
    order_, parts = placed(sources, "one", ["skey"], "merkle-sources")
    numbers = order_.withColumn("pid", F.shiftright("mid", 33)).join(parts.select("pid", "first", "start"), "pid").select(
        "skey", (F.col("start") + F.col("mid") - F.col("first")).alias("tree"))
    totals = sources.agg(F.count("*"), F.max("n")).first()
    trees, n_most = int(totals[0]), int(totals[1] or 0)
    known = C.materialize(runs.join(numbers, "skey").select("skey", "pid", "first", "start", "n", "tree"), "merkle-places")
    leaves = ranked.withColumn("pid", F.shiftright("mid", 33)).join(known, ["skey", "pid"]).select(
        F.expr(f"mid div {PART_ROWS}").alias("part"), "tree", "n", (F.col("start") + F.col("mid") - F.col("first")).alias("pos"),
        "doc_id", "leaf", "told")
    leaves = C.materialize(leaves, "merkle-placed")
    inner = build_nodes(leaves.select("tree", "n", F.col("pos").alias("idx"), F.col("leaf").alias("hash")), n_most, "merkle")
    tops = C.materialize(subroots(leaves, inner).select(F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"),
                                                        F.col("tree").alias("idx"), "hash"), "merkle-subroots")
    above = build_nodes(tops, trees, "merkle-top")
    nodes = tops.select("tree", F.lit(0).alias("level"), "idx", "hash")
    for t in [*inner, *above]:
        nodes = nodes.unionByName(t.select("tree", "level", "idx", "hash"))
    return Manifest(leaves, nodes, trees)


def lacking(n: int, lo: int, hi: int) -> list[tuple[int, int]]:
    """(level, idx) of the nodes needed beside the leaves lo..hi to prove all of these; no more than these."""
    out = []
    for level in range(height(n)):
        first, last = lo // ARITY * ARITY, min(hi // ARITY * ARITY + ARITY, width(n, level)) - 1
        out += [(level, i) for i in [*range(first, lo), *range(hi + 1, last + 1)]]
        lo, hi = lo // ARITY, hi // ARITY
    return out


def fetched(m: Manifest) -> DataFrame:
    """(part, tree, level, idx, hash): for every leaf partition the nodes that it lacks, and the root."""
    own = m.leaves.groupBy("part", "tree", "n").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    top = m.leaves.groupBy("part").agg(F.min("tree").alias("lo"), F.max("tree").alias("hi"))
    spans = own.unionByName(top.select("part", F.lit(TOP).cast("long").alias("tree"), F.lit(m.trees).cast("long").alias("n"), "lo", "hi"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                rows += [(r.part, r.tree, level, idx) for level, idx in lacking(r.n, r.lo, r.hi)]
                if r.tree == TOP:
                    rows.append((r.part, TOP, height(r.n), 0))
            yield pd.DataFrame(rows, columns=["part", "tree", "level", "idx"]).astype("int64")

    need = C.materialize(spans.mapInPandas(run, "part long, tree long, level int, idx long"), "merkle-need")
    leaves = m.leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
    return C.materialize(need.join(leaves.unionByName(m.nodes), ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "hash"), "merkle-fetched")


def derive(tree: int, n: int, lo: int, hashes: list[str], got: dict) -> tuple[list[tuple[int, list[str]]], str]:
    """Levels (first place, nodes) from the leaves lo.. up, and the last node."""
    levels = []
    for level in range(height(n)):
        hi = lo + len(hashes) - 1
        first, last = lo // ARITY * ARITY, min(hi // ARITY * ARITY + ARITY, width(n, level)) - 1
        hashes = [got[tree, level, i] for i in range(first, lo)] + hashes + [got[tree, level, i] for i in range(hi + 1, last + 1)]
        levels.append((first, hashes))
        hashes, lo = [digest(hashes[i:i + ARITY]) for i in range(0, len(hashes), ARITY)], first // ARITY
    return levels, hashes[0]


def beside(levels: list[tuple[int, list[str]]], at: int) -> list[tuple[str, str]]:
    """The siblings left and right of a leaf's path, level by level."""
    out = []
    for first, hashes in levels:
        i = at - first
        run = i // ARITY * ARITY
        out.append(("".join(hashes[run:i]), "".join(hashes[i + 1:run + ARITY])))
        at //= ARITY
    return out


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(m: Manifest, siblings: bool = False) -> DataFrame:
    """One row per leaf (columns ``PROOFS``); ``siblings`` adds the proof itself, an array of digests."""
    trees = m.trees
    columns = [c.split()[0] for c in PROOFS.split(", ")] + ["siblings"] * siblings

    def expand(own: pd.DataFrame, brought: pd.DataFrame) -> pd.DataFrame:
        got = {(t, level, i): h for t, level, i, h in zip(brought["tree"].tolist(), brought["level"].tolist(), brought["idx"].tolist(), brought["hash"].tolist())}
        own = own.sort_values(["tree", "pos"])
        done, tops = [], []
        for (tree, n), rows in own.groupby(["tree", "n"], sort=True):
            levels, sub = derive(int(tree), int(n), int(rows["pos"].iloc[0]), rows["leaf"].tolist(), got)
            done.append((int(tree), rows, levels, sub))
            tops.append(sub)
        above, root = derive(TOP, trees, done[0][0], tops, got)
        if root != got[TOP, height(trees), 0]:
            raise ValueError("the leaves of a partition do not lead to the manifest's root")
        out = []
        for tree, rows, levels, sub in done:
            upper = beside(above, tree)
            ids = [None if pd.isna(x) else int(x) for x in rows["doc_id"].array]
            for doc_id, pos, leaf, told in zip(ids, rows["pos"].tolist(), rows["leaf"].tolist(), rows["told"].array):
                path = beside(levels, pos) + upper
                folded = leaf if told is None or told != told else told
                for left, right in path:
                    folded = digest((left, folded, right))
                proof = "".join(a + b for a, b in path)
                row = (doc_id, leaf, sub, root, digest((proof,)), folded, folded == root)
                out.append((*row, [proof[i:i + 64] for i in range(0, len(proof), 64)]) if siblings else row)
        frame = pd.DataFrame(out, columns=columns)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    brought = fetched(m)
    rows = m.leaves.select("part", "tree", "n", "pos", "doc_id", "leaf", "told")
    return rows.groupBy("part").cogroup(brought.groupBy("part")).applyInPandas(expand, PROOFS + ", siblings array<string>" * siblings)


def verify_tampered(docs: DataFrame) -> DataFrame:
    """Every row's proof, held against its text without line feeds where 2 divides the CRC-32 of its decimal doc_id."""
    even = (F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2) == 0
    told = F.when(even, leaf_column(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    return proofs(build_manifest(docs, told=told))
