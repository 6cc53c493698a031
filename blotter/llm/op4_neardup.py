"""MinHash near-duplicates with SuperMinHash signatures.

Signatures. Each shingle draws a random permutation of the signature's slots
and a random fraction; its value in the slot at place j of its permutation is
j + fraction. A slot keeps its least value. All shingles of a batch advance
place by place together: after place j no later place can lower a slot that is
already filled, so a document stops as soon as its slots are filled.

Candidates. Equal sets are one class, found by a 128-bit sum over the set, so
copies never meet as pairs. Class representatives meet in band buckets. In a
bucket every member is compared with a hub (another hub in each band); where a
bucket still spans several components, its pairs across components are checked
on full sets in blocks bounded in members and in shingles, by counting shared shingles in a matrix
product. Nothing is capped and no pairs are emitted: only links that hold are.

Verification is on the full shingle sets. Components: union-find inside a block
task, then min-label propagation with pointer jumping over the links in Spark,
each round written to the shared folder.

Defined cases: null, empty and white-space texts have the empty set and are
linked with nothing; texts with fewer words than a shingle have one shingle;
repeated rows and equal texts form one class; the least doc_id of a component
names it (null only if all are null, each null row then kept); an empty table
gives no rows; further columns are ignored (``keep_one`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BANDS, ROWS = 24, 4
SHINGLE_WORDS = 5
ROUND_ELEMENTS = 400_000   # shingles whose permutations are held at once
BLOCK, BLOCK_SHINGLES = 600, 2_000_000   # members of a block, and shingles of all its sets (means); a task compares two blocks


def superminhash(sets: np.ndarray, offs: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (documents x slots) of ragged sets of 64-bit hashes; an empty set gives all ones."""
    n = len(offs) - 1
    out = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.diff(offs)
    at = 0
    while at < n:  # documents whose shingles fit one round, at least one document
        upto = max(at + 1, int(np.searchsorted(offs, offs[at] + ROUND_ELEMENTS, side="right")) - 1)
        own = np.repeat(np.arange(upto - at), sizes[at:upto])
        _rounds(sets[offs[at]:offs[upto]], own, out[at:upto], slots)
        at = upto
    return out


def _rounds(elements: np.ndarray, own: np.ndarray, sig: np.ndarray, slots: int) -> None:
    """Fill ``sig`` place by place; value = place in the high byte, fraction below."""
    empty = np.iinfo(np.uint64).max
    state, perm = elements, None
    ident = np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16)
    for place in range(slots):
        if not len(own):
            return
        state = C.mix64(state)
        pick = place + ((state >> np.uint64(33)) % np.uint64(slots - place)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            row = np.arange(len(own))
            slot = perm[row, pick].astype(np.int64)
            perm[row, pick] = perm[:, place]
            perm[:, place] = slot
        value = (np.uint64(place) << np.uint64(54)) | (C.mix64(state) >> np.uint64(10))
        flat = sig.reshape(-1)
        cell = own * slots + slot
        order = np.lexsort((value, cell))
        cell, value = cell[order], value[order]
        first = np.concatenate([[True], cell[1:] != cell[:-1]])
        cell, value = cell[first], value[first]
        flat[cell] = np.minimum(flat[cell], value)
        # a filled document stops: later places only bring greater values
        live = (sig == empty).any(axis=1)[own]
        if perm is None and live.any():
            perm = np.repeat(ident[None, :], int(live.sum()), axis=0)
            row = np.arange(len(perm))
            p0 = pick[live]
            perm[row, p0] = 0
            perm[:, 0] = p0
        elif perm is not None and not live.all():
            perm = perm[live]
        own, state = own[live], state[live]


def sets_of(batch: pa.RecordBatch, column: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, offs = C.text_buffers(batch.column(column))
    words, woffs = C.word_hashes(data, offs)
    return C.shingle_hashes(words, woffs, size)


def classes(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: doc_id, n_shingles, f1, f2 (128-bit set sum) and band keys, one pass over the text."""
    schema = "doc_id long, th long, n_shingles long, f1 long, f2 long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets, offs = sets_of(b, "text", size)
            n = len(offs) - 1
            sums = []
            for salt in (1, 2):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mix64(sets ^ C.mix64(np.full(1, salt, np.uint64))))])
                sums.append(total[offs[1:]] - total[offs[:-1]])
            sig = superminhash(sets, offs, bands * rows)
            keys = np.zeros((n, bands), np.uint64)
            for band in range(bands):
                acc = np.full(n, band + 1, np.uint64)
                for r in range(rows):
                    acc = C.mix64(acc ^ sig[:, band * rows + r])
                keys[:, band] = acc
            some = np.diff(offs) > 0
            bounds = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(np.diff(offs)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                 C.ragged(keys[some].reshape(-1), bounds, pa.int64())],
                names=["doc_id", "th", "n_shingles", "f1", "f2", "bands"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(key columns..., set array<long> sorted) of documents given as (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets, offs = sets_of(b, "text", size)
            yield pa.RecordBatch.from_arrays([b.column("id"), C.ragged(sets, offs, pa.int64())], names=["id", "set"])
    return docs.select("id", "text").mapInArrow(run, "id long, set array<long>")


def link_holds(inter, a, b, percent: int):
    return F.lit(100) * inter >= F.lit(percent) * (a + b - inter)


def components(links: DataFrame, name: str = "cc") -> DataFrame:
    """(id, root): least id reachable, for the ids of ``links`` (a, b). Every round is written out."""
    edges = C.materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    label = C.materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).select(F.col("a").alias("id"), "root"), name)
    while True:
        # least label among the neighbours, then the label of the label
        near = (edges.join(label, F.col("b") == F.col("id")).groupBy("a").agg(F.min("root").alias("near")))
        hop = label.join(near, F.col("id") == F.col("a")).select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = label.select(F.col("id").alias("r"), F.col("root").alias("up"))
        new = C.materialize(hop.join(up, F.col("root") == F.col("r"), "left")
                            .select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root")), name)
        if new.where("root <> old").isEmpty():
            return new.select("id", "root")
        label = new.select("id", "root")


def hub_links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between bucket members and their bucket's hub, on full sets, where the sets' sizes allow one."""
    hubs = buckets.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key").alias("h"), F.col("id").alias("id"), "size")).alias("hub"))
    hubs = C.materialize(hubs.select("key", F.col("hub.id").alias("b"), F.col("hub.size").alias("hub_size")), "hubs")
    alike = link_holds(F.least("size", "hub_size"), F.col("size"), F.col("hub_size"), percent)  # the smaller set inside the larger
    pairs = (buckets.join(hubs, "key").where("id <> b").where(alike)
             .select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct())
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(link_holds(F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"), percent)).select("a", "b")


def block_tasks(open_: DataFrame) -> DataFrame:
    """Block pairs (key, lo, hi) with their members for buckets (key, id, root, size) that span components.

    The members of a bucket's largest component form one run of blocks, all
    others another. Pairs inside the largest component need no comparison, so
    its blocks meet only the blocks of the others; those meet every block.
    """
    by_root = open_.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("w"), F.bit_xor(F.xxhash64("id")).alias("x"))
    spread = by_root.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("n_major"), F.sum("n").alias("n"),
        F.max_by("w", F.struct("n", "root")).alias("w_major"), F.sum("w").alias("w"),
        F.bit_xor("x").alias("x"), F.count("*").alias("roots")).where("roots > 1 and n > 2")
    one = spread.groupBy("n", "x", "major", "w").agg(F.min(F.struct("key", "n_major", "w_major")).alias("s"))  # equal member lists once
    rest, heavy = F.col("n") - F.col("s.n_major"), F.col("w") - F.col("s.w_major")
    one = one.select("s.key", "major", F.greatest(F.ceil(F.col("s.n_major") / BLOCK), F.ceil(F.col("s.w_major") / BLOCK_SHINGLES)).alias("mb"),
                     F.greatest(F.ceil(rest / BLOCK), F.ceil(heavy / BLOCK_SHINGLES)).alias("ob"))
    rows = open_.join(one, "key")
    major = F.col("root") == F.col("major")
    salt = F.xxhash64("id")
    rows = rows.withColumn("own", F.when(major, F.pmod(salt, F.col("mb"))).otherwise(F.col("mb") + F.pmod(salt, F.col("ob"))))
    others = F.when(major, F.sequence(F.col("mb"), F.col("mb") + F.col("ob") - 1)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("mb") + F.col("ob") - 1))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select("key", "id", "root", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def block_links(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join the components of each block pair, on full sets (a spanning set of them)."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, roots, own = pdf["id"].to_numpy(), pdf["root"].to_numpy(), pdf["own"].to_numpy()
        arrays = [np.asarray(s, np.int64) for s in pdf["set"]]
        sizes = np.array([len(s) for s in arrays])
        _, col = np.unique(np.concatenate(arrays), return_inverse=True)
        doc = np.repeat(np.arange(len(ids)), sizes)
        shared = np.bincount(col) > 1
        keep = shared[col]
        col, doc = np.cumsum(shared)[col[keep]] - 1, doc[keep]
        order = np.argsort(col, kind="stable")
        col, doc = col[order], doc[order]
        width = int(col[-1]) + 1 if len(col) else 0
        inter = np.zeros((len(ids), len(ids)))
        for lo in range(0, width, 4096):  # dense slices of the document x shingle table
            s, e = np.searchsorted(col, [lo, lo + 4096])
            m = np.zeros((len(ids), min(4096, width - lo)), np.float32)
            m[doc[s:e], col[s:e] - lo] = 1
            inter += m @ m.T
        hit = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
        hit &= roots[:, None] != roots[None, :]
        if pdf["lo"].iloc[0] != pdf["hi"].iloc[0]:
            hit &= own[:, None] != own[None, :]
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for i, j in np.argwhere(np.triu(hit, 1)).tolist():
            ra, rb = find(int(roots[i])), find(int(roots[j]))
            if ra != rb:
                parent[ra] = rb
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return tasks.join(sets, "id").groupBy("key", "lo", "hi").applyInPandas(compare, "a long, b long").distinct()


def find_links(reps: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) that connect all components among class representatives (id, doc, th, bands)."""
    long = reps.select("id", F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    # written first, so that the join has exchanges of its own, whose skewed partitions Spark can split
    full = C.materialize(long.groupBy("key").count().where("count > 1").select("key"), "full-buckets")
    buckets = C.materialize(long.join(full, "key"), "buckets")
    wanted = C.materialize(reps.select("id", "doc", "th").join(buckets.select("id").distinct(), "id", "left_semi"), "wanted")
    texts = docs.select(F.col("doc_id").alias("d"), "text", F.xxhash64("text").alias("h"))
    picked = texts.join(C.small_side(wanted), F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
    # repeated rows give the same set twice: the later distinct keeps one
    sets = C.materialize(full_sets(picked.select("id", "text"), size).dropDuplicates(["id"]), "sets")
    first = C.materialize(hub_links(buckets, sets, percent), "hub-links")
    label = components(first, "hub-cc")
    open_ = buckets.join(label, "id", "left").select("key", "id", "size", F.coalesce("root", "id").alias("root"))
    tasks = C.materialize(block_tasks(open_), "block-tasks")
    return C.materialize(first.union(block_links(tasks, sets, percent)), "links")


def resolve(docs: DataFrame, percent: int, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id, keep_key: the (null?, doc_id, th) that stays."""
    C.bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = C.materialize(classes(source, bands, rows, size), "classes")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("th").alias("th"))
    reps = marked.where("n_shingles > 0").groupBy("f1", "f2", "n_shingles").agg(
        F.min(key).alias("rep"), F.first("bands").alias("bands"))
    # the ids are fixed by writing them
    reps = C.materialize(reps.select(F.monotonically_increasing_id().alias("id"), "f1", "f2", "n_shingles",
                                     F.col("rep.none"), F.col("rep.doc"), F.col("rep.th"), "bands"), "reps")
    roots = components(find_links(reps, source, percent, size))
    named = reps.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min(F.struct("none", "doc", "th")).alias("keep"))
    by_class = named.join(least, "root").select("f1", "f2", "n_shingles", "keep")
    out = marked.drop("bands").join(by_class, ["f1", "f2", "n_shingles"], "left")
    return out.select("doc_id", "th", "n_shingles", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc")).alias("component_id"),
                      F.coalesce("keep", key).alias("keep_key"))


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document; see the module docstring."""
    return resolve(docs, percent, size, bands, rows).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, size: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One document of each component, with all its columns; of repeated rows one stays.

    Documents without words have no near duplicates and all stay.
    """
    found = C.materialize(resolve(docs, percent, size, bands, rows), "components")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("th").alias("th"))
    gone = found.where(F.col("n_shingles") > 0).where(key != F.col("keep_key")).select(F.col("doc_id").alias("__d"), F.col("th").alias("__h")).distinct()
    twice = (found.where("n_shingles > 0").where(key == F.col("keep_key")).groupBy("doc_id", "th").count().where("count > 1")
             .select(F.col("doc_id").alias("__d"), F.col("th").alias("__h")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(docs["text"]) == F.col("__h"))
    gone, twice = C.materialize(gone, "gone"), C.materialize(twice, "twice")
    stay = docs.join(C.small_side(gone), same, "left_anti")
    if twice.isEmpty():
        return stay
    return stay.join(C.small_side(twice), same, "left_anti").unionByName(
        stay.join(C.small_side(twice), same, "left_semi").dropDuplicates(["doc_id", "text"]))
