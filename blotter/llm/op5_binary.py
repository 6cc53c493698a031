"""Token-id files with a minimal perfect hash index.

Payload: shards of raw little-endian ids in ascending order of doc_id (null
first), one sequential file each, closed by the id counts of its documents.
Index: for every (doc_id, run) -- a run is the stretch of a doc_id's rows inside
one shard -- a slot with a fingerprint, the shard, and the place in it. Keys
are spread over bucket files by hash; in a bucket a minimal perfect hash (levels
of bit arrays, ranked by population counts) gives the slot in constant time.

All files lie in the shared folder; a task writes under a name of its own and
returns that name in a committed table, so a task that is run again or lost
leaves at most an unreferenced file. Nothing but per-shard sums is brought
together, and those by a window over one row per shard.

Defined cases: null and empty texts hold the end id alone; repeated doc_ids are
kept each, in an order fixed by a hash of their text; a null doc_id is a key
like any other; an empty table writes no shard; further columns are ignored.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .tokens import encoder, tokenizer_path

SHARD_IDS = 32 << 20      # ids a shard takes before the next one begins
BUCKET_KEYS = 1 << 20     # mean number of keys in an index file
LOCATORS = "part long, file string, ord long, doc_id long, offset long, n long"


class PerfectHash:
    """Minimal perfect hash over distinct uint64 keys (levels of bit arrays)."""

    GAMMA, LEVELS = 2, 40

    @classmethod
    def build(cls, keys: np.ndarray) -> dict[str, np.ndarray]:
        sizes, words, left = [], [], keys
        while len(left) and len(sizes) < cls.LEVELS:
            m = -(-cls.GAMMA * len(left) // 64) * 64
            at = cls._place(left, len(sizes), m)
            once = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            words.append(np.packbits(once, bitorder="little").view(np.uint64))
            left = left[~once[at]]
        bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])
        return {"sizes": np.array(sizes, np.int64), "bits": bits, "ranks": ranks, "rest": np.sort(left)}

    @staticmethod
    def _place(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        return (C.mix64(keys ^ C.mix64(np.full(1, level + 1, np.uint64))) % np.uint64(m)).astype(np.int64)

    @classmethod
    def slots(cls, f: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
        """Slot of each key, in constant time; -1 where no level holds it."""
        out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(f["sizes"].tolist()):
            at = cls._place(keys[todo], level, m) + base
            word, bit = f["bits"][at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[todo[hit]] = f["ranks"][at[hit] >> 6] + below
            todo, base = todo[~hit], base + m
            if not len(todo):
                return out
        if len(f["rest"]):
            at = np.minimum(np.searchsorted(f["rest"], keys[todo]), len(f["rest"]) - 1)
            out[todo] = np.where(f["rest"][at] == keys[todo], f["ranks"][-1] + at, -1)
        return out


def key_hash(doc_ids: pd.Series, runs: np.ndarray) -> np.ndarray:
    """uint64 per (doc_id, run); without repeats among first runs, since the mixer is a bijection."""
    null = doc_ids.isna().to_numpy()
    ids = doc_ids.fillna(0).to_numpy(dtype=np.int64).view(np.uint64)
    return C.mix64(ids ^ C.mix64(runs.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)) ^ C.mix64(np.zeros(1, np.uint64)))


def write_payload(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the shards; returns the locator of every document (part, file, ord, doc_id, offset, n)."""
    path = tokenizer_path(tokenizer)
    tail = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = C.open_fs(folder)
        fs.create_dir(f"{root}/payload", recursive=True)
        enc, task = encoder(path), TaskContext.get().partitionId()
        wide = enc.tok.get_vocab_size() > 1 << 16
        out, name, counts, total, shard = None, "", [], 0, 0

        def close():
            if out is not None:
                out.write(np.array(counts, "<u4").tobytes())
                out.write(np.array([len(counts), 4 if wide else 2], "<u8").tobytes())
                out.close()

        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].array, b["text"].array):
                if out is None or total >= SHARD_IDS:
                    close()
                    name, counts, total = f"payload/{task:07d}-{shard:05d}-{uuid.uuid4().hex}.ids", [], 0
                    out, shard = fs.open_output_stream(f"{root}/{name}"), shard + 1
                ids = enc.encode(text) + tail
                out.write(ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
                rows.append(((task << 20) + shard, name, len(counts), doc_id, total, len(ids) // 4))
                counts.append(len(ids) // 4)
                total += len(ids) // 4
            frame = pd.DataFrame(rows, columns=["part", "file", "ord", "doc_id", "offset", "n"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame
        close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(write, LOCATORS)


def write_index(locators: DataFrame, folder: str) -> DataFrame:
    """Write the index files; returns (bucket, index_file, n_keys, buckets)."""
    buckets = max(1, -(-locators.count() // BUCKET_KEYS))
    runs = locators.groupBy("doc_id", "part", "file").agg(F.min(F.struct("ord", "offset")).alias("at"), F.count("*").alias("rows"))
    runs = runs.withColumn("run", F.row_number().over(Window.partitionBy("doc_id").orderBy("part")) - 1)
    runs = runs.withColumn("more", F.lead("part").over(Window.partitionBy("doc_id").orderBy("part")).isNotNull())
    flat = runs.select(bucket_of(buckets), "doc_id", F.col("run").cast("long").alias("run"), "file", "part",
                       F.col("at.ord").alias("ord"), F.col("at.offset").alias("offset"), "rows", "more")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = key_hash(pdf["doc_id"], pdf["run"].to_numpy())
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two index keys share all 64 bits of their hash")
        f = PerfectHash.build(keys)
        slot = PerfectHash.slots(f, keys)
        order = np.empty(len(keys), np.int64)
        order[slot] = np.arange(len(keys))
        files, file_no = np.unique(pdf["file"].to_numpy().astype(str), return_inverse=True)
        body = C.npz_bytes(
            **f, fingerprint=(keys[order] >> np.uint64(32)).astype(np.uint32), file_no=file_no[order].astype(np.int32),
            **{c: pdf[c].to_numpy(np.int64)[order] for c in ("part", "ord", "offset", "rows")},
            more=pdf["more"].to_numpy(bool)[order], files=np.frombuffer(json.dumps(files.tolist()).encode(), np.uint8))
        fs, root = C.open_fs(folder)
        fs.create_dir(f"{root}/index", recursive=True)
        bucket = int(pdf["bucket"].iloc[0])
        name = f"index/{bucket:07d}-{uuid.uuid4().hex}.mph"
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(body)
        return pd.DataFrame([(bucket, name, len(keys), buckets)], columns=["bucket", "index_file", "n_keys", "buckets"])

    return flat.groupBy("bucket").applyInPandas(build, "bucket long, index_file string, n_keys long, buckets long")


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0).cast("long"))), F.lit(buckets)).alias("bucket")


def load_index(folder: str, name: str) -> dict[str, np.ndarray]:
    fs, root = C.open_fs(folder)
    with fs.open_input_stream(f"{root}/{name}") as src:
        f = dict(np.load(io.BytesIO(src.read())))
    f["files"] = np.array(json.loads(bytes(f["files"]).decode()), dtype=object)
    return f


FOUND = "doc_id long, part long, file string, ord long, offset long, rows long"


def lookup(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Runs of each distinct key in ``keys.doc_id`` through the index files; absent keys give no row."""
    buckets = index.agg(F.max("buckets")).first()[0]
    if buckets is None:
        return keys.sparkSession.createDataFrame([], FOUND)
    placed = (keys.select("doc_id").distinct().withColumn("bucket", bucket_of(buckets))
              .join(index.select("bucket", "index_file"), "bucket"))
    placed = placed.repartition("bucket").sortWithinPartitions("bucket")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for b in batches:
            for index_file, part in b.groupby("index_file", sort=False):
                if index_file != name:
                    name, f = index_file, load_index(folder, index_file)
                ids, run = part["doc_id"].reset_index(drop=True).astype("Int64"), 0
                while len(ids):
                    h = key_hash(ids, np.full(len(ids), run))
                    slot = PerfectHash.slots(f, h)
                    ok = slot >= 0
                    ok[ok] = f["fingerprint"][slot[ok]] == (h[ok] >> np.uint64(32)).astype(np.uint32)
                    s = slot[ok]
                    yield pd.DataFrame({"doc_id": ids[ok].to_numpy(), "part": f["part"][s], "file": f["files"][f["file_no"][s]],
                                        "ord": f["ord"][s], "offset": f["offset"][s], "rows": f["rows"][s]}).astype({"doc_id": "Int64"})
                    ids, run = ids[ok][f["more"][s]].reset_index(drop=True), run + 1

    return placed.select("bucket", "index_file", "doc_id").mapInPandas(find, FOUND)


def read_runs(runs: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of runs read from the payload files: doc_id, part, ord, offset, n_tokens, ids_crc32 (and ids)."""
    schema = "doc_id long, part long, ord long, offset long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = C.open_fs(folder)
        name, src, counts, width = None, None, None, 0
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                if r.file != name:
                    if src is not None:
                        src.close()
                    name, src = r.file, fs.open_input_file(f"{root}/{r.file}")
                    size = src.size()
                    n, width = np.frombuffer(src.read_at(16, size - 16), "<u8").tolist()
                    counts = np.frombuffer(src.read_at(4 * n, size - 16 - 4 * n), "<u4").astype(np.int64)
                at = r.offset
                for o in range(r.ord, r.ord + r.rows):
                    ids = np.frombuffer(src.read_at(int(counts[o]) * width, at * width), f"<u{width}").astype("<u4")
                    rows.append((r.doc_id, r.part, o, at, len(ids), zlib.crc32(ids.tobytes()), *([ids.astype(np.int32)] if with_ids else [])))
                    at += len(ids)
            out = pd.DataFrame(rows, columns=["doc_id", "part", "ord", "offset", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return runs.repartition("file").sortWithinPartitions("file", "offset").mapInPandas(read, schema)


def write_and_read(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write payload and index, then fetch every document by key; see the module docstring."""
    spark = docs.sparkSession
    C.bound_batches(spark)
    folder = C.work_dir(spark, "ids")
    locators = C.materialize(write_payload(docs, folder, tokenizer, end_id), "locators")
    index = C.materialize(write_index(locators, folder), "index")
    got = read_runs(lookup(locators, index, folder), folder)
    sums = locators.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    base = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return got.join(base, "part").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
                                         F.col("part").alias("shard"), "offset")
