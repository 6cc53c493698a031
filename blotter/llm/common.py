"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Arrow batches are bounded by bytes as well as rows, so that a run of very
# long texts cannot fill a Python worker.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches unless the session's owner chose other bounds.

    Python workers also get the driver's place of this package on their path,
    for sessions that were started without it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    explicit = spark.sparkContext.getConf()
    for k, v in BATCH_CONF.items():
        if not explicit.contains(k):
            spark.conf.set(k, v)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder.

    The folder is registered for removal when the application ends.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).deleteOnExit(p)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_ROWS = 500_000       # rows that may be broadcast


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows, else left to a shuffle join.

    ``df`` is a written table of rows of fixed width (ids, hashes, digests: at most
    some 120 bytes), so the counted rows bound the broadcast to some 60 MB; either
    join gives the same rows.
    """
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI or plain path in the shared store."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary array; null counts as empty.

    Views of the Arrow buffers: no per-row Python object is made.
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n, at = len(arr), arr.offset
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[at:at + n + 1].astype(np.int64)
    if bufs[2] is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64) over a uint64 array."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(977))
_BASE = 0x9FB21C651E98DF25 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class PrefixHash:
    """Hashes of any byte range of ``data`` in O(1), vectorised.

    Sum of code(byte) * base^i modulo 2^64, shifted back by the inverse power
    so that equal byte strings have equal hashes wherever they start.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(pow(_BASE, -1, 1 << 64), n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix64(raw ^ ((end - start).astype(np.uint64) * _GOLD))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, and word offsets per text."""
    n = len(offs) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    text_starts = offs[:-1][offs[:-1] < offs[1:]]
    first[text_starts] = inside[text_starts]
    ends = text_starts[text_starts > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = PrefixHash(_LOWER[data] if lower else data).ranges(starts, stops)
    return hashes, np.searchsorted(starts, offs).astype(np.int64)


def shingle_hashes(words: np.ndarray, woffs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size``-word windows of each text (with fewer words: one for all), sorted per text."""
    n = len(woffs) - 1
    counts = np.diff(woffs)
    per = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    if len(words) == 0:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    owner = np.repeat(np.arange(n), per)
    begin = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(len(owner)) - begin[owner] + woffs[owner]
    length = np.minimum(counts[owner], size)
    acc = mix64(length.astype(np.uint64))
    for j in range(size):
        nxt = words[np.minimum(at + j, len(words) - 1)]
        acc = np.where(j < length, mix64(acc ^ nxt), acc)
    order = np.lexsort((acc, owner))
    acc, owner = acc[order], owner[order]
    keep = np.ones(len(acc), bool)
    keep[1:] = (acc[1:] != acc[:-1]) | (owner[1:] != owner[:-1])
    acc, owner = acc[keep], owner[keep]
    return acc, np.searchsorted(owner, np.arange(n + 1)).astype(np.int64)


def ragged(values: np.ndarray, offs: np.ndarray, type_: pa.DataType) -> pa.Array:
    """List array over ``values`` with row bounds ``offs``."""
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values.view(np.int64), pa.int64()).cast(type_))


def npz_bytes(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()
