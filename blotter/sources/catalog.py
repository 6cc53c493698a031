"""Parquet table catalogue: read by name, versioned writes, keyed upsert.

A table lives under ``<root>/<name>/``. Whole tables are numbered version
directories ``v00000001/ …``; a version is visible once Spark's ``_SUCCESS``
marker is written, so readers never see a half-written table and a failed job
leaves the previous version in place. An upsert of such a table reads the current
version and writes the next one -- it never overwrites a path its own plan reads.

The incident table is partitioned by ``(city, year)``, the rejects by reason; both are kept as layers
(:mod:`layers`): a load writes its own rows and commits a manifest, a reload
replaces only its cities, readers merge the layers by key.

Every table is read with the schema it was written with, never one inferred
from folder names: a city ``007`` stays text. The empty text, which a partition
folder cannot hold apart from null, is stored escaped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.upsert import latest_per_key, upsert_by_key
from .layers import LayeredTable, Signed

# Tables and their partition columns. Incidents are partitioned by city and
# year: a load touches only the (city, year) partitions of its rows, and year
# ranges prune files like city lists do.
PARTITIONS = {"incidents": ["city", "year"], "incident_rejects": ["reason"]}


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(conf)

    # ---- versions ------------------------------------------------------------
    def _table_dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def layered(self, name: str) -> LayeredTable:
        """The layers of a partitioned table."""
        parts = PARTITIONS.get(name)
        if not parts:
            raise ValueError(f"table {name!r} is not partitioned")
        return LayeredTable(self.spark, self._table_dir(name), parts)

    def versions(self, name: str) -> list[int]:
        """Committed versions; of a partitioned table, its commits."""
        if name in PARTITIONS:
            return self.layered(name).log.versions()
        d = self._Path(self._table_dir(name))
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            n = st.getPath().getName()
            if n.startswith("v") and n[1:].isdigit():
                if self._fs.exists(self._Path(st.getPath(), "_SUCCESS")):
                    out.append(int(n[1:]))
        return sorted(out)

    def current_path(self, name: str) -> str | None:
        v = self.versions(name)
        return f"{self._table_dir(name)}/v{v[-1]:08d}" if v else None

    def _next_path(self, name: str) -> str:
        d = self._Path(self._table_dir(name))
        used = [0]
        if self._fs.exists(d):
            for st in self._fs.listStatus(d):
                n = st.getPath().getName()
                if n.startswith("v") and n[1:].isdigit():
                    used.append(int(n[1:]))
        return f"{self._table_dir(name)}/v{max(used) + 1:08d}"

    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` committed versions (and any
        uncommitted folder older than them). Readers of a removed version
        must have finished; keep >= 2 leaves the previous one for them."""
        if name in PARTITIONS:
            return self.layered(name).vacuum(keep) if keep >= 1 else []
        d = self._Path(self._table_dir(name))
        if keep < 1 or not self._fs.exists(d):
            return []
        live = self.versions(name)[-keep:]
        cutoff = live[0] if live else 0
        removed = []
        for st in self._fs.listStatus(d):
            n = st.getPath().getName()
            if n.startswith("v") and n[1:].isdigit() and int(n[1:]) < cutoff:
                self._fs.delete(st.getPath(), True)
                removed.append(str(st.getPath()))
        return sorted(removed)

    # ---- S7: read -------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The newest version of a table, or the one named."""
        known = self.versions(name)
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"table {name!r} has no committed version {version or ''} under {self.root}")
        if name in PARTITIONS:
            return self.layered(name).read(version)
        p = f"{self._table_dir(name)}/v{version or known[-1]:08d}"
        return self.spark.read.schema(self.schema(name, p)).parquet(p)

    def schema(self, name: str, path: str) -> T.StructType:
        """The schema the version at ``path`` was written with."""
        f = self._Path(self._schema_path(name, path))
        if not self._fs.exists(f):
            return self.spark.read.parquet(path).schema
        src = self._fs.open(f)
        try:
            return T.StructType.fromJson(json.loads(bytes(src.readAllBytes()).decode()))
        finally:
            src.close()

    def _schema_path(self, name: str, path: str) -> str:
        return f"{self._table_dir(name)}/_schemas/{path.rstrip('/').rpartition('/')[2]}.json"

    def _write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._Path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def note(self, name: str) -> dict:
        """What :meth:`write` was given as ``note`` for the newest version."""
        p = self.current_path(name)
        f = self._Path(self._note_path(name, p)) if p else None
        if f is None or not self._fs.exists(f):
            return {}
        src = self._fs.open(f)
        try:
            return json.loads(bytes(src.readAllBytes()).decode())
        finally:
            src.close()

    def _note_path(self, name: str, path: str) -> str:
        return f"{self._table_dir(name)}/_notes/{path.rstrip('/').rpartition('/')[2]}.json"

    # ---- K2: whole-table rewrite (aggregates are rebuilt whole) -----------------
    def write(self, name: str, df: DataFrame, note: dict | None = None) -> str:
        if name in PARTITIONS:
            self.layered(name).write(df)
            return self._table_dir(name)
        p = self._next_path(name)
        self._write_text(self._schema_path(name, p), df.schema.json())
        if note is not None:
            self._write_text(self._note_path(name, p), json.dumps(note))
        df.write.mode("errorifexists").parquet(p)
        return p

    # ---- K1: insert-or-replace by key ------------------------------------------
    def upsert(self, name: str, new: DataFrame, keys: list[str]) -> str:
        if not self.exists(name):
            return self.write(name, latest_per_key(new, keys))
        merged = upsert_by_key(self.read(name), new, keys)
        return self.write(name, merged)

    # ---- K3: replace whole partitions (a city reload) -------------------------
    def replace_partitions(self, name: str, df: DataFrame, signed: Signed | None = None) -> str:
        """Replace every partition of the top-level values in ``df`` (for
        incidents: each city in ``df``) with ``df``; other cities untouched.

        Cost is proportional to ``df``; it may be derived from this table.
        Sub-partitions of the reloaded cities that ``df`` no longer has (a year
        dropped from the feed) are no longer live. ``signed``: see :mod:`layers`.
        """
        self.layered(name).replace(df, signed)
        return self._table_dir(name)

    # ---- K1 on a partitioned table: one layer more -----------------------------
    def merge_partitions(self, name: str, new: DataFrame, keys: list[str], unique: bool = False, signed: Signed | None = None) -> str:
        """Upsert ``new`` into its partitions; nothing that is stored is rewritten.

        ``unique``: the keys of ``new`` are unique by construction. ``signed``:
        see :mod:`layers`.
        """
        self.layered(name).merge(new, keys, unique, signed)
        return self._table_dir(name)

    def compact(self, name: str) -> dict | None:
        """Fold the layers of a partitioned table (an upkeep job of its own)."""
        return self.layered(name).compact()
