"""Partitioned tables kept as layers: merge on read, atomic commits, compaction.

Every load writes one folder ``data/_load=<id>/<partition folders>`` and then
commits a manifest that lists, for each load, its number and the partition folders
of it that are live. So

* a load writes its own rows and nothing else, however large the partitions are;
* a reader works on one manifest and never sees half of a load;
* loads at the same time both land (:mod:`commits`);
* a load that dies before its commit leaves the table as it was.

Rows are identified by key within their partition. Of a key's rows in several
layers of a partition the one of the latest load counts; a layer of keys alone
(``dead``) takes rows away; partitions with a single layer are scanned as they are. ``compact`` folds the layers of each partition into
one, ``vacuum`` removes what no kept manifest lists.

A load can leave its *signed change* with its commit: an aggregate of the rows it
adds and, with the opposite sign, of those it replaces (read from the touched
partitions alone). Tables of sums are refreshed from these changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import latest_per_key
from .commits import CommitConflict, CommitLog

LOAD = "_load"             # partition folder level that holds a load's id
_ESCAPE = "="              # first character of an escaped partition text: '' -> '=', '=x' -> '==x'
FOLDS = 20                 # attempts of a compaction that loads keep overtaking

# (rows added, rows replaced or None) -> their signed aggregate
Signed = Callable[[DataFrame, DataFrame | None], DataFrame]


def escaped(df: DataFrame, parts: list[str]) -> DataFrame:
    """Partition texts as folder names can hold them."""
    for c in parts:
        if isinstance(df.schema[c].dataType, T.StringType):
            v = F.col(f"`{c}`")
            df = df.withColumn(c, F.when((v == "") | v.startswith(_ESCAPE), F.concat(F.lit(_ESCAPE), v)).otherwise(v))
    return df


def plain(df: DataFrame, schema: T.StructType, parts: list[str]) -> list[Column]:
    """Inverse of :func:`escaped`: the table's columns in order."""
    out = []
    for f in schema.fields:
        v = F.col(f"`{f.name}`")
        if f.name in parts and isinstance(f.dataType, T.StringType):
            v = F.when(v.startswith(_ESCAPE), F.substring(v, 2, 1 << 30)).otherwise(v).alias(f.name)
        out.append(v)
    return out


def _layers(m: dict) -> dict[str, list[dict]]:
    """The loads of each live partition folder, oldest first."""
    out: dict[str, list[dict]] = {}
    for load in sorted(m["loads"], key=lambda x: x["seq"]):
        for leaf in load["leaves"]:
            out.setdefault(leaf, []).append(load)
    return out


class LayeredTable:
    def __init__(self, spark: SparkSession, folder: str, parts: list[str]):
        self.spark, self.folder, self.parts = spark, folder.rstrip("/"), parts
        self.log = CommitLog(spark, f"{self.folder}/_commits")
        self._Path, self._fs = self.log._Path, self.log._fs

    # ---- reading -----------------------------------------------------------
    def manifest(self, version: int | None = None) -> dict | None:
        return self.log.latest() if version is None else self.log.read(version)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a commit (the newest, if none is named)."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no commit under {self.folder}")
        return self.rows(m)

    def rows(self, m: dict, only: set[str] | None = None) -> DataFrame:
        """Live rows of a manifest, of the partition folders ``only`` if given."""
        layers = {leaf: loads for leaf, loads in _layers(m).items() if only is None or leaf in only}
        layers = {leaf: loads for leaf, loads in layers.items() if not all(x.get("dead") for x in loads)}
        single = self._scan(m, {leaf: loads for leaf, loads in layers.items() if len(loads) == 1})
        if len(deep := {leaf: loads for leaf, loads in layers.items() if len(loads) > 1}) == 0:
            return single.drop(LOAD)
        folded = self._newest(m, deep)
        return single.drop(LOAD).unionByName(folded) if len(layers) > len(deep) else folded

    def _scan(self, m: dict, layers: dict[str, list[dict]]) -> DataFrame:
        """Rows of some layers of some partition folders, with the load's id."""
        schema = T.StructType.fromJson(m["schema"])
        wanted: dict[str, list[str]] = {}
        for leaf, loads in layers.items():
            for load in loads:
                wanted.setdefault(load["id"], []).append(leaf)
        if not wanted:
            return self.spark.createDataFrame([], schema).withColumn(LOAD, F.lit(None).cast("string"))
        written, base, paths = {x["id"]: x["written"] for x in m["loads"]}, f"{self.folder}/data", []
        for load, leaves in wanted.items():  # a load that is live as a whole is one path
            paths += [f"{base}/{LOAD}={load}"] if len(leaves) == written[load] else [f"{base}/{LOAD}={load}{leaf}" for leaf in leaves]
        with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        df = self.spark.read.schema(with_load).option("basePath", base).parquet(*paths)
        return df.select(*plain(df, schema, self.parts), LOAD)

    def _newest(self, m: dict, layers: dict[str, list[dict]]) -> DataFrame:
        """Rows without a later layer's row of the same key and partition.

        Only keys of the later layers are gathered and matched; the planner
        broadcasts them if they are few, so the oldest layer stays in place.
        """
        ids = [x["id"] for x in sorted(m["loads"], key=lambda x: x["seq"])]
        seq = {x["id"]: x["seq"] for x in m["loads"]}
        number = F.element_at(F.array(*[F.lit(seq[i]) for i in ids]), F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(LOAD)).cast("int"))
        rows = self._scan(m, {leaf: [x for x in loads if not x.get("dead")] for leaf, loads in layers.items()}).withColumn("__seq", number).drop(LOAD)
        keyed = {leaf: [x for x in loads[1:] if x["keys"]] for leaf, loads in layers.items()}
        names = next((x["keys"] for loads in keyed.values() for x in loads), None)
        if names is None:
            return rows.drop("__seq")
        # keys before partitions: the join sorts by them, and the first alone tells nearly all rows apart
        same = [*names, *[c for c in self.parts if c not in names]]
        later = (self._scan(m, {leaf: loads for leaf, loads in keyed.items() if loads})
                 .select(*[F.col(c).alias(f"__{c}") for c in same], number.alias("__later")))
        on = F.col("__later") > F.col("__seq")
        for c in same:  # a null key equals nothing, a null partition itself
            on &= F.col(c).eqNullSafe(F.col(f"__{c}")) if c in self.parts else F.col(c) == F.col(f"__{c}")
        return rows.join(later, on, "left_anti").drop("__seq")

    # ---- writing -----------------------------------------------------------
    def _land(self, rows: DataFrame, keys: list[str] | None, dead: bool = False) -> dict:
        """Write a load's folder; its entry for a manifest, still without number."""
        load = uuid.uuid4().hex
        path = f"{self.folder}/data/{LOAD}={load}"
        escaped(rows, self.parts).write.mode("errorifexists").partitionBy(*self.parts).parquet(path)
        leaves = [""]
        for _ in self.parts:
            leaves = [f"{leaf}/{st.getPath().getName()}" for leaf in leaves for st in self._fs.listStatus(self._Path(path + leaf))
                      if st.isDirectory() and "=" in st.getPath().getName()]
        return {"id": load, "leaves": sorted(leaves), "written": len(leaves), "keys": keys} | ({"dead": True} if dead else {})

    def _drop(self, load: dict) -> None:
        self._fs.delete(self._Path(f"{self.folder}/data/{LOAD}={load['id']}"), True)

    def _own(self, now: dict, landed: list[dict], dead: bool) -> DataFrame:
        """Rows of landed loads that are not committed yet."""
        loads = [x | {"seq": i} for i, x in enumerate(landed) if bool(x.get("dead")) == dead]
        return self._scan({"schema": now["schema"], "loads": loads}, {leaf: x for leaf, x in _layers({"loads": loads}).items()}).drop(LOAD)

    def _change(self, kind: str, landed: list[dict], signed: Signed | None, replaced: Callable[[dict], tuple], apply: Callable[[dict], list[dict]],
                schema: T.StructType) -> dict:
        """Commit landed loads. ``replaced``: (layers it depends on, rows that go or None) of a manifest."""
        made: dict = {}

        def change(now: dict | None) -> dict:
            now = now or {"schema": schema.jsonValue(), "loads": [], "seq": 0, "version": 0}
            note = {"kind": kind, "load": [x["id"] for x in landed], "delta": None}
            if signed is not None:
                known, gone = replaced(now)
                if made.get("known") != known or not made:  # first, or another load came between
                    path = f"{self.folder}/changes/{uuid.uuid4().hex}"
                    signed(self._own(now, landed, dead=False), gone).write.mode("errorifexists").parquet(path)
                    made.update(known=known, path=path)
                note["delta"] = made["path"]
            seq = now["seq"] + 1
            loads = [x for x in apply(now) if x["leaves"]] + [x | {"seq": seq} for x in landed if x["leaves"]]
            return {"schema": now["schema"], "loads": loads, "seq": seq, "change": note}
        return self.log.commit(change)

    def _columns(self, rows: DataFrame) -> tuple[DataFrame, T.StructType]:
        now = self.manifest()
        schema = T.StructType.fromJson(now["schema"]) if now else rows.schema
        return rows.select(*[F.col(f"`{c}`") for c in schema.names]), schema

    def merge(self, new: DataFrame, keys: list[str], unique: bool = False, signed: Signed | None = None, gone: DataFrame | None = None) -> dict:
        """Insert or replace by key within the partition (K1): one layer more.

        ``unique``: the keys of ``new`` are unique by construction. ``gone``:
        rows (partition columns and keys) that the same commit takes away.
        """
        rows, schema = self._columns(new)
        same = [*keys, *[c for c in self.parts if c not in keys]]
        landed = [self._land(rows if unique else latest_per_key(rows, same).select(*schema.names), list(keys))]
        if gone is not None:
            landed.append(self._land(gone.select(*[F.col(c).cast(schema[c].dataType) for c in same]).distinct(), list(keys), dead=True))

        def replaced(now: dict) -> tuple:
            touched = {leaf for x in landed for leaf in x["leaves"]}
            known = {leaf: [x["id"] for x in loads] for leaf, loads in _layers(now).items() if leaf in touched}
            if not known:
                return known, None
            mine = self._own(now, landed, dead=False).select(*same).unionByName(self._own(now, landed, dead=True).select(*same))
            mine = mine.select(*[F.col(c).alias(f"__{c}") for c in same])
            on = F.lit(True)
            for c in same:
                on &= F.col(c).eqNullSafe(F.col(f"__{c}")) if c in self.parts else F.col(c) == F.col(f"__{c}")
            return known, self.rows(now, touched).join(mine, on, "left_semi")

        return self._change("merge", landed, signed, replaced, lambda now: now["loads"], schema)

    def replace(self, df: DataFrame, signed: Signed | None = None) -> dict:
        """Replace every partition of the top-level values in ``df`` (K3): their older layers are no longer live."""
        rows, schema = self._columns(df)
        landed = self._land(rows, None)
        tops = {leaf.split("/")[1] for leaf in landed["leaves"]}

        def goes(leaf: str) -> bool:
            return leaf.split("/")[1] in tops

        def replaced(now: dict) -> tuple:
            known = {leaf: [x["id"] for x in loads] for leaf, loads in _layers(now).items() if goes(leaf)}
            return known, self.rows(now, set(known)) if known else None

        def apply(now: dict) -> list[dict]:
            return [x | {"leaves": [leaf for leaf in x["leaves"] if not goes(leaf)]} for x in now["loads"]]

        return self._change("replace", [landed], signed, replaced, apply, schema)

    def write(self, df: DataFrame) -> dict:
        """The whole table anew."""
        landed = self._land(df, None)

        def change(now: dict | None) -> dict:
            new = landed | {"seq": (now["seq"] if now else 0) + 1}
            return {"schema": df.schema.jsonValue(), "loads": [new] if new["leaves"] else [], "seq": new["seq"],
                    "change": {"kind": "write", "load": [landed["id"]], "delta": None}}
        return self.log.commit(change)

    # ---- upkeep ------------------------------------------------------------
    def compact(self, least: int = 2) -> dict | None:
        """Fold the layers of every partition with ``least`` or more into one; the rows stay the same.

        Loads committed meanwhile keep their layers on top. If one took a folded
        folder away (a reload of the city), the fold starts anew.
        """
        for _ in range(FOLDS):
            now = self.manifest()
            layers = _layers(now) if now else {}
            deep = {leaf: loads for leaf, loads in layers.items() if len(loads) >= least or all(x.get("dead") for x in loads)}
            if not deep:
                return now
            landed = self._land(self.rows(now, set(deep)), None)
            old, top = {leaf: {x["id"] for x in loads} for leaf, loads in deep.items()}, max(x["seq"] for loads in deep.values() for x in loads)

            def change(cur: dict) -> dict | None:
                live = {leaf: {x["id"] for x in loads} for leaf, loads in _layers(cur).items()}
                if any(not ids <= live.get(leaf, set()) for leaf, ids in old.items()):
                    return None
                loads = [x | {"leaves": [leaf for leaf in x["leaves"] if x["id"] not in old.get(leaf, ())]} for x in cur["loads"]]
                # numbered as the latest load it holds: a load in between keeps its greater number
                loads = [x for x in loads if x["leaves"]] + ([landed | {"seq": top}] if landed["leaves"] else [])
                return {"schema": cur["schema"], "loads": loads, "seq": cur["seq"], "change": {"kind": "compact", "load": [landed["id"]], "delta": None}}

            done = self.log.commit(change)
            if done["change"]["load"] == [landed["id"]]:
                return done
            self._drop(landed)
        raise CommitConflict(f"{self.folder}: reloads kept overtaking the compaction")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove manifests before the newest ``keep``, and the folders that only they list.

        Their readers must have finished. Folders of loads that have not
        committed are in no manifest and stay.
        """
        versions = self.log.versions()
        old, kept = versions[:-keep] if keep else [], versions[-keep:]
        if not old:
            return []
        live, stale = set(), set()
        for v in kept:
            m = self.log.read(v)
            live |= {x["id"] for x in m["loads"]} | {m["change"]["delta"]}
        for v in old:
            m = self.log.read(v)
            stale |= {x["id"] for x in m["loads"]} | {*m["change"]["load"], m["change"]["delta"]}
        gone = []
        for name in sorted(x for x in stale - live if x):
            path = name if "/changes/" in name else f"{self.folder}/data/{LOAD}={name}"
            self._fs.delete(self._Path(path), True)
            gone.append(path)
        for v in old:
            self.log.delete(v)
        return gone
