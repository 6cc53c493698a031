"""Layered tables: parallel loads, merge on read, compaction, vacuum, and summaries from signed changes."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from blotter.operators.feeds import FeedResult
from blotter.operators.upsert import latest_per_key, upsert_by_key
from blotter.plans import jobs as J
from blotter.schemas import INCIDENT_COLUMNS, INCIDENT_SCHEMA
from blotter.sources.catalog import Catalog
from blotter.sources.commits import CommitLog


def _rows(spark, *items):
    """(uuid, city, year, count) -> incident rows."""
    base = dict.fromkeys(INCIDENT_COLUMNS)
    return spark.createDataFrame([tuple((base | {"uuid": u, "city": c, "year": y, "count": n, "crime_type": "T"}).values())
                                  for u, c, y, n in items], INCIDENT_SCHEMA)


def _load(cat, load_id, rows, mode="merge"):
    J.load_feed(cat, FeedResult(rows.withColumn("reason", F.lit(None).cast("string")), key="none"), load_id, mode=mode)


def _got(df):
    return sorted((r["uuid"], r["city"], r["year"], r["count"]) for r in df.collect())


def _yoy(cat):
    return sorted((r["city"], r["year"], r["count"]) for r in cat.read("crimes_yoy").collect())


def _held_together(monkeypatch, n=2):
    """All writers read the log before any of them publishes."""
    gate, latest, seen = threading.Barrier(n), CommitLog.latest, threading.local()

    def held(self):
        out = latest(self)
        if self.folder.endswith("/incidents/_commits") and getattr(seen, "armed", False):
            seen.armed = False
            gate.wait(60)
        return out

    publish = CommitLog._publish

    def counted(self, manifest):
        ok = publish(self, manifest)
        if self.folder.endswith("/incidents/_commits"):
            tries.append(ok)
        return ok

    tries = []
    commit = CommitLog.commit

    def armed(self, change):
        seen.armed = True
        return commit(self, change)
    monkeypatch.setattr(CommitLog, "latest", held)
    monkeypatch.setattr(CommitLog, "commit", armed)
    monkeypatch.setattr(CommitLog, "_publish", counted)
    return tries


@pytest.mark.parametrize("second_city", ["x", "y"])
def test_two_loads_at_the_same_time_both_land(spark, tmp_path, monkeypatch, second_city):
    cat = Catalog(spark, str(tmp_path))
    _load(cat, "l0", _rows(spark, ("a0", "x", 2015, 1), ("b0", second_city, 2015, 1)))
    J.refresh_summaries(cat)
    tries = _held_together(monkeypatch)
    parts = [_rows(spark, ("a1", "x", 2015, 2), ("a0", "x", 2015, 10)), _rows(spark, ("b1", second_city, 2015, 4), ("b0", second_city, 2015, 20))]
    with ThreadPoolExecutor(2) as pool:
        for f in [pool.submit(_load, cat, f"l{i}", part) for i, part in enumerate(parts, 1)]:
            f.result(timeout=300)
    assert sorted(tries) == [False, True, True]        # one came second and tried again
    assert _got(cat.read("incidents")) == sorted([("a0", "x", 2015, 10), ("a1", "x", 2015, 2), ("b0", second_city, 2015, 20), ("b1", second_city, 2015, 4)])
    J.refresh_summaries(cat)
    assert sum(n for _, _, n in _yoy(cat)) == 36


def test_same_key_loaded_twice_at_the_same_time_counts_once(spark, tmp_path, monkeypatch):
    cat = Catalog(spark, str(tmp_path))
    _load(cat, "l0", _rows(spark, ("a", "x", 2015, 1)))
    J.refresh_summaries(cat)
    _held_together(monkeypatch)
    with ThreadPoolExecutor(2) as pool:
        for f in [pool.submit(_load, cat, f"l{n}", _rows(spark, ("a", "x", 2015, n))) for n in (5, 5)]:
            f.result(timeout=300)
    J.refresh_summaries(cat)
    assert _got(cat.read("incidents")) == [("a", "x", 2015, 5)] and _yoy(cat) == [("x", 2015, 5)]


def test_reader_keeps_its_commit(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 1), ("b", "y", 2015, 1)), ["uuid"])
    before = cat.read("incidents")
    cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 2)), ["uuid"])
    cat.replace_partitions("incidents", _rows(spark, ("c", "y", 2016, 3)))
    cat.compact("incidents")
    assert _got(before) == [("a", "x", 2015, 1), ("b", "y", 2015, 1)]
    assert _got(cat.read("incidents", 2)) == [("a", "x", 2015, 2), ("b", "y", 2015, 1)]
    assert _got(cat.read("incidents")) == [("a", "x", 2015, 2), ("c", "y", 2016, 3)]


def test_load_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    cat = Catalog(spark, str(tmp_path))
    cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 1)), ["uuid"])
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_publish", lambda self, manifest: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 9), ("b", "x", 2016, 9)), ["uuid"])
    assert _got(cat.read("incidents")) == [("a", "x", 2015, 1)]
    cat.merge_partitions("incidents", _rows(spark, ("b", "x", 2016, 2)), ["uuid"])
    assert _got(cat.read("incidents")) == [("a", "x", 2015, 1), ("b", "x", 2016, 2)]


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_a_load_writes_its_own_rows_only(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    many = spark.range(50000).select(*[
        F.lit("x").alias(c) if c == "city" else F.lit(2015).alias(c) if c == "year" else F.sha2(F.col("id").cast("string"), 256).alias(c) if c == "uuid"
        else F.lit(None).cast(INCIDENT_SCHEMA[c].dataType).alias(c) for c in INCIDENT_COLUMNS]).coalesce(1)
    cat.merge_partitions("incidents", many, ["uuid"], unique=True)
    data = tmp_path / "incidents" / "data"
    before, files = _bytes(data), {str(p) for p in data.rglob("*.parquet")}
    cat.merge_partitions("incidents", _rows(spark, ("n", "x", 2015, 1)), ["uuid"])
    assert files <= {str(p) for p in data.rglob("*.parquet")}
    assert _bytes(data) - before < before / 100
    assert cat.read("incidents").count() == 50001


def test_compaction_and_loads_meanwhile(spark, tmp_path, monkeypatch):
    cat = Catalog(spark, str(tmp_path))
    for n in (1, 2, 3):
        cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, n), (f"n{n}", "x", 2015, n), ("z", None, None, n)), ["uuid"])
    cat.merge_partitions("incidents", _rows(spark, ("only", "w", 2015, 1)), ["uuid"])
    want = [("a", "x", 2015, 3), ("n1", "x", 2015, 1), ("n2", "x", 2015, 2), ("n3", "x", 2015, 3), ("only", "w", 2015, 1), ("z", None, None, 3)]
    assert _got(cat.read("incidents")) == want
    table = cat.layered("incidents")
    land = type(table)._land

    def overtaken(self, *args, **kw):
        out = land(self, *args, **kw)
        monkeypatch.setattr(type(table), "_land", land)
        other = Catalog(spark, str(tmp_path))
        other.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 4)), ["uuid"])           # stays on top
        if reload:
            other.replace_partitions("incidents", _rows(spark, ("w2", "x", 2015, 7)))               # takes folded folders away
        return out

    reload = False
    monkeypatch.setattr(type(table), "_land", overtaken)
    cat.compact("incidents")
    want[0] = ("a", "x", 2015, 4)
    assert _got(cat.read("incidents")) == want
    layers = [len(x) for x in _by_leaf(cat).values()]
    assert sorted(layers) == [1, 1, 2]
    cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, 5)), ["uuid"])
    reload = True
    monkeypatch.setattr(type(table), "_land", overtaken)
    cat.compact("incidents")
    assert _got(cat.read("incidents")) == [("only", "w", 2015, 1), ("w2", "x", 2015, 7), ("z", None, None, 3)]
    assert max(len(x) for x in _by_leaf(cat).values()) == 1


def _by_leaf(cat):
    from blotter.sources.layers import _layers
    return _layers(cat.layered("incidents").manifest())


def test_vacuum_removes_only_what_no_kept_commit_lists(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    for n in (1, 2):
        _load(cat, f"l{n}", _rows(spark, ("a", "x", 2015, n), ("b", f"c{n}", 2015, n)))
    J.refresh_summaries(cat)
    cat.compact("incidents")
    _load(cat, "l3", _rows(spark, ("a", "x", 2015, 3)))
    want = _got(cat.read("incidents"))
    assert cat.vacuum("incidents", keep=1)
    assert cat.versions("incidents") == [4] and _got(cat.read("incidents")) == want
    J.refresh_summaries(cat)
    assert _yoy(cat) == [("c1", 2015, 1), ("c2", 2015, 2), ("x", 2015, 3)]
    _load(cat, "l4", _rows(spark, ("a", "x", 2015, 4)))
    _load(cat, "l5", _rows(spark, ("a", "x", 2015, 5)))
    cat.vacuum("incidents", keep=1)                    # the change of l4 is gone: the cube is built anew
    J.refresh_summaries(cat)
    assert _yoy(cat) == [("c1", 2015, 1), ("c2", 2015, 2), ("x", 2015, 5)]


def test_refresh_reads_no_incident(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    _load(cat, "l1", _rows(spark, ("a", "x", 2015, 1), ("b", "x", 2016, None), ("c", "y", 2016, 0)))
    J.refresh_summaries(cat)
    assert _yoy_raw(cat) == {("x", 2015): 1, ("x", 2016): None, ("y", 2016): 0}
    _load(cat, "l2", _rows(spark, ("a", "x", 2015, 5), ("d", "x", 2015, 2), ("b", "x", 2016, 3)))
    _load(cat, "l2", _rows(spark, ("a", "x", 2015, 5), ("d", "x", 2015, 2), ("b", "x", 2016, 3)))    # replayed
    _load(cat, "l3", _rows(spark, ("e", "y", 2017, 4)), mode="replace")                               # y loses 2016
    cat.compact("incidents")
    (tmp_path / "incidents" / "data").rename(tmp_path / "incidents" / "data-away")
    J.refresh_summaries(cat)
    assert _yoy_raw(cat) == {("x", 2015): 7, ("x", 2016): 3, ("y", 2017): 4}
    J.refresh_summaries(cat)                           # nothing new: the same again
    assert _yoy_raw(cat) == {("x", 2015): 7, ("x", 2016): 3, ("y", 2017): 4}


def _yoy_raw(cat):
    return {(r["city"], r["year"]): r["count"] for r in cat.read("crimes_yoy").collect()}


def test_last_write_wins_by_a_sequence(spark):
    new = spark.createDataFrame([("k", 1, "z"), ("k", 2, "a")], "key string, seq int, v string")
    old = spark.createDataFrame([("k", 0, "o"), ("m", 0, "o")], "key string, seq int, v string")
    assert [tuple(r) for r in latest_per_key(new, ["key"], order="seq").select("key", "v").collect()] == [("k", "a")]
    assert sorted(tuple(r) for r in upsert_by_key(old, new, "key", order="seq").collect()) == [("k", 2, "a"), ("m", 0, "o")]


def test_pruned_read_scans_only_the_filtered_city(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    for n in (1, 2):
        cat.merge_partitions("incidents", _rows(spark, ("a", "x", 2015, n), ("b", "y", 2015, n)), ["uuid"])
    df = cat.read("incidents").filter("city = 'y'")
    assert len(df.inputFiles()) >= 1 and _got(df) == [("b", "y", 2015, 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "city" in plan.split("PartitionFilters: [")[1].split("]")[0]
