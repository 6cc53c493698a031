"""Replay after a lookup changed: the same tables as loading everything with the new lookups."""

from pyspark.sql import functions as F

from blotter.operators.feeds import adapt_edmonton, adapt_socrata, adapt_toronto
from blotter.plans import jobs as J
from blotter.plans.replay import changed_places, changed_types, replay
from blotter.schemas import EDMONTON_SCHEMA, GAZETTEER_SCHEMA, SOCRATA_INCIDENT_SCHEMA, TYPE_MAP_SCHEMA
from blotter.sources.catalog import Catalog


def _raw(spark, schema, rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def _types(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()), TYPE_MAP_SCHEMA)


def _socrata(spark):
    subs = ["Theft", "Noise", "Fire", "Alarm", None, "Theft"]
    return _raw(spark, SOCRATA_INCIDENT_SCHEMA, [
        {"incident_datetime": f"201{i % 3 + 5}-02-03T04:00:00.000", "address_1": f"{i // 2} St", "city": ["Ottawa", "Victoria", None][i % 3],
         "latitude": "45.1" if i % 7 else "1000", "longitude": "-75.1", "hour_of_day": "3", "parent_incident_type": subs[i % 6]} for i in range(60)])


def _edmonton(spark):
    return _raw(spark, EDMONTON_SCHEMA, [{"neighbourhood": n, "crimesub_type": s, "year": "2016", "month": "5", "count": "2"}
                                         for n in ("A", "B", "C", "D", None) for s in ("Theft", "Noise")])


def _toronto(spark):
    return spark.createDataFrame([(("Theft", "Theft", 4, 43.6, -79.3, "March", "N", 2017),)],
                                 "properties struct<MCI string, offence string, reportedhour int, Lat double, Long double, reportedmonth string, Neighbourhood string, reportedyear int>")


def _state(cat):
    out = {}
    for t in ("incidents", "incident_rejects", "crimes_yoy"):
        out[t] = sorted(map(tuple, cat.read(t).collect()), key=repr)
    return out


def _load(cat, spark, types, gazetteer):
    J.load_feed(cat, adapt_socrata(_socrata(spark), types), "s")
    J.load_feed(cat, adapt_toronto(_toronto(spark)), "t")
    J.load_feed(cat, adapt_edmonton(_edmonton(spark), types, gazetteer, spark.createDataFrame([], GAZETTEER_SCHEMA)), "e")
    J.refresh_summaries(cat)


def test_replay_equals_a_load_with_the_new_lookups(spark, tmp_path):
    loc = ", Edmonton, Canada"
    old, new = _types(spark, Theft="T", Noise="N", Alarm="A"), _types(spark, Theft="Property", Noise="N", Fire="F")
    before = spark.createDataFrame([("A" + loc, 53.1, -113.1), ("B" + loc, 0.0, 0.0), ("D" + loc, 53.4, -113.4)], GAZETTEER_SCHEMA)
    after = spark.createDataFrame([("A" + loc, 53.1, -113.1), ("B" + loc, 53.2, -113.2), ("C" + loc, 99.0, -113.3), ("D" + loc, 0.0, 5.0)], GAZETTEER_SCHEMA)
    cat = Catalog(spark, str(tmp_path / "a"))
    _load(cat, spark, old, before)
    done = replay(cat, types=(old, new), places=(before, after))
    assert done["incidents"] and done["rejects"]
    J.refresh_summaries(cat)
    want = Catalog(spark, str(tmp_path / "b"))
    _load(want, spark, new, after)
    assert _state(cat) == _state(want)
    replay(cat, types=(old, new), places=(before, after))     # again: nothing changes
    J.refresh_summaries(cat)
    assert _state(cat) == _state(want)
    cat.compact("incidents"), cat.compact("incident_rejects")
    assert _state(cat) == _state(want)
    replay(cat, types=(new, old), places=(after, before))      # and back
    J.refresh_summaries(cat)
    back = Catalog(spark, str(tmp_path / "c"))
    _load(back, spark, old, before)
    assert _state(cat) == _state(back)


def test_only_changed_keys_are_named(spark):
    t = changed_types(_types(spark, a="1", b="2", c="3"), _types(spark, a="1", b="9", d="4"))
    assert sorted(map(tuple, t.collect())) == [("b", "9"), ("c", None), ("d", "4")]
    g = spark.createDataFrame([("x", 1.0, 2.0), ("y", 1.0, 2.0)], GAZETTEER_SCHEMA)
    h = g.where("locality = 'x'").unionByName(spark.createDataFrame([("z", 3.0, 4.0)], GAZETTEER_SCHEMA))
    assert sorted(map(tuple, changed_places(g, h).collect())) == [("y", 0.0, 0.0), ("z", 3.0, 4.0)]
    assert changed_places(g, g.withColumn("lat", F.col("lat"))).count() == 0


def test_edmonton_feed_is_read_and_counted_once(spark):
    """Located and unlocated rows come from one pass, and both outputs of a load from one count of equal rows."""
    loc = ", Edmonton, Canada"
    raw = _edmonton(spark)
    gazetteer = spark.createDataFrame([("A" + loc, 53.1, -113.1), ("B" + loc, 0.0, 0.0)], GAZETTEER_SCHEMA)
    out = adapt_edmonton(raw.unionAll(raw).unionAll(raw).localCheckpoint(), _types(spark, Theft="T"), gazetteer, spark.createDataFrame([], GAZETTEER_SCHEMA))
    assert "Union" not in out.rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["reason"] or "", r["crimesub_type"], r["__n"]) for r in out.shared.collect() if r["neighbourhood"] in ("A", "B")) == [
        ("", "Theft", 3), ("no_location", "Noise", 3), ("no_location", "Theft", 3), ("unmapped_type", "Noise", 3)]
    assert all(r["crime_type"] is None for r in out.shared.where("reason = 'no_location'").collect())
    assert out.kept.count() == 3 and out.kept.select("uuid").distinct().count() == 3
    assert out.rejected_keyed.count() == 27 and out.rejected_keyed.select("uuid").distinct().count() == 27
