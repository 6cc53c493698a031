import json

from blotter.lookups import type_map_df
from blotter.operators.feeds import adapt_socrata
from blotter.schemas import SOCRATA_INCIDENT_SCHEMA
from blotter.sources.catalog import Catalog
from blotter.streaming.ingest import start_feed_stream


def _land(d, name, recs):
    (d / name).write_text("\n".join(json.dumps(r) for r in recs))


def test_stream_ingest_is_idempotent(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    rec = {"incident_datetime": "2017-12-31T23:10:00.000", "address_1": "1 Elgin", "city": "Ottawa",
           "latitude": "45.42", "longitude": "-75.69", "hour_of_day": "23", "parent_incident_type": "Traffic"}
    bad = dict(rec, parent_incident_type="Unlisted")
    _land(land, "a.json", [rec, rec, bad])
    cat = Catalog(spark, str(tmp_path / "wh"))
    tm = type_map_df(spark)

    def adapt(df):
        return adapt_socrata(df, tm, on_unmapped="reject")

    ck = str(tmp_path / "ckpt")
    q = start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, adapt, cat, name="t", checkpoint=ck)
    q.awaitTermination(120)
    inc = cat.read("incidents").collect()
    assert len(inc) == 2 and len({r["uuid"] for r in inc}) == 2          # identical rows kept apart
    assert cat.read("incident_rejects").count() == 1
    # second landing: only the new file is processed; its rows are new incidents, though equal
    _land(land, "b.json", [rec, rec])
    q = start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, adapt, cat, name="t", checkpoint=ck)
    q.awaitTermination(120)
    assert cat.read("incidents").count() == 4
    # the same files replayed from the start: no change
    q = start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, adapt, cat, name="t", checkpoint=str(tmp_path / "ckpt2"))
    q.awaitTermination(120)
    assert cat.read("incidents").count() == 4


def test_stream_does_not_depend_on_the_batch_cut(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    rec = {"incident_datetime": "2017-12-31T23:10:00.000", "address_1": "1 Elgin", "city": "Ottawa",
           "latitude": "45.42", "longitude": "-75.69", "hour_of_day": "23", "parent_incident_type": "Traffic"}
    for i in range(3):
        _land(land, f"{i}.json", [rec, rec, dict(rec, hour_of_day=str(i))])
    tm = type_map_df(spark)
    keys = []
    for n in (1, 64):
        cat = Catalog(spark, str(tmp_path / f"wh{n}"))
        start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, lambda df: adapt_socrata(df, tm), cat, name=f"cut{n}",
                          checkpoint=str(tmp_path / f"ck{n}"), max_files_per_trigger=n).awaitTermination(120)
        keys.append(sorted(r["uuid"] for r in cat.read("incidents").collect()))
    assert len(keys[0]) == 9 and keys[0] == keys[1]


def test_stream_replay_after_crash_is_idempotent(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    rec = {"incident_datetime": "2018-03-01T10:00:00.000", "address_1": "9 Bank", "city": "Ottawa",
           "latitude": "45.4", "longitude": "-75.7", "hour_of_day": "10", "parent_incident_type": "Alarm"}
    _land(land, "a.json", [rec, dict(rec, hour_of_day="11"), dict(rec, parent_incident_type="Unlisted")])
    cat = Catalog(spark, str(tmp_path / "wh"))
    tm = type_map_df(spark)

    class Crash(Exception):
        pass

    state = {"crash": True}

    class FlakyCatalog(Catalog):
        def merge_partitions(self, name, *args, **kw):
            if state["crash"] and name == "incident_rejects":
                state["crash"] = False
                raise Crash("executor lost after the incident merge")
            return super().merge_partitions(name, *args, **kw)

    flaky = FlakyCatalog(spark, str(tmp_path / "wh"))

    def adapt(df):
        return adapt_socrata(df, tm, on_unmapped="reject")

    ck = str(tmp_path / "ckpt")
    q = start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, adapt, flaky, name="c", checkpoint=ck)
    try:
        q.awaitTermination(120)
    except Exception:
        pass
    assert cat.read("incidents").count() == 2                    # merged before the crash
    q = start_feed_stream(spark, str(land), SOCRATA_INCIDENT_SCHEMA, adapt, flaky, name="c", checkpoint=ck)
    q.awaitTermination(120)                                      # the batch is replayed
    assert cat.read("incidents").count() == 2                    # no duplicates from the replay
    assert cat.read("incident_rejects").count() == 1
