"""End-to-end: load feeds into a catalogue, rebuild summaries, train, score."""

import json

from pyspark.sql import functions as F

from blotter.lookups import type_map_df
from blotter.operators import feeds as FD
from blotter.plans import jobs as J
from blotter.sources import files as S
from blotter.sources.catalog import Catalog


def _socrata_records():
    recs = []
    for i in range(120):
        recs.append({"incident_datetime": f"201{4 + i % 6}-{1 + i % 12:02d}-0{1 + i % 9}T{i % 24:02d}:10:00.000",
                     "address_1": f"{i} Main", "city": ["Ottawa", "Victoria", "Lethbridge"][i % 3],
                     "latitude": str(45.0 + (i % 10) * 0.01), "longitude": str(-75.0 - (i % 7) * 0.01),
                     "hour_of_day": str(i % 24),
                     "parent_incident_type": ["Traffic", "Alarm", "Theft", "Assault", "Nope"][i % 5]})
    return recs


def test_load_summarise_train_score(spark, tmp_path):
    p = tmp_path / "soc.json"
    p.write_text(json.dumps(_socrata_records()))
    cat = Catalog(spark, str(tmp_path / "wh"))
    tm = type_map_df(spark)
    raw = S.read_json_array(spark, str(p))
    res = FD.adapt_socrata(raw, tm, on_unmapped="reject")
    J.load_feed(cat, res, "soc-1")
    J.load_feed(cat, FD.adapt_socrata(raw, tm, on_unmapped="reject"), "soc-1")   # re-run: no duplicates
    inc = cat.read("incidents")
    assert inc.count() == 96 and inc.select("uuid").distinct().count() == 96
    rep = J.unmapped_report(cat).collect()
    assert sum(r["count"] for r in rep) == 24 and {r["crimesub_type"] for r in rep} == {"Nope"}

    J.rebuild_summaries(cat)
    yoy = cat.read("crimes_yoy")
    assert yoy.agg(F.sum("count")).first()[0] == 96
    typ = cat.read("crimes_typ").agg(F.sum("count")).first()[0]
    assert typ == inc.filter((F.col("year") > 2013) & (F.col("year") <= 2019)).count()
    assert set(r["seasons"] for r in cat.read("crimes_ss").collect()) <= {"Winter", "Spring", "Summer", "Fall"}

    J.build_training(cat)
    rmse = J.train_model(cat, str(tmp_path / "model"), max_iter=3)
    assert rmse >= 0.0
    locs = spark.createDataFrame([(1, "1 Elgin St, Ottawa, ON", 45.42, -75.69), (2, "Springfield", 40.0, -89.0)],
                                 "loc_id int, address string, lat double, long double")
    preds, unsupported = J.score(locs, str(tmp_path / "model"))
    assert preds.count() == 13 and [r["loc_id"] for r in unsupported.collect()] == [2]


def test_incremental_summaries_equal_full_rebuild(spark, tmp_path):
    tm = type_map_df(spark)

    def socrata(recs_path):
        return FD.adapt_socrata(S.read_json_array(spark, str(recs_path)), tm, on_unmapped="reject")

    recs = _socrata_records()
    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text(json.dumps(recs[:70]))
    # second load: new rows in new and in already loaded (city, year) partitions
    b.write_text(json.dumps(recs[60:] + [dict(recs[0], address_1="new place")]))
    inc_cat = Catalog(spark, str(tmp_path / "inc"))
    J.load_feed(inc_cat, socrata(a), "a")
    J.refresh_summaries(inc_cat)                       # first call: full build of the cube
    J.load_feed(inc_cat, socrata(b), "b")
    J.refresh_summaries(inc_cat)                       # second call: only the load's change
    full_cat = Catalog(spark, str(tmp_path / "full"))
    J.load_feed(full_cat, socrata(a), "a")
    J.load_feed(full_cat, socrata(b), "b")
    J.rebuild_summaries(full_cat)
    for t in J.SUMMARY_TABLES:
        x = sorted(map(tuple, inc_cat.read(t).collect()), key=repr)
        y = sorted(map(tuple, full_cat.read(t).collect()), key=repr)
        assert x == y, t
