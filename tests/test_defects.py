"""One regression per defect of the source pipeline that has a behaviour."""

from blotter.lookups import code_table_df, type_map_df
from blotter.operators import feeds as FD
from blotter.operators import locate as L
from blotter.operators import model as M
from blotter.operators import summaries as S
from blotter.operators.upsert import union_all
from blotter.schemas import VANCOUVER_SCHEMA
from blotter.sources.catalog import Catalog


def _gaz(spark, rows):
    return spark.createDataFrame(rows, "locality string, lat double, long double")


def test_q1_new_places_found_before_zero_filter(spark):
    df = spark.createDataFrame([("Brand New",), ("Downtown",)], "neighbourhood string")
    gaz = _gaz(spark, [("Downtown, Edmonton, Canada", 53.54, -113.49)])
    miss = [r["locality"] for r in L.missing_localities(df, gaz).collect()]
    assert miss == ["Brand New, Edmonton, Canada"]
    r = L.refresh_and_enrich(df, gaz, _gaz(spark, [("Brand New, Edmonton, Canada", 53.6, -113.4)]))
    assert sorted(x["neighbourhood"] for x in r.located.collect()) == ["Brand New", "Downtown"]


def test_q2_union_is_by_name(spark):
    a = spark.createDataFrame([(1.0, 2.0, 3, "x")], "lat double, long double, count int, locality string")
    b = spark.createDataFrame([(3, "y", 1.5, 2.5)], "count int, locality string, lat double, long double")
    got = sorted(tuple(r) for r in union_all([a, b]).collect())
    assert got == [(1.0, 2.0, 3, "x"), (1.5, 2.5, 3, "y")]


def test_q3_toronto_counts_one_per_feature(spark):
    props = spark.createDataFrame(
        [(("Assault", "A", 1, "May", 2016, 43.6, -79.4, "N"),)],
        "properties struct<MCI:string,offence:string,reportedhour:bigint,reportedmonth:string,"
        "reportedyear:bigint,Lat:double,Long:double,Neighbourhood:string>")
    inc = FD.adapt_toronto(props, key="none").kept
    assert S.summary_yoy(inc).first()["count"] == 1


def test_q5_q4_reload_is_idempotent(spark, tmp_path):
    raw = spark.createDataFrame([("Theft of Vehicle", 2018, 5, 1, 14, 0, "b", "n", 491000.0, 5459000.0)] * 2,
                                VANCOUVER_SCHEMA)
    cat = Catalog(spark, str(tmp_path / "wh"))
    tm = type_map_df(spark)
    for _ in range(2):
        cat.merge_partitions("incidents", FD.adapt_vancouver(raw, tm).kept, ["uuid"])
    assert cat.read("incidents").count() == 2      # two identical incidents, loaded twice


def test_q7_vancouver_each_row_once(spark):
    rows = [("Theft of Vehicle", 2019, 7, 2, 3, 0, "b", "n", 0.0, 5459000.0),
            ("Theft of Vehicle", 2019, 7, 2, 3, 0, "b", "n", -5.0, -1.0)]
    raw = spark.createDataFrame(rows, VANCOUVER_SCHEMA)
    kept = FD.adapt_vancouver(raw, type_map_df(spark), key="none").kept.collect()
    assert len(kept) == 2 and all(r["lat"] is None for r in kept)


def test_q8_missing_hour_stays_null_and_unknown_label(spark):
    inc = spark.createDataFrame([("C", "T", None, 1)], "city string, crime_type string, hour int, count int")
    assert S.summary_daylight(inc, exclude=[]).first()["daylight"] == "night"        # source semantics
    assert S.summary_daylight(inc, exclude=[], unknown="unknown").first()["daylight"] == "unknown"


def test_q9_null_type_goes_to_rejects(spark):
    raw = spark.createDataFrame([("Not In Map", 2019, 12, 3, 18, 0, "b", "n", 491000.0, 5459000.0)],
                                VANCOUVER_SCHEMA)
    res = FD.adapt_vancouver(raw, type_map_df(spark), key="none")
    assert res.kept.count() == 0 and res.rejected.first()["reason"] == "unmapped_type"
    kept = FD.adapt_vancouver(raw, type_map_df(spark), on_unmapped="keep", key="none").kept
    assert kept.first()["crime_type"] is None


def test_q10_q13_training_has_year_and_drops_null_labels(spark):
    inc = spark.createDataFrame([("Assault", 49.1, -123.1, 2016, None), ("Assault", 49.2, -123.2, 2017, 2)] * 5,
                                "crime_type string, lat double, long double, year int, count int")
    f = M.training_features(inc, code_table_df(spark))
    assert "year" in f.columns
    model = M.fit(f, max_iter=2)                   # null labels filtered, no error
    assert model.transform(f).count() == 10


def test_q15_exclusion_lists_are_parameters(spark):
    inc = spark.createDataFrame([("Calgary", "T", 2015, 1, 3), ("Edmonton", "T", 2015, 1, 4)],
                                "city string, crime_type string, year int, hour int, count int")
    assert S.summary_by_hour(inc).count() == 0
    assert S.summary_by_hour(inc, exclude=["Edmonton"]).first()["count"] == 3


def test_q16_summaries_rebuilt_whole(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    old = spark.createDataFrame([("Gone", 9)], "crime_type string, count bigint")
    cat.write("crimes_typ", old)
    inc = spark.createDataFrame([("C", "T", 2015, 1, 1, 2)],
                                "city string, crime_type string, year int, month int, hour int, count int")
    cat.write("crimes_typ", S.summary_by_type(inc))
    assert [r["crime_type"] for r in cat.read("crimes_typ").collect()] == ["T"]


def test_retry_not_found_places(spark):
    df = spark.createDataFrame([("Nowhere",), ("Downtown",)], "neighbourhood string")
    gaz = _gaz(spark, [("Downtown, Edmonton, Canada", 53.54, -113.49), ("Nowhere, Edmonton, Canada", 0.0, 0.0)])
    places = _gaz(spark, [("Nowhere, Edmonton, Canada", 53.7, -113.3)])
    plain = L.refresh_and_enrich(df, gaz, places)
    assert [r["neighbourhood"] for r in plain.located.collect()] == ["Downtown"]
    assert [r["neighbourhood"] for r in plain.unlocated.collect()] == ["Nowhere"]
    retry = L.refresh_and_enrich(df, gaz, places, retry_not_found=True)
    got = sorted((r["neighbourhood"], r["lat"]) for r in retry.located.collect())
    assert got == [("Downtown", 53.54), ("Nowhere", 53.7)]
    g = {r["locality"]: r["lat"] for r in retry.gazetteer.collect()}
    assert g["Nowhere, Edmonton, Canada"] == 53.7
