"""Golden tests: hand-made records per feed (FIXTURES.md) through the
file readers and adapters, checked row by row."""

import json

import pytest

from blotter.lookups import CRIME_TYPE_ROWS, type_map_df
from blotter.operators import feeds as FD
from blotter.sources import files as S


@pytest.fixture(scope="module")
def tm(spark):
    return type_map_df(spark)


def _rows(df, cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_type_map_csv_reader(spark, tmp_path):
    p = tmp_path / "crime_types.csv"
    p.write_text("".join(f"{a},{b}\n" for a, b in CRIME_TYPE_ROWS))
    df = S.read_type_map_csv(spark, str(p))
    got = {tuple(r) for r in df.collect()}
    assert len(got) == 99 and got == set(CRIME_TYPE_ROWS)
    # case-sensitive keys are distinct rows
    d = dict(got)
    assert d["Theft OF Vehicle"] == "Theft Over" and d["Theft of Vehicle"] == "Auto Theft"
    assert d["Kidnap"] == "Missing Person" and d["Missing Person"] == "Kidnap"


def test_vancouver(spark, tmp_path, tm):
    p = tmp_path / "van.csv"
    p.write_text("subtype,year,month,day,hour,minute,hundred_block,neighbourhood,X,Y\n"
                 "Theft of Vehicle,2018,5,1,14,0,1XX Main,Downtown,491000.0,5459000.0\n"
                 "Mischief,2013,1,1,,,OFFSET,,0.0,0.0\n"
                 "Theft of Vehicle,2019,7,2,3,0,2XX Pine,West End,0.0,5459000.0\n"
                 "Not In Map,2019,12,3,18,0,3XX Oak,Sunset,491000.0,5459000.0\n")
    raw = S.read_csv_with_header(spark, str(p))
    res = FD.adapt_vancouver(raw, tm)
    kept = res.kept.collect()
    assert len(kept) == 3                                  # X == 0 row appears once
    by = {(r["crimesub_type"], r["year"]): r for r in kept}
    a = by[("Theft of Vehicle", 2018)]
    assert a["crime_type"] == "Auto Theft" and a["city"] == "Vancouver" and a["count"] == 1
    assert round(a["lat"], 6) == 49.283686 and round(a["long"], 6) == -123.123752
    m = by[("Mischief", 2013)]
    assert m["crime_type"] == "Robbery" and m["lat"] is None and m["hour"] is None
    assert by[("Theft of Vehicle", 2019)]["lat"] is None
    rej = res.rejected.collect()
    assert [(r["crimesub_type"], r["reason"]) for r in rej] == [("Not In Map", "unmapped_type")]
    # parity option: missing hour filled with 0
    res0 = FD.adapt_vancouver(raw, tm, fill_missing_hour=True, key="none")
    assert {r["hour"] for r in res0.kept.collect() if r["crimesub_type"] == "Mischief"} == {0}
    # keys: one per row, stable across runs
    k1 = sorted(r["uuid"] for r in kept)
    k2 = sorted(r["uuid"] for r in FD.adapt_vancouver(raw, tm).kept.collect())
    assert len(set(k1)) == 3 and k1 == k2


def test_calgary(spark, tmp_path, tm):
    recs = [
        {"community_name": "Beltline", "category": "Assault (Non-domestic)", "count": "3", "year": "2018",
         "date": "2018-02-01T00:00:00.000", "geocoded_column": {"latitude": "51.05", "longitude": "-114.07"}},
        {"community_name": "Beltline", "category": "Street Robbery", "count": "1", "year": "2019",
         "date": "not a date", "geocoded_column": {"latitude": "51.05", "longitude": "-114.07"}},
        {"community_name": "Beltline", "category": "Unknown Category", "count": "2", "year": "2018",
         "date": "2018-03-01T00:00:00.000", "geocoded_column": None},
    ]
    p = tmp_path / "cal.json"
    p.write_text("\n".join(json.dumps(r) for r in recs))
    res = FD.adapt_calgary(S.read_records_json(spark, str(p)), tm, key="none")
    got = _rows(res.kept, ["crime_type", "crimesub_type", "year", "month", "hour", "count", "lat", "long"])
    assert got == sorted([("Assault", "Assault (Non-domestic)", 2018, 2, 0, 3, 51.05, -114.07),
                          ("Robbery", "Street Robbery", 2019, None, None, 1, 51.05, -114.07)], key=repr)
    assert [r["crimesub_type"] for r in res.rejected.collect()] == ["Unknown Category"]


def test_toronto(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"MCI": "Assault", "offence": "Assault With Weapon", "reportedhour": 18,
                                           "reportedmonth": "September", "reportedyear": 2016, "Lat": 43.65,
                                           "Long": -79.38, "Neighbourhood": "Annex", "Unused": "x"}},
        {"type": "Feature", "properties": {"MCI": "Robbery", "offence": "Robbery - Other", "reportedhour": 19,
                                           "reportedmonth": None, "reportedyear": 2016, "Lat": 43.7,
                                           "Long": -79.4, "Neighbourhood": "Rosedale"}}]}
    p = tmp_path / "tor.geojson"
    p.write_text(json.dumps(doc, indent=2))
    res = FD.adapt_toronto(S.read_geojson_features(spark, str(p)), key="none")
    got = _rows(res.kept, ["city", "crime_type", "crimesub_type", "hour", "month", "year", "count"])
    assert got == sorted([("Toronto", "Assault", "Assault With Weapon", 18, 9, 2016, 1),
                          ("Toronto", "Robbery", "Robbery - Other", 19, None, 2016, 1)], key=repr)
    # line-delimited features give the same rows
    p2 = tmp_path / "tor.jsonl"
    p2.write_text("\n".join(json.dumps(f) for f in doc["features"]))
    res2 = FD.adapt_toronto(S.read_geojson_features(spark, str(p2), line_delimited=True), key="none")
    assert _rows(res2.kept, ["crime_type", "month"]) == _rows(res.kept, ["crime_type", "month"])


def test_socrata(spark, tmp_path, tm):
    recs = [
        {"incident_datetime": "2017-12-31T23:10:00.000", "address_1": "1 Elgin", "city": "Ottawa",
         "latitude": "45.42", "longitude": "-75.69", "hour_of_day": "23", "parent_incident_type": "Traffic"},
        {"incident_datetime": "2017-06-01T06:00:00.000", "address_1": "2 Douglas", "city": "Victoria",
         "latitude": "48.43", "longitude": "-123.36", "hour_of_day": "6", "parent_incident_type": "Theft from Vehicle"},
        {"incident_datetime": "2017-06-01T06:00:00.000", "address_1": "3 Main", "city": "Lethbridge",
         "latitude": "abc", "longitude": "-112.84", "hour_of_day": "x", "parent_incident_type": "Alarm"},
        {"incident_datetime": "2017-06-01T06:00:00.000", "address_1": "4 Bank", "city": "Ottawa",
         "latitude": "45.42", "longitude": "-75.69", "hour_of_day": "7", "parent_incident_type": "Unlisted"},
    ]
    p = tmp_path / "ott.json"
    p.write_text(json.dumps(recs))
    res = FD.adapt_socrata(S.read_json_array(spark, str(p)), tm, key="none")
    got = _rows(res.kept, ["city", "crime_type", "year", "month", "hour", "lat", "count", "neighbourhood"])
    assert got == sorted([("Ottawa", "Social Disorder", 2017, 12, 23, 45.42, 1, "1 Elgin"),
                          ("Victoria", "Theft Over", 2017, 6, 6, 48.43, 1, "2 Douglas"),
                          ("Lethbridge", "False Alarm", 2017, 6, None, None, 1, "3 Main")], key=repr)


def test_edmonton(spark, tmp_path, tm):
    recs = [
        {"neighbourhood": "Downtown", "month": "4", "quarter": "Q2", "year": "2016",
         "crimesub_type": "Break and Enter", "count": "5"},
        {"neighbourhood": "Nowhere", "month": "4", "quarter": "Q2", "year": "2016", "crimesub_type": "Assault",
         "count": "1"},
        {"neighbourhood": "Half", "month": "4", "quarter": "Q2", "year": "2016", "crimesub_type": "Assault",
         "count": "1"},
        {"neighbourhood": "Brand New", "year": "2016", "month": "4", "quarter": "Q2", "crimesub_type": "Robbery",
         "count": "2"},
    ]
    p = tmp_path / "edm.json"
    p.write_text("\n".join(json.dumps(r) for r in recs))
    gaz = spark.createDataFrame([("Downtown, Edmonton, Canada", 53.54, -113.49),
                                 ("Nowhere, Edmonton, Canada", 0.0, 0.0),
                                 ("Half, Edmonton, Canada", 53.5, 0.0)], "locality string, lat double, long double")
    places = spark.createDataFrame([("Brand New, Edmonton, Canada", 53.6, -113.4)],
                                   "locality string, lat double, long double")
    res = FD.adapt_edmonton(S.read_all_string_records(spark, str(p)), tm, gaz, places, key="none")
    got = _rows(res.kept, ["neighbourhood", "crime_type", "hour", "count", "lat", "long"])
    assert got == sorted([("Downtown", "Break and Enter", 0, 5, 53.54, -113.49),
                          ("Brand New", "Robbery", 0, 2, 53.6, -113.4)], key=repr)
    assert _rows(res.rejected, ["neighbourhood", "reason"]) == [("Half", "no_location"), ("Nowhere", "no_location")]
    g = {r["locality"]: (r["lat"], r["long"]) for r in res.gazetteer.collect()}
    assert g["Brand New, Edmonton, Canada"] == (53.6, -113.4) and len(g) == 4


def test_union_of_feeds_is_order_independent(spark, tmp_path, tm):
    from blotter.operators.upsert import union_all
    a = spark.createDataFrame([("x", 1)], "crime_type string, count int")
    b = spark.createDataFrame([(2, "y")], "count int, crime_type string")
    assert sorted(map(tuple, union_all([a, b]).collect())) == sorted(map(tuple, union_all([b, a]).select("crime_type", "count").collect()))


def test_header_csv_binds_by_name(spark, tmp_path, tm):
    p = tmp_path / "van_reordered.csv"
    p.write_text("Y,X,neighbourhood,hundred_block,minute,hour,day,month,year,subtype\n"
                 "5459000.0,491000.0,Downtown,1XX Main,0,14,1,5,2018,Theft of Vehicle\n"
                 "5459000.0,491000.0,Downtown,1XX Main,0,notanhour,1,5,2018,Theft of Vehicle\n")
    raw = S.read_csv_with_header(spark, str(p))
    assert raw.columns == ["subtype", "year", "month", "day", "hour", "minute", "hundred_block",
                           "neighbourhood", "X", "Y"]
    rows = FD.adapt_vancouver(raw, tm, key="none").kept.collect()
    assert {r["hour"] for r in rows} == {14, None}
    assert all(round(r["lat"], 6) == 49.283686 for r in rows)
    bad = tmp_path / "bad.csv"
    bad.write_text("subtype,year\nx,2018\n")
    with pytest.raises(ValueError):
        S.read_csv_with_header(spark, str(bad))


def test_calgary_geocode_as_map(spark, tm):
    # records inferred from API dicts carry the geocode as a map, not a struct
    raw = spark.createDataFrame(
        [("Beltline", "Assault (Non-domestic)", "3", "2018", "2018-02-01T00:00:00.000",
          {"latitude": "51.05", "longitude": "-114.07"})],
        "community_name string, category string, count string, year string, date string, "
        "geocoded_column map<string,string>")
    r = FD.adapt_calgary(raw, tm, key="none").kept.first()
    assert (r["lat"], r["long"], r["crime_type"]) == (51.05, -114.07, "Assault")
