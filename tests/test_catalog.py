from blotter.sources.catalog import Catalog


def test_versions_upsert_and_partition_merge(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    a = spark.createDataFrame([("u1", "Calgary", 1), ("u2", "Ottawa", 2)], "uuid string, city string, count int")
    a = a.withColumn("year", a["count"] * 0 + 2015)
    cat.write("incidents", a)
    assert cat.versions("incidents") == [1]
    b = spark.createDataFrame([("u2", "Ottawa", 20), ("u3", "Ottawa", 3)], "uuid string, city string, count int")
    b = b.withColumn("year", b["count"] * 0 + 2015)
    cat.merge_partitions("incidents", b, ["uuid"])
    got = sorted((r["uuid"], r["city"], r["count"]) for r in cat.read("incidents").collect())
    assert got == [("u1", "Calgary", 1), ("u2", "Ottawa", 20), ("u3", "Ottawa", 3)]
    # replaying the same batch changes nothing
    cat.merge_partitions("incidents", b, ["uuid"])
    assert sorted((r["uuid"], r["count"]) for r in cat.read("incidents").collect()) == \
        [("u1", 1), ("u2", 20), ("u3", 3)]
    # a city reload replaces that city only; other partitions are not rewritten
    data = tmp_path / "wh" / "incidents" / "data"
    ott_files = sorted(str(p) for p in data.glob("*/city=Ottawa/**/*.parquet"))
    c = spark.createDataFrame([("u9", "Calgary", 9)], "uuid string, city string, count int")
    c = c.withColumn("year", c["count"] * 0 + 2015)
    cat.replace_partitions("incidents", c)
    assert cat.versions("incidents") == [1, 2, 3, 4]
    assert sorted(r["uuid"] for r in cat.read("incidents").collect()) == ["u2", "u3", "u9"]
    assert sorted(str(p) for p in data.glob("*/city=Ottawa/**/*.parquet")) == ott_files


def test_city_reload_drops_years_no_longer_in_feed(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    schema = "uuid string, city string, year int, count int"
    cat.write("incidents", spark.createDataFrame(
        [("a", "St. John's/East", 2015, 1), ("b", "St. John's/East", 2016, 1), ("c", "St. John's/East", None, 1),
         ("d", "Ottawa", 2015, 1)], schema))
    cat.replace_partitions("incidents", spark.createDataFrame([("e", "St. John's/East", 2016, 5)], schema))
    got = sorted((r["uuid"], r["city"], r["year"]) for r in cat.read("incidents").collect())
    assert got == [("d", "Ottawa", 2015), ("e", "St. John's/East", 2016)]


def test_upsert_unpartitioned(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    g = spark.createDataFrame([("A", 1.0, 2.0)], "locality string, lat double, long double")
    cat.upsert("gazetteer", g, ["locality"])
    g2 = spark.createDataFrame([("A", 3.0, 4.0), ("B", 5.0, 6.0)], "locality string, lat double, long double")
    cat.upsert("gazetteer", g2, ["locality"])
    assert sorted(tuple(r) for r in cat.read("gazetteer").collect()) == [("A", 3.0, 4.0), ("B", 5.0, 6.0)]
    assert cat.versions("gazetteer") == [1, 2]


def test_vacuum_keeps_newest_versions(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    for i in range(4):
        cat.write("crimes_typ", spark.createDataFrame([("T", i)], "crime_type string, count bigint"))
    removed = cat.vacuum("crimes_typ", keep=2)
    assert len(removed) == 2 and cat.versions("crimes_typ") == [3, 4]
    assert cat.read("crimes_typ").first()["count"] == 3
