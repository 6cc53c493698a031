"""Tables kept over time: partitions, recovery, races, keys, and what a bad row may do."""

from pyspark.sql import functions as F

from blotter.functions import round_half_up
from blotter.operators import model as M
from blotter.operators.feeds import FeedResult, adapt_edmonton, adapt_vancouver
from blotter.operators.keys import numbered_rows
from blotter.plans import jobs as J
from blotter.schemas import EDMONTON_SCHEMA, GAZETTEER_SCHEMA, INCIDENT_COLUMNS, INCIDENT_SCHEMA, VANCOUVER_SCHEMA
from blotter.sources.catalog import Catalog


def _rows(spark, *items):
    """(uuid, city, year, count) -> incident rows."""
    base = dict.fromkeys(INCIDENT_COLUMNS)
    return spark.createDataFrame([tuple((base | {"uuid": u, "city": c, "year": y, "count": n, "crime_type": "T"}).values())
                                  for u, c, y, n in items], INCIDENT_SCHEMA)


def _got(cat):
    return sorted((r["uuid"], r["city"], r["year"], r["count"]) for r in cat.read("incidents").collect())


def test_null_empty_and_digit_cities(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    cat.merge_partitions("incidents", _rows(spark, ("n1", None, 2015, 1), ("o1", "=x", 2015, 1)), ["uuid"])
    cat.merge_partitions("incidents", _rows(spark, ("e1", "", 2015, 1), ("o2", "a", None, 1)), ["uuid"])
    cat.merge_partitions("incidents", _rows(spark, ("a", "007", 2015, 1)), ["uuid"])
    cat.merge_partitions("incidents", _rows(spark, ("a", "007", 2015, 2), ("b", "007", None, 1), ("c", "7", 2015, 1)), ["uuid"])
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    got = sorted(((r["uuid"], r["city"], r["year"], r["count"]) for r in cat.read("incidents").collect()), key=key)
    assert got == sorted([("n1", None, 2015, 1), ("o1", "=x", 2015, 1), ("e1", "", 2015, 1), ("o2", "a", None, 1),
                          ("a", "007", 2015, 2), ("b", "007", None, 1), ("c", "7", 2015, 1)], key=key)
    assert cat.read("incidents").schema == INCIDENT_SCHEMA


def test_merge_of_many_partitions_plans(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    one = _rows(spark, ("k", "c", 2000, 1))
    many = spark.range(1200).select(
        *[F.concat(F.lit("c"), (F.col("id") % 60).cast("string")).alias(c) if c == "city" else
          (F.lit(2000) + F.floor(F.col("id") / 60)).cast("int").alias(c) if c == "year" else
          F.col("id").cast("string").alias(c) if c == "uuid" else F.lit(None).cast(INCIDENT_SCHEMA[c].dataType).alias(c)
          for c in INCIDENT_COLUMNS]).coalesce(1)
    cat.merge_partitions("incidents", one, ["uuid"])
    cat.merge_partitions("incidents", many, ["uuid"])
    cat.merge_partitions("incidents", many, ["uuid"], unique=True)
    assert cat.read("incidents").count() == 1201


def test_reload_from_the_table_itself(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    cat.write("incidents", _rows(spark, ("a", "x", 2015, 1), ("b", "x", 2016, 1), ("c", "y", 2016, 1)))
    cat.replace_partitions("incidents", cat.read("incidents").filter("city = 'x' and year = 2015"))
    assert _got(cat) == [("a", "x", 2015, 1), ("c", "y", 2016, 1)]


def test_refresh_during_a_load_loses_nothing(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))

    def result(*items):
        return FeedResult(_rows(spark, *items).withColumn("reason", F.lit(None).cast("string")), key="none")

    J.load_feed(cat, result(("a", "x", 2015, 1)), "l1")
    J.refresh_summaries(cat)

    class Racing(Catalog):
        def merge_partitions(self, *a, **k):
            J.refresh_summaries(cat)          # a refresh before the rows change
            return super().merge_partitions(*a, **k)

    J.load_feed(Racing(spark, str(tmp_path)), result(("b", "x", 2015, 1)), "l2")
    J.refresh_summaries(cat)
    assert [r["count"] for r in cat.read("crimes_yoy").collect()] == [2]


def test_replace_mode_drops_withdrawn_years_from_the_summaries(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))

    def load(load_id, *items):
        J.load_feed(cat, FeedResult(_rows(spark, *items).withColumn("reason", F.lit(None).cast("string")), key="none"), load_id, mode="replace")
        J.refresh_summaries(cat)

    load("s1", ("a", "x", 2015, 1), ("b", "x", 2016, 4))
    load("s2", ("a", "x", 2015, 3))
    assert _got(cat) == [("a", "x", 2015, 3)]
    assert [(r["year"], r["count"]) for r in cat.read("crimes_yoy").collect()] == [(2015, 3)]


def test_key_does_not_follow_a_corrected_lookup(spark, tmp_path):
    raw = spark.createDataFrame([("DOWNTOWN", "Theft", "2016", "5", "7")],
                                "neighbourhood string, crimesub_type string, year string, month string, count string")
    raw = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EDMONTON_SCHEMA.fields])
    tm = spark.createDataFrame([("Theft", "T"), ("Theft", "A")], "sub_type string, type string")   # a doubled key
    cat = Catalog(spark, str(tmp_path))
    for lat in (53.5, 53.6):
        places = spark.createDataFrame([("DOWNTOWN, Edmonton, Canada", lat, -113.5)] * 2, GAZETTEER_SCHEMA)
        res = adapt_edmonton(raw, tm, spark.createDataFrame([], GAZETTEER_SCHEMA), places)
        J.load_feed(cat, res, f"e{lat}")
    rows = cat.read("incidents").collect()
    assert [(r["count"], r["lat"], r["crime_type"]) for r in rows] == [(7, 53.6, "T")]


def test_impossible_coordinates_are_rejected(spark):
    assert spark.createDataFrame([(1e12,), (float("nan"),), (1.23456,)], "x double").select(round_half_up("x", 4)).collect()[2][0] == 1.2346
    raw = spark.createDataFrame([("Theft", 2016, 1, 1, "n", 491000.0, 1e12)], "subtype string, year int, month int, hour int, neighbourhood string, X double, Y double")
    raw = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in VANCOUVER_SCHEMA.fields])
    res = adapt_vancouver(raw, spark.createDataFrame([("Theft", "T")], "sub_type string, type string"))
    assert res.kept.count() == 0 and [r["reason"] for r in res.rejected.collect()] == ["bad_coordinates"]


def test_equal_rows_are_expanded_in_chunks(spark, monkeypatch):
    from blotter.operators import keys
    monkeypatch.setattr(keys, "EXPAND_CHUNK", 7)
    df = spark.createDataFrame([(1, None)] * 50 + [(2, "x")] * 3, "a int, b string")
    got = sorted((r["a"], r["i"]) for r in numbered_rows(df, "i").collect())
    assert got == [(1, i) for i in range(50)] + [(2, i) for i in range(3)]


def test_equal_training_rows_are_spread(spark, monkeypatch):
    seen = {}

    class Pipe:
        def fit(self, df):
            seen["sizes"] = df.groupBy(F.spark_partition_id()).count().collect()
            seen["rows"] = df.count()

    monkeypatch.setattr(M, "build_pipeline", lambda **k: Pipe())
    train = spark.range(20000).select(F.lit(49.1).alias("lat"), F.lit(-123.1).alias("long"), F.lit(2016).alias("year"),
                                      F.lit(3).alias("code"), F.lit(1).alias("count"))
    M.fit(train, partitions=8)
    sizes = [r["count"] for r in seen["sizes"]]
    assert seen["rows"] == 20000 and max(sizes) <= 2 * 20000 / 8
