"""Stand-in inputs built from the driver's tables.

The driver's tables hold no incidents, so the operators run on views that
Spark derives from them (their work grows with the tables):

* ``v1``  -- lineitem x supplier x nation x part as an incident table
  (volume; years 1995-2001, 25 "cities").
* ``v2``  -- events x customer x nation (real hours from timestamps).
* raw feed layouts for every adapter, derived from events / orders /
  lineitem, so the adapters parse strings, structs and metres as they
  would on landed files.

Lookups used here are small inline tables whose size is fixed by this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fixed_broadcast

# FIXED VALUES: stand-in type map for event types. 'signup' is absent so
# that left and inner joins differ; 'Click' proves case-sensitive matching.
EVENT_TYPE_ROWS = [("click", "Navigation"), ("view", "Navigation"), ("purchase", "Commerce"),
                   ("error", "Fault"), ("Click", "Wrong")]

# FIXED VALUES: stand-in type map for part types ('SMALL' is unmapped).
PART_TYPE_ROWS = [("STANDARD", "Standard"), ("ECONOMY", "Budget"), ("MEDIUM", "Standard"),
                  ("PROMO", "Budget"), ("LARGE", "Bulk")]

# FIXED VALUES: stand-in type codes for V1's crime_type ('SMALL' has none).
PART_CODE_ROWS = [(1, "STANDARD"), (2, "ECONOMY"), (3, "MEDIUM"), (4, "PROMO"), (5, "LARGE")]

# FIXED VALUES: stand-in excluded cities and year window for V1 / V2.
V1_HOUR_EXCLUDED = ["NATION_3", "NATION_4"]
V1_DAYLIGHT_EXCLUDED = ["NATION_4"]
V1_YEARS = (1995, 2000)
V2_YEARS = (2023, 2024)
# FIXED VALUES: stand-in supported cities for the address gate.
GATE_CITIES = ["NATION_1", "NATION_3", "NATION_5", "NATION_7", "NATION_11", "NATION_13", "NATION_17"]


# FIXED VALUES: the layouts of the driver's tables, so that no footer is read to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name``."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def nation(spark, sf_dir) -> DataFrame:
    """25 rows at every scale factor (fixed by the TPC-H specification), so
    it is broadcast outright; supplier and part grow and are left to the
    planner."""
    return fixed_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))


def v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident-shaped view over lineitem (one row per line item)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    na = nation(spark, sf_dir).select("n_nationkey", "n_name")
    # supplier and part grow with the data: no hint, the planner sizes them
    # (broadcast under the threshold, sort-merge above, AQE re-plans).
    # The fact table joins each dimension in turn, so it is always the
    # streamed side; a dimension-dimension join first would get a product-
    # of-inputs size estimate and could flip the fact into the build side.
    x = (li.join(su, li["l_suppkey"] == su["s_suppkey"])
           .join(na, F.col("s_nationkey") == na["n_nationkey"])
           .join(pa, li["l_partkey"] == pa["p_partkey"]))
    return x.select(
        F.col("n_name").alias("city"), F.col("p_type").alias("crime_type"),
        F.col("p_brand").alias("crimesub_type"), F.col("p_name").alias("neighbourhood"),
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        (F.col("l_orderkey") % 24).cast("int").alias("hour"),
        F.col("l_quantity").cast("int").alias("count"),
        "l_orderkey", "l_partkey", "l_suppkey")


def v1_located(spark, sf_dir) -> DataFrame:
    """V1 plus synthetic coordinates: some null, some (0,0), some half-zero."""
    v = v1(spark, sf_dir)
    lat = (F.when(F.col("l_suppkey") % 11 == 0, F.lit(None).cast("double"))
            .when(F.col("l_suppkey") % 7 == 0, F.lit(0.0))
            .otherwise(F.lit(49.0) + F.col("l_partkey") / 7919.0))
    lon = (F.when(F.col("l_suppkey") % 7 == 0, F.lit(0.0))
            .when(F.col("l_partkey") % 13 == 0, F.lit(0.0))
            .otherwise(F.lit(-123.0) - F.col("l_partkey") / 6073.0))
    return v.withColumn("lat", lat).withColumn("long", lon)


def v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-shaped view with real timestamps (one row per event)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    na = nation(spark, sf_dir).select("n_nationkey", "n_name")
    x = (ev.join(cu, ev["user_id"] == cu["c_custkey"])
           .join(na, F.col("c_nationkey") == na["n_nationkey"]))
    return x.select(
        "event_id", "user_id", "ts", "value", "props", "c_name", "c_mktsegment", "c_acctbal", "c_custkey",
        F.col("n_name").alias("city"), F.col("event_type").alias("crimesub_type"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.hour("ts").alias("hour"),
        F.lit(1).alias("count"))


def customer_metres(spark, sf_dir) -> DataFrame:
    """Synthetic UTM metres per customer (X = 0 marks a withheld place)."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    x = F.when(k % 10 == 0, F.lit(0.0)).otherwise((F.lit(483000) + (k * 37) % 16000).cast("double"))
    y = (F.lit(5449000) + (k * 53) % 14000).cast("double")
    return cu.withColumn("X", x).withColumn("Y", y)


def loc_lat(acctbal="c_acctbal"):
    """A customer's synthetic latitude (degrees) from its account balance."""
    return F.lit(49.0) + F.col(acctbal) / 20000.0


def loc_long(acctbal="c_acctbal"):
    return F.lit(-123.0) - F.col(acctbal) / 30000.0


def customer_locations(spark, sf_dir) -> DataFrame:
    """One location per customer: id, address text, lat/long in degrees."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    na = nation(spark, sf_dir).select("n_nationkey", "n_name")
    c = cu.join(na, cu["c_nationkey"] == na["n_nationkey"])
    return c.select(
        F.col("c_custkey").alias("loc_id"),
        F.concat_ws(", ", "c_name", "n_name", F.lit("Canada")).alias("address"),
        loc_lat().alias("lat"), loc_long().alias("long"))


def part_places(spark, sf_dir, resolver: bool = False) -> DataFrame:
    """Reference place table keyed by ``<p_name>, Edmonton, Canada``.

    The gazetteer (``resolver=False``) leaves '* gizmo' out and holds
    'red *' as not found (0, 0) and 'blue *' as half-zero; the resolver
    (``resolver=True``) knows every name, with other coordinates.
    """
    pa = table(spark, sf_dir, "part").select("p_name", "p_size")
    name = F.col("p_name")
    if resolver:
        g = pa.groupBy("p_name").agg(F.max("p_size").alias("s"))
        lat = F.lit(53.5) + F.col("s").cast("double") / 1000.0
        lon = F.lit(-113.5) - F.col("s").cast("double") / 1000.0
    else:
        g = pa.filter(~name.like("% gizmo")).groupBy("p_name").agg(F.min("p_size").alias("s"))
        lat = F.when(name.like("red %"), F.lit(0.0)).otherwise(F.lit(53.0) + F.col("s").cast("double") / 100.0)
        lon = (F.when(name.like("red %") | name.like("blue %"), F.lit(0.0))
                .otherwise(F.lit(-113.0) - F.col("s").cast("double") / 100.0))
    return g.select(F.concat(name, F.lit(", Edmonton, Canada")).alias("locality"),
                    lat.alias("lat"), lon.alias("long"))


# ---- raw feed layouts -------------------------------------------------------

def _iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def raw_vancouver(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    m = customer_metres(spark, sf_dir)
    x = ev.join(m, ev["user_id"] == m["c_custkey"])
    return x.select(
        F.col("event_type").alias("subtype"), F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.when(F.hour("ts") == 5, F.lit(None).cast("int")).otherwise(F.hour("ts")).alias("hour"),
        F.minute("ts").alias("minute"), F.col("c_name").alias("hundred_block"),
        F.col("c_mktsegment").alias("neighbourhood"), "X", "Y")


def raw_calgary(spark, sf_dir) -> DataFrame:
    x = v2(spark, sf_dir).withColumn("lat", loc_lat()).withColumn("long", loc_long())
    bad_date = F.col("event_id") % 41 == 0
    geo = F.when(F.col("c_custkey") % 9 == 0, F.lit(None)).otherwise(F.struct(
        F.col("lat").cast("string").alias("latitude"), F.col("long").cast("string").alias("longitude")))
    return x.select(
        F.col("c_mktsegment").alias("community_name"), F.col("crimesub_type").alias("category"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
         .otherwise((F.col("user_id") % 3 + 1).cast("string")).alias("count"),
        F.col("year").cast("string").alias("year"),
        F.when(bad_date, F.lit("not a date")).otherwise(_iso(F.col("ts"))).alias("date"),
        geo.alias("geocoded_column"))


def raw_toronto_features(spark, sf_dir) -> DataFrame:
    """Rows shaped like GeoJSON features: {type, properties{...}}."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    x = (o.join(cu, o["o_custkey"] == cu["c_custkey"])
          .withColumn("lat", loc_lat()).withColumn("long", loc_long()))
    mname = F.date_format("o_orderdate", "MMMM")
    props = F.struct(
        F.col("o_orderpriority").alias("MCI"), F.col("o_orderstatus").alias("offence"),
        (F.col("o_orderkey") % 24).cast("bigint").alias("reportedhour"),
        F.when(mname == "March", F.lit(None)).otherwise(mname).alias("reportedmonth"),
        F.year("o_orderdate").cast("bigint").alias("reportedyear"),
        F.col("lat").alias("Lat"), F.col("long").alias("Long"),
        F.col("c_mktsegment").alias("Neighbourhood"))
    return x.select(F.lit("Feature").alias("type"), props.alias("properties"))


def raw_socrata(spark, sf_dir) -> DataFrame:
    x = v2(spark, sf_dir).withColumn("lat", loc_lat()).withColumn("long", loc_long())
    return x.select(
        _iso(F.col("ts")).alias("incident_datetime"), F.col("c_name").alias("address_1"), "city",
        F.when(F.col("c_custkey") % 13 == 0, F.lit("abc")).otherwise(F.col("lat").cast("string")).alias("latitude"),
        F.col("long").cast("string").alias("longitude"),
        F.when(F.col("event_id") % 17 == 0, F.lit("x")).otherwise(F.col("hour").cast("string")).alias("hour_of_day"),
        F.col("crimesub_type").alias("parent_incident_type"))


def raw_edmonton(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    x = li.join(pa, li["l_partkey"] == pa["p_partkey"])
    return x.select(
        F.col("p_name").alias("neighbourhood"), F.month("l_shipdate").cast("string").alias("month"),
        F.quarter("l_shipdate").cast("string").alias("quarter"), F.year("l_shipdate").cast("string").alias("year"),
        F.col("p_type").alias("crimesub_type"), F.col("l_quantity").cast("int").cast("string").alias("count"))


def grid_offsets(steps: int = 10) -> list[int]:
    return [k for k in range(-steps, steps + 1) if k != 0]
