"""Named queries over the driver's tables, each with a DuckDB SQL oracle.

Every query reads whole tables (or views Spark derives from them). Columns
are aliased identically on both sides; doubles that pass through
trigonometry, averages or division are rounded via DECIMAL on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..lookups import CRIME_CODE_ROWS, SCORE_CODES
from ..operators import classify as C
from ..operators import feeds as FD
from ..operators import locate as L
from ..operators import model as M
from ..operators import summaries as S
from ..operators.joins import fixed_broadcast
from ..operators.keys import with_content_key
from ..operators.upsert import union_all, upsert_by_key
from ..schemas import (CALGARY_SCHEMA, EDMONTON_SCHEMA, SOCRATA_INCIDENT_SCHEMA,
                       VANCOUVER_SCHEMA)
from ..session import ensure_checkpoint_dir, scratch_folder
from ..sources import files as SRC
from ..sources.catalog import Catalog
from ..sources.ordered import read_ordered, write_ordered
from ..streaming.ingest import start_feed_stream
from . import jobs as J
from . import standins as V
from .replay import replay
from .oracle_sql import SQL


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _tm_events(spark):
    return spark.createDataFrame(V.EVENT_TYPE_ROWS, "sub_type string, type string")


def _tm_parts(spark):
    return spark.createDataFrame(V.PART_TYPE_ROWS, "sub_type string, type string")


def _codes_parts(spark):
    return spark.createDataFrame(V.PART_CODE_ROWS, "code int, type_crime string")


def _r4(c):
    return X.round_half_up(c, 4)


def _r6(c):
    return X.round_half_up(c, 6, work_scale=10)


# ---- A1-A5 summaries ------------------------------------------------------------

def q_summary_yoy(spark, sf):
    return S.summary_yoy(V.v1(spark, sf))


def q_summary_by_type(spark, sf):
    return S.summary_by_type(V.v1(spark, sf), V.V1_YEARS)


def q_summary_by_hour(spark, sf):
    return S.summary_by_hour(V.v1(spark, sf), V.V1_YEARS, V.V1_HOUR_EXCLUDED)


def q_summary_by_hour_events(spark, sf):
    return S.summary_by_hour(V.v2(spark, sf), V.V2_YEARS, V.V1_HOUR_EXCLUDED)


def q_summary_daylight(spark, sf):
    return S.summary_daylight(V.v1(spark, sf), V.V1_DAYLIGHT_EXCLUDED)


def _season_rounded(df):
    return df.withColumn("avgsum", _r4("avgsum"))


def q_summary_season(spark, sf):
    return _season_rounded(S.summary_season(V.v1(spark, sf), V.V1_YEARS))


def q_daylight_null_hour(spark, sf):
    v = V.v2(spark, sf).withColumn("hour", F.when(F.col("hour") == 5, F.lit(None)).otherwise(F.col("hour")))
    v = v.withColumn("crime_type", F.col("crimesub_type"))
    return S.summary_daylight(v, exclude=[])


def q_season_null_month(spark, sf):
    v = V.v1(spark, sf).withColumn("month", F.when(F.col("month") == 7, F.lit(None)).otherwise(F.col("month")))
    return _season_rounded(S.summary_season(v, V.V1_YEARS))


def q_summary_cube(spark, sf):
    return S.summary_cube(V.v1(spark, sf))


def q_summaries_from_cube_season(spark, sf):
    outs = S.all_summaries(V.v1(spark, sf), V.V1_YEARS, V.V1_HOUR_EXCLUDED, V.V1_DAYLIGHT_EXCLUDED)
    return _season_rounded(outs["crimes_ss"])


# ---- J1-J3, E4 classification --------------------------------------------------

def _v2_classified(spark, sf, policy):
    return C.classify(V.v2(spark, sf), _tm_events(spark), on_unmapped=policy, broadcast="fixed")


def q_classify_left(spark, sf):
    return _v2_classified(spark, sf, C.KEEP).kept.select("event_id", "city", "crimesub_type", "crime_type")


def q_classify_inner(spark, sf):
    return _v2_classified(spark, sf, C.DROP).kept.select("event_id", "city", "crimesub_type", "crime_type")


def q_classify_rejects(spark, sf):
    return C.reject_report(_v2_classified(spark, sf, C.REJECT).rejected)


# ---- J5, J6 + A6 -------------------------------------------------------------------

def q_code_join(spark, sf):
    v = V.v1(spark, sf)
    codes = fixed_broadcast(_codes_parts(spark))
    return (v.join(codes, v["crime_type"] == codes["type_crime"], "inner")
             .select("l_orderkey", "l_partkey", "l_suppkey", "crime_type", "code"))


def q_join_where_condition(spark, sf):
    predict = V.v1(spark, sf).select(
        "year", (F.col("l_partkey") % 5 + 1).cast("int").alias("code"),
        F.col("count").cast("double").alias("prediction"))
    types = _codes_parts(spark)
    return spark.sql(
        "SELECT p.year AS year, t.type_crime AS type, "
        "CAST(ROUND(AVG(p.prediction), 0) AS INT) AS predictions "
        "FROM {predict} p JOIN {types} t WHERE p.code = t.code GROUP BY p.year, t.type_crime",
        predict=predict, types=types)


# ---- G4, J7 grid ------------------------------------------------------------------

def q_grid_cross(spark, sf):
    loc = V.customer_locations(spark, sf).select("loc_id", "lat", "long")
    grid = M.neighbourhood_grid(loc)
    rows = [r for r in CRIME_CODE_ROWS if r[0] in SCORE_CODES]
    return M.with_codes(grid, rows).select("loc_id", "lat", "long", "year", "code")


# ---- X1, A7, G1-G3, J4, J8, K1 --------------------------------------------------

def q_locality_concat(spark, sf):
    return L.localities(V.v1(spark, sf))


def q_distinct_neighbourhoods(spark, sf):
    return V.v1(spark, sf).select("city", "neighbourhood").distinct()


def q_gazetteer_left(spark, sf):
    g = V.part_places(spark, sf)
    return (L.enrich(V.v1(spark, sf), g, unique=True)   # grouped by locality
             .select("l_orderkey", "l_partkey", "l_suppkey", "neighbourhood", "lat", "long"))


def q_gazetteer_missing(spark, sf):
    return L.missing_localities(V.v1(spark, sf), V.part_places(spark, sf))


def q_gazetteer_upsert(spark, sf):
    g2, _ = L.refresh_gazetteer(V.v1(spark, sf), V.part_places(spark, sf),
                                V.part_places(spark, sf, resolver=True), retry_not_found=True)
    return g2


def q_gazetteer_build(spark, sf):
    return L.build_gazetteer(V.v1(spark, sf), V.part_places(spark, sf))


# ---- X10, N1, F2-F6, X4, X2/N2, P4/P5, X5, F11 ----------------------------------

def q_utm_to_latlon(spark, sf):
    m = X.with_utm_latlon(V.customer_metres(spark, sf), "X", "Y", "lat", "long", zone=10)
    return m.select("c_custkey", _r6("lat").alias("lat"), _r6("long").alias("long"))


def q_na_fill_zero(spark, sf):
    ev = V.table(spark, sf, "events").select(
        "event_id", "event_type",
        F.when(F.hour("ts") == 5, F.lit(None)).otherwise(F.hour("ts")).alias("hour"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"))
    return ev.na.fill(0)


def q_zero_coord_filters(spark, sf):
    v = V.v1_located(spark, sf)
    return v.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        X.kept(X.has_lat("lat")).alias("keep_f2"),
        X.kept(X.not_both_zero("lat", "long")).alias("keep_f3"),
        X.kept(X.neither_zero("lat", "long")).alias("keep_f4"),
        X.kept(X.any_positive("lat", "long")).alias("keep_f5"),
        X.kept(X.is_zero("long")).alias("keep_f6"),
        X.kept(X.both_null("lat", "long")).alias("keep_f7"))


def q_month_name_to_number(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    name = F.date_format("o_orderdate", "MMMM")
    o = o.select("o_orderkey", F.when(name == "March", F.lit(None)).otherwise(name).alias("month_name"))
    return o.withColumn("month", X.month_number("month_name"))


def q_iso_string_parts(spark, sf):
    ev = V.table(spark, sf, "events").select("event_id", "ts", "value")
    iso = F.when(F.col("event_id") % 41 == 0, F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    txt = F.when(F.col("event_id") % 13 == 0, F.lit("abc")).otherwise(F.col("value").cast("string"))
    hour_txt = F.when(F.col("event_id") % 17 == 0, F.lit("x")).otherwise(F.hour("ts").cast("string"))
    s = ev.select("event_id", iso.alias("s"), txt.alias("t"), hour_txt.alias("h"))
    return s.select("event_id", X.year_of("s").alias("year"), X.month_of("s").alias("month"),
                    X.hour_of("s").alias("hour"), X.safe_cast("t", "double").alias("value"),
                    X.safe_cast("h", "int").alias("hour_of_day"))


def q_nested_struct_fields(spark, sf):
    ev = V.table(spark, sf, "events").select("event_id", "props")
    s = ev.select("event_id", F.from_json("props", "k int").alias("p"),
                  F.from_json("props", "map<string,int>").alias("m"))
    return s.select("event_id", "p.*", F.col("m")["k"].alias("k_map"))


def q_round_coordinates(spark, sf):
    c = V.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return c.select("c_custkey", _r4(F.col("c_acctbal") / 7.0).alias("lat"),
                    X.round_half_up(F.col("c_acctbal") / 100.0, 3).alias("long"))


def q_any_city_gate(spark, sf):
    return M.gate_locations(V.customer_locations(spark, sf), cities=V.GATE_CITIES).select(
        "loc_id", "address", "supported")


# ---- M1, A9, M2 ---------------------------------------------------------------------

def q_training_features(spark, sf):
    return M.training_features(V.v1_located(spark, sf), _codes_parts(spark), key="none", broadcast="fixed")


def q_rmse_metric(spark, sf):
    v = V.v1(spark, sf).withColumn("prediction", F.col("count") * 0.5 + 3.0)
    r = M.rmse_frame(v, "count", "prediction")
    return r.select(_r6("rmse").alias("rmse"), "n")


def q_key_split(spark, sf):
    return V.v1(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey",
                                  M.split_label("l_orderkey", 60, hashed=False).alias("split"))


def q_content_split(spark, sf):
    """M2: the split that training uses, row by row."""
    f = M.training_features(V.v1_located(spark, sf), _codes_parts(spark), key="none", broadcast="fixed")
    return f.withColumn("split", M.content_split_label(f.schema, [*M.FEATURES, "count"], 60))


def q_gbt_stump(spark, sf):
    """M5, M6, M7, M8: one round of depth one on features of few values, where the bins are exact; its RMSE by the evaluator."""
    f = M.training_features(V.v1_located(spark, sf), _codes_parts(spark), digits=0, key="none", broadcast="fixed")
    train, _ = M.content_split(f, 60)
    ensure_checkpoint_dir(spark)
    train = train.checkpoint(eager=True)
    told = M.fit(train, max_iter=1, max_depth=1).transform(train)
    rmse = F.lit(M.evaluate_rmse(told))
    return told.groupBy(_r6("prediction").alias("prediction")).agg(F.count(F.lit(1)).alias("n")).withColumn("rmse", _r6(rmse))


def q_ordered_summary(spark, sf):
    """O1, A1: the year-on-year summary written in order; each row's place over the files read in order."""
    d = scratch_folder(spark, "ordered")
    write_ordered(S.summary_yoy(V.v1(spark, sf)), d, "city", "crime_type", "year")
    return read_ordered(spark, d)


def q_case_insensitive_names(spark, sf):
    """``lat`` and ``long`` asked for on columns named ``Lat`` and ``LONG``."""
    loc = V.customer_locations(spark, sf).select("loc_id", F.col("lat").alias("Lat"), F.col("long").alias("LONG"))
    return loc.where("lat > 49.1").select("loc_id", _r6("lat").alias("lat"), _r6("long").alias("long"))


def q_gbt_score(spark, sf):
    """Fit on V1 features (content split 60/40), score gated customer locations."""
    feats = M.training_features(V.v1_located(spark, sf), _codes_parts(spark), key="none", broadcast="fixed")
    train, _ = M.content_split(feats, 60)
    model = M.fit(train)
    locs = M.gate_locations(V.customer_locations(spark, sf), cities=V.GATE_CITIES).filter("supported")
    return M.score_locations(locs, model, V.PART_CODE_ROWS)


def q_score_linear(spark, sf):
    """A pipeline of SQL stage (a linear formula) and assembler, saved, loaded, scored.

    The added 0.0003 keeps means of three-digit points off the .5 of rounding.
    """
    stages = [SQLTransformer(statement="SELECT *, code * 10 + lat + CAST(0.0003 AS DOUBLE) AS prediction FROM __THIS__"),
              VectorAssembler(inputCols=M.FEATURES, outputCol="input_features", handleInvalid="skip")]
    locs = V.customer_locations(spark, sf).select("loc_id", "lat", "long")
    path = scratch_folder(spark, "model")
    M.save_model(Pipeline(stages=stages).fit(locs), path)
    return M.score_locations(locs, M.load_model(path), [r for r in CRIME_CODE_ROWS if r[0] in SCORE_CODES])


# ---- X9 content keys, K1 upsert ---------------------------------------------------------

CONTENT = ["city", "crime_type", "crimesub_type", "neighbourhood", "year", "month", "hour", "count"]


def q_content_key_occurrence(spark, sf):
    keyed = with_content_key(V.v1(spark, sf).select(*CONTENT), CONTENT)
    return keyed.select(*CONTENT, F.split("uuid", "-").getItem(1).cast("int").alias("occurrence"))


def q_content_key_differing(spark, sf):
    """Rows that differ beside their content, a third of them of one content: numbers from 0 without gaps."""
    v = V.v1(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "count", F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(
        F.concat_ws("-", "crime_type", "l_partkey")).alias("content"))
    keyed = with_content_key(v, ["content"])
    occ = F.split("uuid", "-").getItem(1).cast("bigint")
    return keyed.groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.min(occ).alias("first"), F.max(occ).alias("last"), F.countDistinct("uuid").alias("n_keys"))


def q_upsert_by_key(spark, sf):
    v = V.v1(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "year", "count")
    old = v.filter(F.col("year") <= 1998)
    new = v.filter(F.col("year") >= 1997).withColumn("count", F.col("count") * 2)
    return upsert_by_key(old, new, ["l_orderkey", "l_partkey", "l_suppkey"])


# ---- C1-C7 feed adapters, U3 union ---------------------------------------------------

def _feed_out(df):
    """Canonical columns minus the key; coordinates rounded for comparison."""
    return df.select("crime_type", "crimesub_type", "city", "year", "month", "hour", "neighbourhood",
                     _r6("lat").alias("lat"), _r6("long").alias("long"), "count")


def _vancouver(spark, sf):
    return FD.adapt_vancouver(V.raw_vancouver(spark, sf), _tm_events(spark), key="none", broadcast="fixed")


def _calgary(spark, sf):
    return FD.adapt_calgary(V.raw_calgary(spark, sf), _tm_events(spark), key="none", broadcast="fixed")


def _toronto(spark, sf):
    return FD.adapt_toronto(V.raw_toronto_features(spark, sf), key="none")


def _socrata(spark, sf):
    return FD.adapt_socrata(V.raw_socrata(spark, sf), _tm_events(spark), key="none", broadcast="fixed")


def _edmonton(spark, sf):
    return FD.adapt_edmonton(V.raw_edmonton(spark, sf), _tm_parts(spark), V.part_places(spark, sf),
                             V.part_places(spark, sf, resolver=True), key="none", broadcast="fixed")


def q_feed_vancouver(spark, sf):
    return _feed_out(_vancouver(spark, sf).kept)


def q_feed_calgary(spark, sf):
    return _feed_out(_calgary(spark, sf).kept)


def q_feed_calgary_rejects(spark, sf):
    return C.reject_report(_calgary(spark, sf).rejected)


def q_feed_toronto(spark, sf):
    return _feed_out(_toronto(spark, sf).kept)


def q_feed_socrata(spark, sf):
    return _feed_out(_socrata(spark, sf).kept)


def q_feed_socrata_rejects(spark, sf):
    r = FD.adapt_socrata(V.raw_socrata(spark, sf), _tm_events(spark), key="none", broadcast="fixed").rejected
    return r.groupBy("reason", "crimesub_type").agg(F.sum("count").cast("bigint").alias("count"))


def q_feed_edmonton(spark, sf):
    return _feed_out(_edmonton(spark, sf).kept)


def q_feed_edmonton_rejects(spark, sf):
    r = _edmonton(spark, sf).rejected
    return r.groupBy("reason", "crimesub_type").agg(F.sum("count").cast("bigint").alias("count"))


def q_union_feeds(spark, sf):
    feeds = [_vancouver, _calgary, _toronto, _socrata, _edmonton]
    return union_all([_feed_out(f(spark, sf).kept) for f in feeds])


# ---- S2-S6 through landed files -------------------------------------------------
# Each raw feed stand-in is written by Spark in its landed format to a fresh
# folder under the shared checkpoint dir, read back through the blotter
# reader and adapted: same expected rows as the in-memory feed query.

def _land(spark, df, fmt: str) -> str:
    d = scratch_folder(spark, "landed")
    if fmt == "csv":
        df.write.mode("errorifexists").option("header", True).csv(d)
    else:
        df.write.mode("errorifexists").json(d)
    return d


def q_landed_vancouver_csv(spark, sf):
    path = _land(spark, V.raw_vancouver(spark, sf), "csv")
    raw = SRC.read_csv_with_header(spark, path, VANCOUVER_SCHEMA)
    return _feed_out(FD.adapt_vancouver(raw, _tm_events(spark), key="none", broadcast="fixed").kept)


def q_landed_calgary_json(spark, sf):
    path = _land(spark, V.raw_calgary(spark, sf), "json")
    raw = SRC.read_records_json(spark, path, CALGARY_SCHEMA)
    return _feed_out(FD.adapt_calgary(raw, _tm_events(spark), key="none", broadcast="fixed").kept)


def q_landed_toronto_geojson(spark, sf):
    path = _land(spark, V.raw_toronto_features(spark, sf), "json")
    feats = SRC.read_geojson_features(spark, path, line_delimited=True)
    return _feed_out(FD.adapt_toronto(feats, key="none").kept)


def q_landed_socrata_json(spark, sf):
    path = _land(spark, V.raw_socrata(spark, sf), "json")
    raw = SRC.read_json_array(spark, path, SOCRATA_INCIDENT_SCHEMA, line_delimited=True)
    return _feed_out(FD.adapt_socrata(raw, _tm_events(spark), key="none", broadcast="fixed").kept)


def q_landed_edmonton_json(spark, sf):
    path = _land(spark, V.raw_edmonton(spark, sf), "json")
    raw = SRC.read_all_string_records(spark, path, EDMONTON_SCHEMA)
    return _feed_out(FD.adapt_edmonton(raw, _tm_parts(spark), V.part_places(spark, sf),
                                       V.part_places(spark, sf, resolver=True), key="none", broadcast="fixed").kept)


def _land_documents(spark, df, head: str, tail: str) -> str:
    """Whole JSON documents of at most 5,000 records, one a file."""
    d = scratch_folder(spark, "landed")
    rows = df.select(F.to_json(F.struct("*")).alias("j"), F.floor(F.monotonically_increasing_id() / 5000).alias("k"))
    docs = rows.groupBy("k").agg(F.concat(F.lit(head), F.array_join(F.collect_list("j"), ","), F.lit(tail)).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(d)
    return d


def q_landed_socrata_document(spark, sf):
    """S3: files that each hold one JSON array."""
    path = _land_documents(spark, V.raw_socrata(spark, sf), "[", "]")
    raw = SRC.read_json_array(spark, path, SOCRATA_INCIDENT_SCHEMA)
    return _feed_out(FD.adapt_socrata(raw, _tm_events(spark), key="none", broadcast="fixed").kept)


def q_landed_toronto_document(spark, sf):
    """Files that each hold one FeatureCollection."""
    path = _land_documents(spark, V.raw_toronto_features(spark, sf), '{"type":"FeatureCollection","features":[', "]}")
    return _feed_out(FD.adapt_toronto(SRC.read_geojson_features(spark, path), key="none").kept)


def q_type_map_csv(spark, sf):
    """A headerless map file with every key doubled, loaded with one row per key, joined to parts."""
    part = V.table(spark, sf, "part")
    types = part.select("p_type").distinct()
    doubled = types.select("p_type", F.concat(F.lit("T "), "p_type")).union(types.select("p_type", F.concat(F.lit("A "), "p_type")))
    d = scratch_folder(spark, "landed")
    doubled.write.csv(d)
    out = C.classify(part.select("p_partkey", F.col("p_type").alias("crimesub_type")), SRC.read_type_map_csv(spark, d), on_unmapped=C.KEEP)
    return out.kept.select("p_partkey", "crimesub_type", "crime_type")


# ---- tables kept over time: each query writes a catalogue of its own in the shared folder ----

def _catalog(spark) -> Catalog:
    return Catalog(spark, scratch_folder(spark, "catalog"))


def _keyed_socrata(spark, sf):
    """The Socrata incidents, keyed, with awkward cities: null, empty, and one of digits."""
    inc = FD.adapt_socrata(V.raw_socrata(spark, sf), _tm_events(spark), broadcast="fixed").kept
    n = F.pmod(F.col("month"), F.lit(5))
    return inc.withColumn("city", F.when(n == 0, F.lit(None).cast("string")).when(n == 1, "").when(n == 2, "007").otherwise(F.col("city")))


def q_catalog_merge(spark, sf):
    """Half the rows loaded, then all of them merged by key."""
    cat, inc = _catalog(spark), _keyed_socrata(spark, sf)
    cat.merge_partitions("incidents", inc.filter("month <= 6").withColumn("count", F.lit(99)), ["uuid"])
    cat.merge_partitions("incidents", inc, ["uuid"], unique=True)
    return _feed_out(cat.read("incidents"))


def q_catalog_city_reload(spark, sf):
    """K3: the digit city replaced by a snapshot derived from the table itself."""
    cat = _catalog(spark)
    cat.write("incidents", _keyed_socrata(spark, sf))
    cat.replace_partitions("incidents", cat.read("incidents").filter("city = '007' and month <= 6"))
    return _feed_out(cat.read("incidents"))


def q_catalog_concurrent_loads(spark, sf):
    """Two loads of the same cities at the same time; both land."""
    cat, inc = _catalog(spark), _keyed_socrata(spark, sf)
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(cat.merge_partitions, "incidents", inc.filter(part), ["uuid"], True) for part in ("month % 2 = 0", "month % 2 = 1")]:
            done.result()
    return _feed_out(cat.read("incidents"))


def _layered_incidents(spark, sf) -> Catalog:
    """Three layers: all rows with wrong counts, some of them replaced, then all of them."""
    cat, inc = _catalog(spark), _keyed_socrata(spark, sf)
    cat.merge_partitions("incidents", inc.withColumn("count", F.lit(99)), ["uuid"])
    cat.merge_partitions("incidents", inc.filter("month <= 6").withColumn("hour", F.lit(-1)), ["uuid"])
    cat.merge_partitions("incidents", inc, ["uuid"], unique=True)
    return cat


def q_catalog_delta_read(spark, sf):
    """Layers merged by key on read."""
    return _feed_out(_layered_incidents(spark, sf).read("incidents"))


def q_catalog_compacted_read(spark, sf):
    """The same layers folded into one."""
    cat = _layered_incidents(spark, sf)
    cat.compact("incidents")
    return _feed_out(cat.read("incidents"))


def _refreshed(spark, sf) -> Catalog:
    """Stored summaries after two loads, the second of which replaces rows of the first, with a refresh after each."""
    cat, inc = _catalog(spark), _keyed_socrata(spark, sf)
    first = inc.filter("month <= 8").withColumn("count", F.lit(7)).withColumn("hour", F.col("month"))
    for load, rows in (("a", first), ("b", inc)):
        J.load_feed(cat, FD.FeedResult(rows.withColumn("reason", F.lit(None).cast("string")), key="none"), load)
        J.refresh_summaries(cat, V.V2_YEARS, ["007"], ["NATION_4"])
    return cat


# FIXED VALUES: an earlier stand-in type map: one type other, one missing, one too many.
EARLIER_TYPES = [("click", "Clicks"), ("view", "Navigation"), ("purchase", "Commerce"), ("signup", "Commerce"), ("Click", "Wrong")]


def _replayed_types(spark, sf) -> Catalog:
    """The Socrata feed loaded with an earlier type map, then replayed for the change to the present one."""
    cat, old = _catalog(spark), spark.createDataFrame(EARLIER_TYPES, "sub_type string, type string")
    J.load_feed(cat, FD.adapt_socrata(V.raw_socrata(spark, sf), old, broadcast="fixed"), "s")
    replay(cat, types=(old, _tm_events(spark)))
    return cat


def q_reclassify_after_map_change(spark, sf):
    """Incidents after the change equal those of a load with the new map."""
    return _feed_out(_replayed_types(spark, sf).read("incidents"))


def q_rejects_after_map_change(spark, sf):
    """So do the rejects."""
    rows = _replayed_types(spark, sf).read("incident_rejects")
    return rows.groupBy("reason", "crimesub_type").agg(F.sum("count").cast("bigint").alias("count"))


def _replayed_places(spark, sf) -> Catalog:
    """The Edmonton feed loaded with an earlier gazetteer (places missing, not found, elsewhere), then replayed."""
    cat, places, raw = _catalog(spark), V.part_places(spark, sf), V.raw_edmonton(spark, sf)
    found = V.part_places(spark, sf, resolver=True)
    # stored, as the job stores it: derived from the feed once, not by every reader
    cat.write("gazetteer", FD.adapt_edmonton(raw, _tm_parts(spark), places, found, key="none", broadcast="fixed").gazetteer)
    now = cat.read("gazetteer")
    n = F.pmod(F.xxhash64("locality"), F.lit(4))
    before = now.where(n != 0).withColumn("lat", F.when(n == 1, 0.0).when(n == 2, F.col("lat") + 1).otherwise(F.col("lat")))
    nowhere = found.where("false")
    J.load_feed(cat, FD.adapt_edmonton(raw, _tm_parts(spark), before, nowhere, broadcast="fixed"), "e")
    replay(cat, places=(before, now), type_map=_tm_parts(spark))
    return cat


def q_relocate_after_gazetteer_change(spark, sf):
    """Incidents after the change equal those of a load with the new gazetteer."""
    return _feed_out(_replayed_places(spark, sf).read("incidents"))


def q_rejects_after_gazetteer_change(spark, sf):
    """So do the rejects."""
    rows = _replayed_places(spark, sf).read("incident_rejects")
    return rows.groupBy("reason", "crimesub_type").agg(F.sum("count").cast("bigint").alias("count"))


def q_stored_by_type(spark, sf):
    """K2, A2: the stored table by type."""
    return _refreshed(spark, sf).read("crimes_typ")


def q_stored_by_hour(spark, sf):
    """K2, A3: the stored table by hour."""
    return _refreshed(spark, sf).read("crimes_hr")


def q_stored_daylight(spark, sf):
    """K2, A4: the stored table by daylight."""
    return _refreshed(spark, sf).read("crimes_dl")


def q_stored_season(spark, sf):
    """K2, A5: the stored table by season."""
    return _season_rounded(_refreshed(spark, sf).read("crimes_ss"))


def q_summaries_incremental(spark, sf):
    """K2, A1: two loads with a refresh after each; the stored year-on-year table."""
    cat, inc = _catalog(spark), _keyed_socrata(spark, sf)
    for load, part in (("a", "month <= 6"), ("b", "month > 6")):
        rows = inc.filter(part).withColumn("reason", F.lit(None).cast("string"))
        J.load_feed(cat, FD.FeedResult(rows, key="none"), load)
        out = J.refresh_summaries(cat)
    assert out
    return cat.read("crimes_yoy")


def q_stream_cut_invariant(spark, sf):
    """The feed landed as several files and streamed one file at a time."""
    cat = _catalog(spark)
    path = f"{cat.root}/landing"
    V.raw_socrata(spark, sf).repartition(3).write.json(path)
    tm = _tm_events(spark)
    start_feed_stream(spark, path, SOCRATA_INCIDENT_SCHEMA, lambda df: FD.adapt_socrata(df, tm, broadcast="fixed"), cat,
                      name=uuid.uuid4().hex, checkpoint=f"{cat.root}/progress", max_files_per_trigger=1).awaitTermination()
    return _feed_out(cat.read("incidents"))


def q_incidents_summary_yoy(spark, sf):
    """A1 over the union of all adapted feeds (the canonical table)."""
    feeds = [_vancouver, _calgary, _toronto, _socrata, _edmonton]
    inc = union_all([f(spark, sf).kept for f in feeds])
    return S.summary_yoy(inc)


QUERIES: list[Query] = [
    Query("summary_yoy", q_summary_yoy, SQL["summary_yoy"]),
    Query("summary_by_type", q_summary_by_type, SQL["summary_by_type"]),
    Query("summary_by_hour", q_summary_by_hour, SQL["summary_by_hour"]),
    Query("summary_by_hour_events", q_summary_by_hour_events, SQL["summary_by_hour_events"]),
    Query("summary_daylight", q_summary_daylight, SQL["summary_daylight"]),
    Query("summary_season", q_summary_season, SQL["summary_season"]),
    Query("daylight_null_hour", q_daylight_null_hour, SQL["daylight_null_hour"]),
    Query("season_null_month", q_season_null_month, SQL["season_null_month"]),
    Query("summary_cube", q_summary_cube, SQL["summary_cube"]),
    Query("summaries_from_cube_season", q_summaries_from_cube_season, SQL["summary_season"]),
    Query("classify_left", q_classify_left, SQL["classify_left"]),
    Query("classify_inner", q_classify_inner, SQL["classify_inner"]),
    Query("classify_rejects", q_classify_rejects, SQL["classify_rejects"]),
    Query("code_join", q_code_join, SQL["code_join"]),
    Query("join_where_condition", q_join_where_condition, SQL["join_where_condition"]),
    Query("grid_cross", q_grid_cross, SQL["grid_cross"]),
    Query("locality_concat", q_locality_concat, SQL["locality_concat"]),
    Query("distinct_neighbourhoods", q_distinct_neighbourhoods, SQL["distinct_neighbourhoods"]),
    Query("gazetteer_build", q_gazetteer_build, SQL["gazetteer_build"]),
    Query("gazetteer_left", q_gazetteer_left, SQL["gazetteer_left"]),
    Query("gazetteer_missing", q_gazetteer_missing, SQL["gazetteer_missing"]),
    Query("gazetteer_upsert", q_gazetteer_upsert, SQL["gazetteer_upsert"]),
    Query("utm_to_latlon", q_utm_to_latlon, SQL["utm_to_latlon"]),
    Query("na_fill_zero", q_na_fill_zero, SQL["na_fill_zero"]),
    Query("zero_coord_filters", q_zero_coord_filters, SQL["zero_coord_filters"]),
    Query("month_name_to_number", q_month_name_to_number, SQL["month_name_to_number"]),
    Query("iso_string_parts", q_iso_string_parts, SQL["iso_string_parts"]),
    Query("nested_struct_fields", q_nested_struct_fields, SQL["nested_struct_fields"]),
    Query("round_coordinates", q_round_coordinates, SQL["round_coordinates"]),
    Query("any_city_gate", q_any_city_gate, SQL["any_city_gate"]),
    Query("training_features", q_training_features, SQL["training_features"]),
    Query("rmse_metric", q_rmse_metric, SQL["rmse_metric"]),
    Query("score_linear", q_score_linear, SQL["score_linear"]),
    Query("key_split", q_key_split, SQL["key_split"]),
    Query("content_key_occurrence", q_content_key_occurrence, SQL["content_key_occurrence"]),
    Query("upsert_by_key", q_upsert_by_key, SQL["upsert_by_key"]),
    Query("feed_vancouver", q_feed_vancouver, SQL["feed_vancouver"]),
    Query("feed_calgary", q_feed_calgary, SQL["feed_calgary"]),
    Query("feed_calgary_rejects", q_feed_calgary_rejects, SQL["feed_calgary_rejects"]),
    Query("feed_toronto", q_feed_toronto, SQL["feed_toronto"]),
    Query("feed_socrata", q_feed_socrata, SQL["feed_socrata"]),
    Query("feed_socrata_rejects", q_feed_socrata_rejects, SQL["feed_socrata_rejects"]),
    Query("landed_socrata_document", q_landed_socrata_document, SQL["feed_socrata"]),
    Query("landed_toronto_document", q_landed_toronto_document, SQL["feed_toronto"]),
    Query("type_map_csv", q_type_map_csv, SQL["type_map_csv"]),
    Query("catalog_merge", q_catalog_merge, SQL["catalog_merge"]),
    Query("catalog_city_reload", q_catalog_city_reload, SQL["catalog_city_reload"]),
    Query("summaries_incremental", q_summaries_incremental, SQL["summaries_incremental"]),
    Query("catalog_concurrent_loads", q_catalog_concurrent_loads, SQL["catalog_merge"]),
    Query("catalog_delta_read", q_catalog_delta_read, SQL["catalog_merge"]),
    Query("catalog_compacted_read", q_catalog_compacted_read, SQL["catalog_merge"]),
    Query("reclassify_after_map_change", q_reclassify_after_map_change, SQL["feed_socrata"]),
    Query("rejects_after_map_change", q_rejects_after_map_change, SQL["feed_socrata_rejects"]),
    Query("relocate_after_gazetteer_change", q_relocate_after_gazetteer_change, SQL["feed_edmonton"]),
    Query("rejects_after_gazetteer_change", q_rejects_after_gazetteer_change, SQL["feed_edmonton_rejects"]),
    Query("stored_by_type", q_stored_by_type, SQL["stored_by_type"]),
    Query("stored_by_hour", q_stored_by_hour, SQL["stored_by_hour"]),
    Query("stored_daylight", q_stored_daylight, SQL["stored_daylight"]),
    Query("stored_season", q_stored_season, SQL["stored_season"]),
    Query("stream_cut_invariant", q_stream_cut_invariant, SQL["feed_socrata"]),
    Query("feed_edmonton", q_feed_edmonton, SQL["feed_edmonton"]),
    Query("feed_edmonton_rejects", q_feed_edmonton_rejects, SQL["feed_edmonton_rejects"]),
    Query("union_feeds", q_union_feeds, SQL["union_feeds"]),
    Query("incidents_summary_yoy", q_incidents_summary_yoy, SQL["incidents_summary_yoy"]),
    Query("landed_vancouver_csv", q_landed_vancouver_csv, SQL["feed_vancouver"]),
    Query("landed_calgary_json", q_landed_calgary_json, SQL["feed_calgary"]),
    Query("landed_toronto_geojson", q_landed_toronto_geojson, SQL["feed_toronto"]),
    Query("landed_socrata_json", q_landed_socrata_json, SQL["feed_socrata"]),
    Query("landed_edmonton_json", q_landed_edmonton_json, SQL["feed_edmonton"]),
    Query("content_key_differing", q_content_key_differing, SQL["content_key_differing"]),
    Query("content_split", q_content_split, SQL["content_split"]),
    Query("gbt_stump", q_gbt_stump, SQL["gbt_stump"]),
    Query("ordered_summary", q_ordered_summary, SQL["ordered_summary"]),
    Query("case_insensitive_names", q_case_insensitive_names, SQL["case_insensitive_names"]),
    Query("gbt_score", q_gbt_score, None),
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.name: q.fn for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.sql for q in QUERIES if q.sql is not None}
