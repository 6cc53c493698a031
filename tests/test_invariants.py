"""Properties that must hold whatever the data: sums agree across
summaries, kept + rejected = input, upsert is idempotent, keys are stable
and unique, cube-derived summaries equal direct ones."""

import pytest
from pyspark.sql import functions as F

from blotter.operators import classify as C
from blotter.operators import summaries as S
from blotter.operators.keys import with_content_key
from blotter.operators.upsert import upsert_by_key
from blotter.plans import standins as V
from blotter.plans.registry import _tm_events


def _set(df):
    return sorted(map(lambda r: tuple(r), df.collect()), key=repr)


def test_yoy_and_type_sums_agree(spark, sf_dir):
    v = V.v1(spark, sf_dir)
    lo, hi = V.V1_YEARS
    yoy = S.summary_yoy(v, order=False).filter((F.col("year") > lo) & (F.col("year") <= hi))
    a = yoy.agg(F.sum("count")).first()[0]
    b = S.summary_by_type(v, V.V1_YEARS).agg(F.sum("count")).first()[0]
    assert a == b


def test_cube_derived_equals_direct(spark, sf_dir):
    v = V.v1(spark, sf_dir)
    outs = S.all_summaries(v, V.V1_YEARS, V.V1_HOUR_EXCLUDED, V.V1_DAYLIGHT_EXCLUDED)
    assert _set(outs["crimes_yoy"]) == _set(S.summary_yoy(v, order=False))
    assert _set(outs["crimes_typ"]) == _set(S.summary_by_type(v, V.V1_YEARS))
    assert _set(outs["crimes_hr"]) == _set(S.summary_by_hour(v, V.V1_YEARS, V.V1_HOUR_EXCLUDED, order=False))
    assert _set(outs["crimes_dl"]) == _set(S.summary_daylight(v, V.V1_DAYLIGHT_EXCLUDED, order=False))
    assert _set(outs["crimes_ss"]) == _set(S.summary_season(v, V.V1_YEARS, order=False))


def test_season_by_hand(spark):
    rows = [("C", "T", 2014, 6, 10), ("C", "T", 2014, 7, 20), ("C", "T", 2015, 6, 30)]
    inc = spark.createDataFrame(rows, "city string, crime_type string, year int, month int, count int")
    got = S.summary_season(inc, (2013, 2019), order=False).collect()
    assert [(r["seasons"], r["avgsum"]) for r in got] == [("Summer", 30.0)]


def test_null_count_and_null_city(spark):
    rows = [(None, "T", 2015, 1, 1, 5), ("Calgary", "T", 2015, 1, 1, 7), ("X", "T", 2015, 1, 1, None)]
    inc = spark.createDataFrame(rows, "city string, crime_type string, year int, month int, hour int, count int")
    hr = S.summary_by_hour(inc, (2013, 2019), ["Calgary", "Edmonton"], order=False).collect()
    assert [(r["year"], r["hour"], r["count"]) for r in hr] == [(2015, 1, None)]   # null city dropped by NOT IN


def test_kept_plus_rejected_is_input(spark, sf_dir):
    v = V.v2(spark, sf_dir)
    c = C.classify(v, _tm_events(spark), on_unmapped=C.REJECT)
    assert c.kept.count() + c.rejected.count() == v.count()
    inner = C.classify(v, _tm_events(spark), on_unmapped=C.DROP).kept
    assert inner.count() == c.kept.count()


def test_upsert_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c2")], "k int, v string")
    once = upsert_by_key(old, new, ["k"])
    twice = upsert_by_key(once, new, ["k"])
    assert _set(once) == _set(twice) == [(1, "a"), (2, "B"), (3, "c2")]


def test_content_keys_unique_and_partition_independent(spark, sf_dir):
    cols = ["city", "crime_type", "year", "month"]
    v = V.v1(spark, sf_dir).select(*cols)
    k1 = with_content_key(v, cols).select("uuid")
    k2 = with_content_key(v.repartition(5), cols, buckets=3).select("uuid")
    k3 = with_content_key(v.repartition(3), cols, buckets=7).select("uuid")
    n = v.count()
    assert k1.distinct().count() == n
    assert _set(k1) == _set(k2) == _set(k3)


@pytest.mark.parametrize("buckets", [16, None])
def test_hot_key_numbering(spark, buckets):
    # one content value holding most rows: numbers must be 0..n-1
    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("x"))
    keyed = with_content_key(df, ["x"], **({"buckets": buckets} if buckets else {}))
    occ = keyed.filter(F.col("x") == "hot").select(F.split("uuid", "-").getItem(1).cast("int").alias("o"))
    got = [r[0] for r in occ.orderBy("o").collect()]
    assert got == list(range(4000))


@pytest.mark.parametrize("buckets", [1, 5, None])
def test_hot_content_with_differing_columns(spark, monkeypatch, buckets):
    from blotter.operators import keys
    monkeypatch.setattr(keys, "EXPAND_CHUNK", 50)
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2500, None).otherwise(F.col("id").cast("string")).alias("x"),
                                  (F.col("id") % 700).alias("y"), F.when(F.col("id") % 2 == 0, "e").alias("z"))
    df = df.unionByName(spark.range(400).select(F.lit("hot").alias("x"), F.lit(7).cast("long").alias("y"), F.lit(None).cast("string").alias("z")))
    kw = {"buckets": buckets} if buckets else {}
    keyed = with_content_key(df, ["x"], **kw)
    assert keyed.select("x", "y", "z").exceptAll(df).isEmpty() and keyed.count() == 3400
    occ = keyed.select("x", F.split("uuid", "-").getItem(1).cast("int").alias("o"), F.split("uuid", "-").getItem(0).alias("h")).collect()
    by = {}
    for r in occ:
        by.setdefault((r["x"], r["h"]), []).append(r["o"])
    assert len(by) == 502 and all(sorted(v) == list(range(len(v))) for v in by.values())
    again = with_content_key(df.repartition(5, "y"), ["x"], **kw)
    assert again.exceptAll(keyed).isEmpty()


def test_random_keys_are_v4_uuids_and_unique(spark):
    from blotter.operators.keys import with_random_key
    df = with_random_key(spark.range(2000))
    keys = [r["uuid"] for r in df.collect()]
    assert len(set(keys)) == 2000
    assert all(len(k) == 36 and k[14] == "4" for k in keys)


def test_display_order_option(spark, sf_dir):
    # O1: sorting is a display option on the small outputs, off by default
    v = V.v1(spark, sf_dir)
    rows = [tuple(r) for r in S.summary_yoy(v, order=True).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    hr = [(r["year"], r["hour"]) for r in S.summary_by_hour(v, V.V1_YEARS, V.V1_HOUR_EXCLUDED, order=True).collect()]
    assert hr == sorted(hr)
    plan = S.summary_yoy(v)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
