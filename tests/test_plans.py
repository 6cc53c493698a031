"""Plan properties that matter at scale, checked on the physical plans."""

import re

import pytest

import __spark_entry__ as E
from blotter.operators import summaries as S
from blotter.plans import registry
from blotter.plans import standins as V
from blotter.sources.catalog import Catalog

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF", "localCheckpoint"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registry.queries() if n != "gbt_score"])
def test_no_python_udf_no_cross_join(spark, sf_dir, name):
    plan = _plan(E.queries()[name](spark, sf_dir))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_fixed_lookup_is_broadcast(spark, sf_dir):
    plan = _plan(E.queries()["classify_left"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan


def test_partition_pruning_and_pushdown_on_incident_table(spark, sf_dir, tmp_path):
    cat = Catalog(spark, str(tmp_path / "wh"))
    v = V.v1(spark, sf_dir).select("city", "crime_type", "year", "month", "hour", "count")
    cat.write("incidents", v)
    inc = cat.read("incidents")
    df = S.summary_by_hour(inc, V.V1_YEARS, V.V1_HOUR_EXCLUDED)
    plan = _plan(df)
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    parts = re.search(r"PartitionFilters: \[([^\]]*)\]", scan).group(1)
    assert "city" in parts and "year" in parts, scan                     # both prune folders
    schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"hour", "count"}
    # and the result equals the direct computation
    direct = S.summary_by_hour(V.v1(spark, sf_dir), V.V1_YEARS, V.V1_HOUR_EXCLUDED)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, direct.collect()))


def test_lookup_side_policies(spark):
    from blotter.lookups import type_map_df
    from blotter.operators.joins import lookup_side
    fact = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS sub_type")
    tm = type_map_df(spark, [("0", "A"), ("1", "B")])
    for policy, expect_hint in (("fixed", True),):
        plan = _plan(fact.join(lookup_side(tm, policy), "sub_type", "left"))
        assert ("BroadcastHashJoin" in plan) == expect_hint, policy
    with pytest.raises(ValueError):
        lookup_side(tm, "always")
