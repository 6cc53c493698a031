"""The correctness gate: every registered query against its DuckDB SQL."""

import pytest

from compare import duck, duck_digest, spark_digest

import __spark_entry__ as E
from blotter.plans import registry

SQLS = registry.oracle_sql()  # the optional subpackage has tests of its own
NAMES = [n for n in registry.queries() if n in SQLS]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(registry.queries()) - set(SQLS)
    assert missing == {"gbt_score"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    s = spark_digest(E.queries()[name](spark, sf_dir))
    d = duck_digest(con, SQLS[name])
    assert s[0] == d[0], f"columns {s[0]} vs {d[0]}"
    assert s[1] == d[1], f"rows {s[1]} vs {d[1]}"
    assert s[2] == d[2], "values differ"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "crime_type", "year", "count"]
    assert df.count() > 0


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    spark_types = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    rel = con.sql(SQLS[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
