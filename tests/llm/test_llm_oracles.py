"""Registered queries whose results SQL can express, against DuckDB."""

import pytest

from blotter.llm import queries
from compare import duck, duck_digest, spark_digest


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    s = spark_digest(queries.queries()[name](spark, sf_dir))
    d = duck_digest(duck(sf_dir), queries.oracle_sql()[name])
    assert s[0] == d[0], f"columns {s[0]} vs {d[0]}"
    assert s[1] == d[1], f"rows {s[1]} vs {d[1]}"
    assert s[2] == d[2], "values differ"
