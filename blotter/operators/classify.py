"""Sub-type classification through the type map."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_side, unique_lookup

# What to do with rows whose sub-type is not in the map.
KEEP = "keep"        # left join, null crime_type stays in the output (J1)
DROP = "drop"        # inner join, the row disappears (J2)
REJECT = "reject"    # left join, null-type rows go to a reject frame (J3)


@dataclass
class Classified:
    kept: DataFrame
    rejected: DataFrame | None


def classify(df: DataFrame, type_map: DataFrame, sub_col: str = "crimesub_type",
             type_col: str = "crime_type", on_unmapped: str = REJECT,
             broadcast: str = "planner") -> Classified:
    """Attach ``type_col`` from ``type_map`` (sub_type, type) on ``sub_col``.

    The match is exact: case-sensitive, no trimming. The map is broadcast
    under ``broadcast`` (see :func:`joins.lookup_side`: ``fixed`` for an
    inline map, ``planner`` -- the default -- for a loaded one, which is first
    reduced to one row per sub-type).
    """
    tm = type_map.select(F.col("sub_type").alias("__sub"), F.col("type").alias(type_col))
    tm = lookup_side(tm if broadcast == "fixed" else unique_lookup(tm, "__sub"), broadcast)
    base = df.drop(type_col) if type_col in df.columns else df
    if on_unmapped == DROP:
        joined = base.join(tm, base[sub_col] == tm["__sub"], "inner").drop("__sub")
        return Classified(joined, None)
    joined = base.join(tm, base[sub_col] == tm["__sub"], "left").drop("__sub")
    if on_unmapped == KEEP:
        return Classified(joined, None)
    if on_unmapped == REJECT:
        return Classified(joined.filter(F.col(type_col).isNotNull()),
                          joined.filter(F.col(type_col).isNull()))
    raise ValueError(f"unknown on_unmapped policy {on_unmapped!r}")


def reject_report(rejected: DataFrame, by=("city", "crimesub_type")) -> DataFrame:
    """Unmapped sub-types and how many rows each one lost."""
    return rejected.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))
