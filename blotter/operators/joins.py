"""Join helpers: broadcast only behind a size check.

Policy used throughout blotter:

* dimensions whose size is fixed by code (inline lookup tables, generator
  arrays) are hinted with :func:`fixed_broadcast`;
* dimensions derived from data (gazetteer, place tables, supplier, part,
  nation) get **no hint**. Spark's planner broadcasts them only if their
  estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
  re-checks with the real shuffle sizes at runtime
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``); above the threshold
  the join stays a sort-merge / shuffle-hash join, with AQE skew splitting.
* lookup tables of the incident taxonomy (sub-type map, code table) are
  hinted when fixed by code and left to the planner when loaded;
  :func:`unique_lookup` gives a loaded one a single row per key first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .upsert import latest_per_key

def fixed_broadcast(dim: DataFrame) -> DataFrame:
    """Broadcast a dimension whose size is fixed by code (an inline table)."""
    return F.broadcast(dim)


def lookup_side(dim: DataFrame, broadcast: str = "planner") -> DataFrame:
    """The small side of a lookup join under a broadcast policy:
    ``fixed`` (size fixed by code: hint) or ``planner`` (no hint)."""
    if broadcast == "fixed":
        return fixed_broadcast(dim)
    if broadcast == "planner":
        return dim
    raise ValueError(f"unknown broadcast policy {broadcast!r}")


def unique_lookup(dim: DataFrame, key: str) -> DataFrame:
    """One row per key, so that a doubled lookup row cannot multiply facts.

    Among several the greatest wins (as in :func:`upsert.latest_per_key`).
    """
    return latest_per_key(dim, [key])
