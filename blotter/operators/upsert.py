"""Insert-or-replace by key on DataFrames (K1) and feed union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order`` (a load sequence, a time of change);
    without it, and among rows equal in it, the greatest row (deterministic).

    ``max(struct(...))`` is an ordinary aggregate, so it combines map-side
    and a hot key never gathers its rows into one task.
    """
    rest = [c for c in new.columns if c not in keys]
    if order is not None:
        rest = [order, *[c for c in rest if c != order]]
    if not rest:
        return new.select(*keys).distinct()
    return (new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
               .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def upsert_by_key(old: DataFrame, new: DataFrame, keys: list[str] | str, unique: bool = False, order: str | None = None) -> DataFrame:
    """Rows of ``old`` whose key is absent from ``new``, plus ``new``.

    Same result as appending into a keyed store: a key present in both ends
    with the new row. Running it twice with the same ``new`` is the same as
    running it once. ``unique`` says that the keys of ``new`` are unique by
    construction (content keys are), so it need not be aggregated first;
    otherwise ``order`` says which of several new rows was written last.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fresh = new.select(*old.columns) if unique else latest_per_key(new.select(*old.columns), keys, order).select(*old.columns)
    kept = old.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (never by position)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
