"""Reprocessing after a lookup changed.

A corrected type map or gazetteer concerns few records. A diff of two versions of
the lookup names the sub-types and localities that changed; only their records --
stored incidents and rejects -- are derived again, from the fields they were
derived from (sub-type, neighbourhood), by the rules of the adapters. Each keeps
its key, so the result is that of loading everything with the new lookups:
incidents get their new type and place, rejects that are now known become
incidents, incidents whose sub-type the map no longer has become rejects.

Both tables change by one commit each, the incidents first; a replay that dies in
between is completed by running it again, since rejects that have become
incidents are looked for among the rejects of the changed sub-types once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import locality, neither_zero
from ..operators import summaries as S
from ..operators.joins import unique_lookup
from ..operators.locate import EDMONTON_SUFFIX
from ..schemas import INCIDENT_COLUMNS
from ..session import scratch_folder
from ..sources.catalog import Catalog

OWN_TYPES = ("Toronto",)          # cities whose feed brings its own types
PLACED = {"Edmonton": EDMONTON_SUFFIX}   # cities located by the gazetteer, and the suffix of their localities


def changed_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """(sub_type, type): sub-types whose type differs between two maps, with the new type (null: no longer mapped)."""
    a = unique_lookup(old.select("sub_type", F.col("type").alias("was")), "sub_type")
    b = unique_lookup(new.select("sub_type", "type"), "sub_type")
    return a.join(b, "sub_type", "full").where(~F.col("was").eqNullSafe(F.col("type"))).select("sub_type", "type")


def changed_places(old: DataFrame, new: DataFrame) -> DataFrame:
    """(locality, lat, long): localities whose place differs between two gazetteers; (0, 0) if no longer known."""
    a = unique_lookup(old.select("locality", F.struct("lat", "long").alias("was")), "locality")
    b = unique_lookup(new.select("locality", F.struct("lat", "long").alias("is")), "locality")
    both = a.join(b, "locality", "full").where(~F.col("was").eqNullSafe(F.col("is")))
    return both.select("locality", F.coalesce("is.lat", F.lit(0.0)).alias("lat"), F.coalesce("is.long", F.lit(0.0)).alias("long"))


def rederived(rows: DataFrame, types: DataFrame, places: DataFrame, type_map: DataFrame) -> DataFrame:
    """The rows that the changes concern, with their new type, place and ``reason`` (null: kept) and the old one in ``was``.

    All three lookups have one row per key."""
    suffix = F.lit(None).cast("string")
    for city, text in PLACED.items():
        suffix = F.when(F.col("city") == city, F.lit(text)).otherwise(suffix)
    mapped = ~F.coalesce(F.col("city").isin(*OWN_TYPES), F.lit(False))
    rows = rows.withColumn("__loc", F.when(suffix.isNotNull(), F.concat(F.col("neighbourhood"), suffix)))
    rows = rows.withColumn("__sub", F.when(mapped, F.col("crimesub_type")))
    t = types.select(F.col("sub_type").alias("__sub"), F.lit(True).alias("__t"))
    p = places.select(F.col("locality").alias("__loc"), F.col("lat").alias("__lat"), F.col("long").alias("__long"), F.lit(True).alias("__p"))
    few = rows.join(t, "__sub", "left").join(p, "__loc", "left").where("__t or __p")
    # a record that gets a place may never have been classified: the few look their type up in the whole map
    m = type_map.select(F.col("sub_type").alias("__sub"), F.col("type").alias("__type"))
    few = few.join(m, "__sub", "left")
    few = few.withColumn("lat", F.when(F.col("__p"), F.col("__lat")).otherwise(F.col("lat")))
    few = few.withColumn("long", F.when(F.col("__p"), F.col("__long")).otherwise(F.col("long")))
    few = few.withColumn("crime_type", F.when(mapped, F.col("__type")).otherwise(F.col("crime_type")))
    lat, long = F.col("lat"), F.col("long")
    off = F.coalesce(F.col("city").isin(*PLACED), F.lit(False)) & ~F.coalesce(neither_zero("lat", "long"), F.lit(False))
    wrong = ~(lat.isNull() | lat.between(-90, 90)) | ~(long.isNull() | long.between(-180, 180)) | F.isnan("lat") | F.isnan("long")
    reason = F.when(off, "no_location").when(wrong, "bad_coordinates").when(F.col("crime_type").isNull(), "unmapped_type")
    few = few.withColumn("was", F.col("reason")).withColumn("reason", reason)
    return few.withColumn("crime_type", F.when(off, F.lit(None).cast("string")).otherwise(F.col("crime_type"))).select(*INCIDENT_COLUMNS, "reason", "was")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared scratch folder, whose size the planner can read from its files."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replay(catalog: Catalog, types: tuple[DataFrame, DataFrame] | None = None, places: tuple[DataFrame, DataFrame] | None = None,
           type_map: DataFrame | None = None, table: str = "incidents", reject_table: str = "incident_rejects") -> dict[str, int | None]:
    """Apply the change from the first to the second of ``types`` (maps) and ``places`` (gazetteers).

    ``type_map``: the map in force (by default the new one of ``types``, else
    the stored one). Returns the commits made.
    """
    spark = catalog.spark
    t = changed_types(*types) if types else spark.createDataFrame([], "sub_type string, type string")
    p = changed_places(*places) if places else spark.createDataFrame([], "locality string, lat double, long double")
    if type_map is None:
        type_map = types[1] if types else catalog.read("crime_type")
    rows = catalog.read(table).withColumn("reason", F.lit(None).cast("string"))
    if catalog.exists(reject_table):
        rows = rows.unionByName(catalog.read(reject_table).select(*rows.columns))
    # lookups of known size: the planner need not move all stored rows to find out that a few localities changed
    t, p = written(t, "changed-types"), written(p, "changed-places")
    type_map = written(unique_lookup(type_map.select("sub_type", "type"), "sub_type"), "type-map")
    few = written(rederived(rows, t, p, type_map), "rederived")   # the tables it is read from change below
    # a key is there twice only where an earlier replay died between its commits (by hash: a clash costs time, not rows)
    once = few.groupBy(F.xxhash64("uuid").alias("h")).count().where("count > 1").isEmpty()
    out: dict[str, int | None] = {"incidents": None, "rejects": None}
    kept = few.where("reason is null")
    lost = few.where("was is null and reason is not null")
    out["incidents"] = catalog.layered(table).merge(kept.select(*INCIDENT_COLUMNS), ["uuid"], unique=once, signed=S.signed_cube, gone=lost)["version"]
    if catalog.exists(reject_table) or not lost.isEmpty():
        # a reject that stays one under another reason moves to that reason's partition
        moved = few.where("was is not null and not (was <=> reason)").select(F.col("was").alias("reason"), "uuid")
        rejects = catalog.layered(reject_table)
        out["rejects"] = rejects.merge(few.where("reason is not null").select(*INCIDENT_COLUMNS, "reason"), ["uuid"], unique=once, gone=moved)["version"]
    return out
