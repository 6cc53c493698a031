"""Place-name gazetteer: build, enrich, detect misses, refresh.

The gazetteer maps a locality text (``<neighbourhood>, Edmonton, Canada``)
to coordinates, with (0.0, 0.0) meaning "looked up, not found". Lookups are
joins against a reference place table supplied as data (``places``:
locality, lat, long) instead of a per-row web call. Gazetteer and place
tables grow with the data, so their joins carry no broadcast hint: the
planner broadcasts them while they are small and shuffles otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import default_zero, locality, neither_zero
from .joins import unique_lookup
from .upsert import upsert_by_key

EDMONTON_SUFFIX = ", Edmonton, Canada"


def localities(df: DataFrame, neighbourhood_col: str = "neighbourhood",
               suffix: str = EDMONTON_SUFFIX) -> DataFrame:
    """Distinct locality texts of ``df`` (X1 + A7)."""
    return (df.select(locality(neighbourhood_col, suffix).alias("locality"))
              .filter(F.col("locality").isNotNull()).distinct())


def resolve(locs: DataFrame, places: DataFrame) -> DataFrame:
    """Coordinates for each locality from ``places``; unknown -> (0.0, 0.0)."""
    p = unique_lookup(places.select("locality", F.col("lat").alias("__lat"), F.col("long").alias("__long")), "locality")
    return (locs.join(p, "locality", "left")
                .select("locality", default_zero("__lat").alias("lat"),
                        default_zero("__long").alias("long")))


def build_gazetteer(df: DataFrame, places: DataFrame, neighbourhood_col: str = "neighbourhood",
                    suffix: str = EDMONTON_SUFFIX) -> DataFrame:
    """G1: distinct neighbourhoods -> locality -> coordinates."""
    return resolve(localities(df, neighbourhood_col, suffix), places)


def missing_localities(df: DataFrame, gazetteer: DataFrame, neighbourhood_col: str = "neighbourhood",
                       suffix: str = EDMONTON_SUFFIX) -> DataFrame:
    """Localities of ``df`` absent from the gazetteer, with row counts.

    Detected before any coordinate filter, so unknown places are reported
    (the zero filter would otherwise have dropped them unseen).
    """
    loc = df.select(locality(neighbourhood_col, suffix).alias("locality")).filter(F.col("locality").isNotNull())
    counts = loc.groupBy("locality").agg(F.count(F.lit(1)).alias("n_incidents"))  # rows combine before they move
    return counts.join(gazetteer.select("locality"), "locality", "left_anti")


def enrich(df: DataFrame, gazetteer: DataFrame, neighbourhood_col: str = "neighbourhood",
           suffix: str = EDMONTON_SUFFIX, drop_unlocated: bool = True, unique: bool = False) -> DataFrame:
    """Attach lat, long by locality; optionally keep only located rows.

    ``unique``: the gazetteer has one row per locality (as :func:`build_gazetteer`
    and the upsert write it), so it need not be reduced to one first.

    "Located" is the neither-zero rule (F4): a zero on either axis, or no
    gazetteer entry at all (null), drops the row.
    """
    base = df.drop("lat", "long")
    g = gazetteer.select("locality", "lat", "long")
    out = (base.withColumn("locality", locality(neighbourhood_col, suffix))
               .join(g if unique else unique_lookup(g, "locality"), "locality", "left"))
    if drop_unlocated:
        out = out.filter(neither_zero("lat", "long"))
    return out.drop("locality")


def to_resolve(df: DataFrame, gazetteer: DataFrame, neighbourhood_col: str = "neighbourhood",
               suffix: str = EDMONTON_SUFFIX, retry_not_found: bool = False) -> DataFrame:
    """Localities of ``df`` that need a lookup: missing, and optionally the
    ones recorded as not found (0.0, 0.0) so a better source can fill them."""
    seen = localities(df, neighbourhood_col, suffix)          # one distinct pass over df
    g = gazetteer.select("locality")
    need = seen.join(g, "locality", "left_anti")
    if retry_not_found:
        nf = gazetteer.filter((F.col("lat") == 0) & (F.col("long") == 0)).select("locality")
        need = need.unionByName(seen.join(nf, "locality", "left_semi"))
    return need


def refresh_gazetteer(df: DataFrame, gazetteer: DataFrame, places: DataFrame,
                      neighbourhood_col: str = "neighbourhood", suffix: str = EDMONTON_SUFFIX,
                      retry_not_found: bool = False) -> tuple[DataFrame, DataFrame]:
    """G3 + K1: resolve what is missing and upsert it. Returns (gazetteer, resolved)."""
    resolved = resolve(to_resolve(df, gazetteer, neighbourhood_col, suffix, retry_not_found), places)
    g2 = upsert_by_key(gazetteer.select("locality", "lat", "long"), resolved, ["locality"])
    return g2, resolved


@dataclass
class Refreshed:
    located: DataFrame      # rows with usable coordinates
    unlocated: DataFrame    # rows dropped by the neither-zero rule
    gazetteer: DataFrame    # gazetteer after adding newly resolved places
    new_places: DataFrame   # the localities that were looked up
    rows: DataFrame         # located and unlocated rows in one pass, told apart by ``placed``


def refresh_and_enrich(df: DataFrame, gazetteer: DataFrame, places: DataFrame,
                       neighbourhood_col: str = "neighbourhood",
                       suffix: str = EDMONTON_SUFFIX, retry_not_found: bool = False) -> Refreshed:
    """Rows located with the gazetteer, falling back to ``places`` for
    localities the gazetteer lacks, plus the refreshed gazetteer.

    The located rows come from one pass over ``df`` (one lookup join); they
    equal "resolve the missing localities, upsert them, then enrich", without
    materialising the upsert first. The refreshed gazetteer is a separate
    lazy output, computed only if the caller writes it. No branch on a count.
    """
    g = unique_lookup(gazetteer.select("locality", F.col("lat").alias("__g_lat"), F.col("long").alias("__g_long")),
                      "locality").withColumn("__in_g", F.lit(True))
    p = unique_lookup(places.select("locality", F.col("lat").alias("__p_lat"), F.col("long").alias("__p_long")), "locality")
    use_g = F.col("__in_g").isNotNull()
    if retry_not_found:
        use_g = use_g & ~((F.col("__g_lat") == 0) & (F.col("__g_long") == 0))
    # one row per locality known to either table, so the facts meet a single lookup
    known = g.join(p, "locality", "full").select(
        "locality", F.when(use_g, F.col("__g_lat")).otherwise(default_zero("__p_lat")).alias("__lat"),
        F.when(use_g, F.col("__g_long")).otherwise(default_zero("__p_long")).alias("__long"), F.lit(True).alias("__known"))
    unknown = F.col("locality").isNotNull() & F.col("__known").isNull()
    all_rows = (df.drop("lat", "long")
                  .withColumn("locality", locality(neighbourhood_col, suffix))
                  .join(known, "locality", "left")
                  .withColumn("lat", F.when(unknown, F.lit(0.0)).otherwise(F.col("__lat")))
                  .withColumn("long", F.when(unknown, F.lit(0.0)).otherwise(F.col("__long")))
                  .drop("locality", "__lat", "__long", "__known"))
    all_rows = all_rows.withColumn("placed", F.coalesce(neither_zero("lat", "long"), F.lit(False)))
    located = all_rows.filter("placed").drop("placed")
    unlocated = all_rows.filter("not placed").drop("placed")
    g2, resolved = refresh_gazetteer(df, gazetteer, places, neighbourhood_col, suffix, retry_not_found)
    return Refreshed(located, unlocated, g2, resolved, all_rows)
