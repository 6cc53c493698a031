"""Feed adapters (C1-C7): raw feed layout -> canonical incident rows.

Each adapter is a pure DataFrame -> DataFrame plan; readers for the landed
files live in :mod:`blotter.sources.files`. Every adapter returns the
canonical columns (:data:`blotter.schemas.INCIDENT_COLUMNS`) plus a reject
frame, so no row disappears without trace:

* ``kept``      -- canonical rows, keyed;
* ``rejected``  -- raw-but-canonicalised rows that were not kept, with a
  ``reason`` column ('unmapped_type', 'no_location' or 'bad_coordinates').

The unmapped-type rule is a parameter of each adapter (``on_unmapped``):
``drop`` (inner join), ``reject`` (left join, nulls to the reject frame) or
``keep`` (left join, null type stays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (hour_of, month_number, month_of, safe_cast,
                         with_utm_latlon, year_of)
from ..schemas import INCIDENT_COLUMNS, INCIDENT_FIELDS
from .classify import DROP, KEEP, REJECT, classify
from .keys import ID1, ID2, counted_rows, keyed_copies, with_content_key, with_identity, with_random_key
from .locate import EDMONTON_SUFFIX, refresh_and_enrich

CANON_TYPES = dict(INCIDENT_FIELDS)


class FeedResult:
    """Adapter output.

    ``rows`` holds all canonical rows before the split, with ``reason``
    (null = kept). ``kept`` (keyed) and ``rejected`` are derived from it on
    first use, so a job can persist ``shared`` first and both outputs read the
    feed once.
    """

    def __init__(self, rows: DataFrame, key: str = "content", gazetteer: DataFrame | None = None):
        self.rows = rows
        self.key = key
        self.gazetteer = gazetteer
        self._kept: DataFrame | None = None
        self._shared: DataFrame | None = None

    @property
    def counts(self) -> bool:
        """Whether the outputs are numbered by counting equal rows (content keys)."""
        return self.key == "content" and ID1 in self.rows.columns

    @property
    def shared(self) -> DataFrame:
        """What both keyed outputs are made from: ``rows``, or for content keys their distinct ones with counts."""
        if self._shared is None:
            self._shared = counted_rows(self.rows.drop("uuid")) if self.counts else self.rows
        return self._shared

    @property
    def kept(self) -> DataFrame:
        if self._kept is None and self.counts:
            self._kept = keyed_copies(self.shared.filter(F.col("reason").isNull()).drop("reason"))
        elif self._kept is None:
            self._kept = _keyed(self.rows.filter(F.col("reason").isNull()).drop("reason"), self.key)
        return self._kept

    @property
    def rejected_keyed(self) -> DataFrame:
        """The rejects with the keys they would have as incidents, so that they can become some later."""
        if self.counts:
            return keyed_copies(self.shared.filter(F.col("reason").isNotNull()))
        rows = self.rows.filter(F.col("reason").isNotNull())
        return rows.drop(ID1, ID2).withColumn("uuid", F.coalesce(F.col("uuid"), F.expr("uuid()")))

    @property
    def rejected(self) -> DataFrame:
        return self.rows.filter(F.col("reason").isNotNull()).drop(ID1, ID2)


def canonical(df: DataFrame, extra: list | None = None) -> DataFrame:
    """Project to the canonical columns, in order and with canonical types
    (absent columns become typed nulls; ``TRY_CAST`` so a stray bad value
    is null rather than a failed job under ANSI mode)."""
    have = set(df.columns)
    exprs = [f"TRY_CAST({('`' + n + '`') if n in have else 'NULL'} AS {CANON_TYPES[n].simpleString()}) AS `{n}`"
             for n in INCIDENT_COLUMNS]
    if not extra:
        return df.selectExpr(*exprs)
    return df.select(*[F.expr(x) for x in exprs], *extra)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    df = df.drop(ID1, ID2)
    if key == "content":
        return with_content_key(df, [c for c in INCIDENT_COLUMNS if c != "uuid"])
    if key == "random":
        return with_random_key(df)
    if key == "none":
        return df
    raise ValueError(f"unknown key mode {key!r}")


def _finish(rows: DataFrame, type_map: DataFrame, on_unmapped: str, key: str,
            placed: str | None = None, broadcast: str = "planner") -> FeedResult:
    """``placed``: column that is false for rows without a location, which are rejects and get no type."""
    off, sub = F.lit(False), "crimesub_type"
    if placed is not None:  # one pass over all rows: a null sub-type meets no entry of the map
        off, sub = ~F.col(placed), "__type_of"
        rows = rows.withColumn(sub, F.when(F.col(placed), F.col("crimesub_type")))
    if on_unmapped != DROP:
        kept = classify(rows, type_map, sub, on_unmapped=KEEP, broadcast=broadcast).kept
    else:
        kept = classify(rows, type_map, sub, on_unmapped=DROP, broadcast=broadcast).kept
        if placed is not None:
            kept = kept.unionByName(rows.filter(off).withColumn("crime_type", F.lit(None).cast("string")), allowMissingColumns=True)
    if on_unmapped == REJECT:
        reason = F.when(F.col("crime_type").isNull(), F.lit("unmapped_type"))
    else:
        reason = F.lit(None).cast("string")
    lat, long = F.col("lat"), F.col("long")
    impossible = ~(lat.isNull() | lat.between(-90, 90)) | ~(long.isNull() | long.between(-180, 180)) | F.isnan("lat") | F.isnan("long")
    reason = F.when(off, F.lit("no_location")).when(impossible, F.lit("bad_coordinates")).otherwise(reason)
    return FeedResult(canonical(kept, extra=[reason.alias("reason"), F.col(ID1), F.col(ID2)]), key)


# ---- C1: Vancouver (CSV, UTM metres) ---------------------------------------

def adapt_vancouver(raw: DataFrame, type_map: DataFrame, on_unmapped: str = REJECT,
                    key: str = "content", fill_missing_hour: bool = False,
                    zone: int = 10, broadcast: str = "planner") -> FeedResult:
    """Metres -> degrees where both X and Y are positive, else no coordinates.

    Every input row appears exactly once (the X == 0 rows are not doubled and
    negative-X rows are not lost). A missing hour stays null unless
    ``fill_missing_hour`` asks for the old fill-with-0.
    """
    df = with_identity(raw).na.fill(0, subset=["X", "Y"])
    if fill_missing_hour:
        df = df.na.fill(0, subset=["hour"])
    df = with_utm_latlon(df.drop("lat", "long"), "X", "Y", "lat", "long", zone=zone)
    df = df.select(F.lit("Vancouver").alias("city"), F.col("subtype").alias("crimesub_type"),
                   "year", "month", "hour", "neighbourhood", "lat", "long", F.lit(1).alias("count"), ID1, ID2)
    return _finish(df, type_map, on_unmapped, key, broadcast=broadcast)


# ---- C2: Calgary (JSON records, nested geocode) ----------------------------

def adapt_calgary(raw: DataFrame, type_map: DataFrame, on_unmapped: str = REJECT,
                  key: str = "content", broadcast: str = "planner") -> FeedResult:
    g = F.col("geocoded_column")
    df = with_identity(raw).select(
        ID1, ID2, F.lit("Calgary").alias("city"), F.col("community_name").alias("neighbourhood"),
        F.col("category").alias("crimesub_type"), safe_cast("count", "int").alias("count"),
        safe_cast("year", "int").alias("year"), month_of("date").alias("month"), hour_of("date").alias("hour"),
        safe_cast(g["longitude"], "double").alias("long"), safe_cast(g["latitude"], "double").alias("lat"))
    return _finish(df, type_map, on_unmapped, key, broadcast=broadcast)


# ---- C3: Toronto (GeoJSON features) -----------------------------------------

def adapt_toronto(features: DataFrame, key: str = "content", count_per_incident: int = 1) -> FeedResult:
    """Rows with a ``properties`` struct; the type comes with the feed (MCI).

    The feed has no count column: each feature is one incident, so count is
    1 (otherwise its sums come out null).
    """
    p = with_identity(features).select("properties.*", ID1, ID2)
    df = p.select(
        ID1, ID2,
        F.lit("Toronto").alias("city"), F.col("MCI").alias("crime_type"),
        F.col("offence").alias("crimesub_type"), F.col("reportedhour").cast("int").alias("hour"),
        F.col("Lat").alias("lat"), F.col("Long").alias("long"),
        month_number("reportedmonth").alias("month"), F.col("Neighbourhood").alias("neighbourhood"),
        F.col("reportedyear").cast("int").alias("year"), F.lit(count_per_incident).alias("count"))
    return FeedResult(canonical(df, extra=[F.lit(None).cast("string").alias("reason"), F.col(ID1), F.col(ID2)]), key)


# ---- C4-C6: Ottawa / Victoria / Lethbridge (one adapter) -------------------

def adapt_socrata(raw: DataFrame, type_map: DataFrame, on_unmapped: str = REJECT,
                  key: str = "content", broadcast: str = "planner") -> FeedResult:
    """City comes from the record; unmapped sub-types go to the reject frame."""
    df = with_identity(raw).select(
        ID1, ID2, "city", F.col("parent_incident_type").alias("crimesub_type"),
        safe_cast("latitude", "double").alias("lat"), safe_cast("longitude", "double").alias("long"),
        safe_cast("hour_of_day", "int").alias("hour"),
        year_of("incident_datetime").alias("year"), month_of("incident_datetime").alias("month"),
        F.lit(1).alias("count"), F.col("address_1").alias("neighbourhood"))
    return _finish(df, type_map, on_unmapped, key, broadcast=broadcast)


# ---- C7: Edmonton (all-string records + gazetteer) -------------------------

def adapt_edmonton(raw: DataFrame, type_map: DataFrame, gazetteer: DataFrame, places: DataFrame,
                   on_unmapped: str = REJECT, key: str = "content",
                   suffix: str = EDMONTON_SUFFIX, broadcast: str = "planner") -> FeedResult:
    """Monthly counts per neighbourhood; coordinates from the gazetteer.

    Localities missing from the gazetteer are resolved against ``places``
    and added (the returned ``gazetteer``) *before* the neither-zero rule
    drops unlocated rows, which go to the reject frame.
    """
    df = with_identity(raw).select(
        ID1, ID2, "neighbourhood", "crimesub_type", safe_cast("year", "int").alias("year"),
        safe_cast("month", "int").alias("month"), safe_cast("count", "int").alias("count"),
        F.lit("Edmonton").alias("city"), F.lit(0).alias("hour"))
    r = refresh_and_enrich(df, gazetteer, places, "neighbourhood", suffix)
    out = _finish(r.rows, type_map, on_unmapped, key, placed="placed", broadcast=broadcast)
    out.gazetteer = r.gazetteer
    return out


__all__ = ["FeedResult", "canonical", "adapt_vancouver", "adapt_calgary", "adapt_toronto",
           "adapt_socrata", "adapt_edmonton", "DROP", "KEEP", "REJECT"]
