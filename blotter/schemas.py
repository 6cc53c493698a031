"""Canonical table schemas (the contract every feed adapter meets)."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical incident table. Sums and averages downstream are kept wide
# (bigint / double) instead of narrowing to the store's int / float.
INCIDENT_FIELDS = [
    ("crime_type", T.StringType()),
    ("crimesub_type", T.StringType()),
    ("city", T.StringType()),
    ("uuid", T.StringType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("hour", T.IntegerType()),
    ("neighbourhood", T.StringType()),
    ("lat", T.DoubleType()),
    ("long", T.DoubleType()),
    ("count", T.IntegerType()),
]
INCIDENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in INCIDENT_FIELDS])
INCIDENT_COLUMNS = [n for n, _ in INCIDENT_FIELDS]
# Columns that describe an incident (everything but its key); the content
# key is a hash over these.
INCIDENT_CONTENT_COLUMNS = [c for c in INCIDENT_COLUMNS if c != "uuid"]

TYPE_MAP_SCHEMA = T.StructType([
    T.StructField("sub_type", T.StringType()),
    T.StructField("type", T.StringType()),
])

CODE_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("type_crime", T.StringType()),
])

GAZETTEER_SCHEMA = T.StructType([
    T.StructField("locality", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
])

TRAINING_SCHEMA = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("code", T.IntegerType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
])

# ---- raw feed layouts (what each landed file holds) -----------------------

# Vancouver: CSV with a header; metres in UTM zone 10 (kept as double, the
# 32-bit float of the source loses up to 2e-6 degrees).
VANCOUVER_SCHEMA = T.StructType([
    T.StructField("subtype", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("hundred_block", T.StringType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("X", T.DoubleType()),
    T.StructField("Y", T.DoubleType()),
])

# Calgary: JSON records; geocoded_column holds strings.
CALGARY_SCHEMA = T.StructType([
    T.StructField("community_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("count", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("geocoded_column", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ])),
])

# Toronto: GeoJSON; only the used properties are declared (the reader
# prunes the rest of the 27 fields).
TORONTO_PROPERTIES = T.StructType([
    T.StructField("MCI", T.StringType()),
    T.StructField("offence", T.StringType()),
    T.StructField("reportedhour", T.LongType()),
    T.StructField("reportedmonth", T.StringType()),
    T.StructField("reportedyear", T.LongType()),
    T.StructField("Lat", T.DoubleType()),
    T.StructField("Long", T.DoubleType()),
    T.StructField("Neighbourhood", T.StringType()),
])
TORONTO_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", TORONTO_PROPERTIES),
    ]))),
])

# Ottawa / Victoria / Lethbridge: JSON array of flat string records.
SOCRATA_INCIDENT_SCHEMA = T.StructType([
    T.StructField("incident_datetime", T.StringType()),
    T.StructField("address_1", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("hour_of_day", T.StringType()),
    T.StructField("parent_incident_type", T.StringType()),
])

# Edmonton: JSON records, every field a string; bound by name.
EDMONTON_SCHEMA = T.StructType([
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("quarter", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("crimesub_type", T.StringType()),
    T.StructField("count", T.StringType()),
])
