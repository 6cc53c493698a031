"""Readers for landed feed files.

All readers take explicit schemas (no inference pass over the data) and
return lazy DataFrames. Splittable formats -- headerless / header CSV and
JSON lines -- are read in parallel per file block, and so are whole documents
(a JSON array, a GeoJSON FeatureCollection), whose records are cut out by
:mod:`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (CALGARY_SCHEMA, EDMONTON_SCHEMA, SOCRATA_INCIDENT_SCHEMA, TORONTO_PROPERTIES,
                       TORONTO_SCHEMA, TYPE_MAP_SCHEMA, VANCOUVER_SCHEMA)
from .documents import document_records


def sourced(df: DataFrame, on: bool) -> DataFrame:
    """Add the landed file's path as ``_source`` (part of the rows' identity, see operators.keys)."""
    return df.withColumn("_source", F.col("_metadata.file_path")) if on else df


def read_type_map_csv(spark: SparkSession, path: str, schema: T.StructType = TYPE_MAP_SCHEMA) -> DataFrame:
    """Headerless two-column CSV with a fixed schema (values kept as is)."""
    return (spark.read.schema(schema)
            .option("header", False)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_csv_with_header(spark: SparkSession, path: str, schema: T.StructType = VANCOUVER_SCHEMA,
                         source: bool = False) -> DataFrame:
    """Header CSV whose columns are bound to ``schema`` by *name*.

    The file is read as text columns named by its header (no inference
    pass), then each declared field is taken by name and cast with
    ``try_cast``: a file with its columns in another order binds correctly,
    and a bad value becomes null instead of failing the job. A declared
    field missing from the header is an error.
    """
    raw = sourced(spark.read.option("header", True).option("inferSchema", False).csv(path), source)
    have = set(raw.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"CSV header lacks declared columns {missing}")
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *["_source"] * source)


def _parsed(records: DataFrame, schema: T.StructType, source: bool) -> DataFrame:
    return records.select(F.from_json("value", schema).alias("__r"), "_source").select("__r.*", *["_source"] * source)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = SOCRATA_INCIDENT_SCHEMA,
                    line_delimited: bool = False, source: bool = False) -> DataFrame:
    """S3: a file holding one JSON array of flat records (or JSON lines), read by as many tasks as its size asks for."""
    if line_delimited:
        return sourced(spark.read.schema(schema).json(path), source)
    return _parsed(document_records(spark, path), schema, source)


def read_geojson_features(spark: SparkSession, path: str, line_delimited: bool = False, source: bool = False) -> DataFrame:
    """GeoJSON -> one row per feature with a ``properties`` struct.

    The features of a FeatureCollection document are cut out by as many tasks
    as its size asks for; with ``line_delimited`` each line is one Feature
    (GeoJSON text sequence).
    """
    if line_delimited:
        feat = T.StructType([T.StructField("type", T.StringType()),
                             T.StructField("properties", TORONTO_PROPERTIES)])
        return sourced(spark.read.schema(feat).json(path), source)
    return _parsed(document_records(spark, path, key="features"), TORONTO_SCHEMA["features"].dataType.elementType, source)


def read_records_json(spark: SparkSession, path: str, schema: T.StructType = CALGARY_SCHEMA,
                      line_delimited: bool = True, source: bool = False) -> DataFrame:
    """API records landed as JSON (one record per line by default)."""
    return read_json_array(spark, path, schema, line_delimited, source)


def read_all_string_records(spark: SparkSession, path: str, schema: T.StructType = EDMONTON_SCHEMA,
                            line_delimited: bool = True, source: bool = False) -> DataFrame:
    """Records whose every field is a string, bound by name."""
    return read_json_array(spark, path, schema, line_delimited, source)
