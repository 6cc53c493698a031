"""Ordered output (O1): files that hold a table in order, written and read by many tasks.

A display sort ends in one reader's memory. Here the rows are dealt out by ranges
of the sort columns and sorted within each; Spark names the files by their range's
number, so the files by name, and the rows in each, are the table in order. The
place of a row follows from the rows of the files before it and its own row number
in its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, *order: str | Column) -> None:
    """Write ``df`` to Parquet files in the given order."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of :func:`write_ordered` with their place (from 1) in the whole order."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("__file")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)   # one row a file
    starts = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(starts), "__file").withColumn(position, F.col("__start") + F.col("__row") + 1).drop("__file", "__row", "__start")
