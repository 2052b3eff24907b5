"""Lookups in tables stored in the order of a key, which open only the files they need.

Next to a table written by `write_clustered` lies its zone map: first and last key and number of
rows of every file. A lookup filters the zone map, a row per file, and reads the files that
may hold the key; within them Parquet skips row groups by the same filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.sources import sinks

# After the last character that a text can hold.
_AFTER = "\U0010ffff"


def write_with_zones(df: DataFrame, path: str, *keys: str, mode: str = "errorifexists") -> None:
    """Write a table in the order of its keys, and the zone map of the first."""
    sinks.write_clustered(df, f"{path}/rows", *keys, mode=mode)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    key = F.col(keys[0])
    zones = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows")
    )
    zones.coalesce(1).write.mode(mode).parquet(f"{path}/zones")


def files_between(spark: SparkSession, path: str, low: str, high: str) -> list[str]:
    """The files that may hold keys from `low` to `high`; a key of many files names them all."""
    zones = spark.read.parquet(f"{path}/zones").where((F.col("low") <= high) & (F.col("high") >= low))
    return sorted(row["file"] for row in zones.select("file").collect())


def _rows(spark: SparkSession, path: str, low: str, high: str, matches: Column) -> DataFrame:
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_between(spark, path, low, high)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(matches)


def rows_of_key(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    """All rows of one key."""
    return _rows(spark, path, value, value, F.col(column) == value)


def rows_of_prefix(spark: SparkSession, path: str, column: str, prefix: str) -> DataFrame:
    """All rows whose key starts with a text."""
    return _rows(spark, path, prefix, prefix + _AFTER, F.col(column).startswith(prefix))
