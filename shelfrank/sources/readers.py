"""Table and file sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.sources import schemas


def read_files(
    spark: SparkSession, path: str, schema: str | None, fmt: str = "json", strict: bool = False
) -> DataFrame:
    """Files under a path or glob; a schema saves the inference pass over the data.

    A JSON line that cannot be parsed becomes a row of nulls, or an error if `strict`.
    """
    reader = spark.read.format(fmt)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files as they are, without blank ones: one column, `value`."""
    return spark.read.text(path).where(F.trim("value") != "")


def read_ratings(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_files(spark, path, schemas.RATINGS, fmt)


def read_books(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_files(spark, path, schemas.BOOKS, fmt)


def read_reviews(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_files(spark, path, schemas.REVIEWS, fmt)


def read_average_ratings(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_files(spark, path, schemas.AVERAGE_RATING, fmt)


def read_recommendations(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_files(spark, path, schemas.RECOMMENDATIONS, fmt)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name."""
    return spark.table(name)


def feedback_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Answers typed by visitors, as (user_id, book, rating) tuples."""
    return spark.createDataFrame(list(rows), schemas.FEEDBACK_RAW)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame for SQL access."""
    df.createOrReplaceTempView(name)
    return df
