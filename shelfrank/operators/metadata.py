"""One rule for books that the metadata lists more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def _is_blank(books: DataFrame, column: str) -> Column:
    kind, value = books.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        return F.coalesce(F.length(value), F.lit(0)) == 0
    if isinstance(kind, DoubleType | FloatType):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def one_per_book(books: DataFrame) -> DataFrame:
    """Metadata with one row per asin; of repeated rows every column keeps its best value.

    Blank is null, an empty text or NaN. A value that is not blank beats a blank one, then that
    of the row with fewer blanks, then the smaller value. Only the keys are counted over
    the whole table; texts move for books that are listed more than once.
    """
    rest = [c for c in books.columns if c != "asin"]
    counts = books.groupBy("asin").agg(F.count(F.lit(1)).alias("n"))
    again = counts.where("n > 1").select("asin")
    blanks = sum((_is_blank(books, c).cast("int") for c in rest), F.lit(0))
    repeated = books.join(again, "asin", "left_semi").withColumn("blanks", blanks)
    best = [F.min(F.struct(_is_blank(books, c).alias("blank"), "blanks", c)).alias(c) for c in rest]
    picked = [F.when(~F.col(c)["blank"], F.col(c)[c]).alias(c) for c in rest]
    merged = repeated.groupBy("asin").agg(*best).select("asin", *picked) if rest else again
    # A null asin joins nothing and stays as it is listed.
    single = books.join(again, "asin", "left_anti")
    return single.select(*books.columns).unionByName(merged.select(*books.columns))
