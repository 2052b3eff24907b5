"""Cleaning of raw ratings and frequency-ordered id indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.numbering import numbered
from shelfrank.session import stored

NOT_INDEXED = ("overall", "title")


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """Drop ratings without reviewer, book or value (null or NaN)."""
    return ratings.na.drop("any", subset=["reviewerID", "asin", "overall"])


def columns_to_index(ratings: DataFrame) -> list[str]:
    """All columns but the rating and the title."""
    return [c for c in ratings.columns if c not in NOT_INDEXED]


def frequency_index(rows: DataFrame, label: str) -> DataFrame:
    """One row per label: the label, its count and its index.

    The most frequent label gets 0 and ties follow the label, as StringIndexer
    numbers them. StringIndexer keeps every label in driver memory; these
    indices are numbered on the executors.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    index = F.col("number").cast("int").alias(f"{label}_index")
    return numbered(counts, F.desc("n"), label).select(label, "n", index)


def index_ids(
    ratings: DataFrame,
    columns: Sequence[str] | None = None,
    dictionaries: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Add `<column>_index` for each id column; rows with a null id are left out.

    `dictionaries` are stored label tables to use instead of new indices; rows whose label
    is not in them are left out.

    The label tables are stored first, so Spark knows their sizes when it plans
    the joins: a small one is broadcast and the ratings stay where they are. A
    larger one is joined by shuffle on the ids, where the adaptive skew join
    splits a label that holds a large share of the rows.
    """
    out = ratings
    for column in columns if columns is not None else columns_to_index(ratings):
        if dictionaries and column in dictionaries:
            labels = dictionaries[column]
        else:
            labels = stored(frequency_index(ratings, column).drop("n"), f"{column}_labels")
        out = out.join(labels, column)
    return out


def item_dimension(ratings: DataFrame) -> DataFrame:
    """One (asin_index, asin, title) per book, whatever the titles on its rating rows.

    Of several candidates the smallest is taken, a blank title only if there is
    no other. Equal rows collapse in hash tables before anything moves or is
    sorted, so a popular book costs no more than any other.
    """
    index = F.col("asin_index").cast("int").alias("asin_index")
    variants = ratings.select(index, "asin", "title").distinct()
    blank = (F.coalesce(F.length("title"), F.lit(0)) == 0).alias("blank")
    return (
        variants.groupBy("asin_index")
        .agg(F.min(F.struct(blank, "asin", "title")).alias("pick"))
        .select("asin_index", "pick.asin", "pick.title")
    )
