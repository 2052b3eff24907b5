"""Rating statistics, the dashboard frames and error measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.columns import mean_2dp
from shelfrank.operators.metadata import one_per_book
from shelfrank.operators.sampling import sample_rows

# Column titles of the dashboard tables.
DISPLAY_NAMES = {
    "asin": "Product ID",
    "title": "Title",
    "average_rating": "Average Rating",
    "price": "Price",
}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def line_count(lines: DataFrame) -> DataFrame:
    """Number of raw lines and of those among them that are no JSON, in one row."""
    broken = F.try_parse_json("value").isNull()
    return lines.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(broken, 1)).alias("n_broken")
    )


def item_review_stats(reviews: DataFrame) -> DataFrame:
    """Review count and rounded mean rating of every book."""
    return reviews.groupBy("asin").agg(
        F.count(F.lit(1)).alias("review_no"), mean_2dp("overall").alias("avg_rating")
    )


def one_item_stats(reviews: DataFrame, asin: str) -> DataFrame:
    """The same for one book; always one row, (0, 0.0) if it has no review."""
    return reviews.where(F.col("asin") == asin).agg(
        F.count(F.lit(1)).alias("review_no"), mean_2dp("overall").alias("avg_rating")
    )


def average_rating_table(reviews: DataFrame, books: DataFrame) -> DataFrame:
    """asin, title, average_rating, price of every reviewed book.

    Reviews are reduced to one row per book before the join.
    """
    means = reviews.groupBy("asin").agg(F.avg("overall").alias("average_rating"))
    details = one_per_book(books.select("asin", "title", "price"))
    return means.join(details, "asin", "left").select("asin", "title", "average_rating", "price")


def rating_sums(reviews: DataFrame) -> DataFrame:
    """asin, n and total of the ratings: what averages of several batches are merged from."""
    return reviews.groupBy("asin").agg(F.count("overall").alias("n"), F.sum("overall").alias("total"))


def merged_sums(*parts: DataFrame) -> DataFrame:
    """The sums of several batches as one; a row per book and batch moves, no review."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("asin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def averages_from_sums(sums: DataFrame, books: DataFrame) -> DataFrame:
    """The average-rating table from merged sums, without the reviews."""
    means = sums.select("asin", F.try_divide("total", "n").alias("average_rating"))
    details = one_per_book(books.select("asin", "title", "price"))
    return means.join(details, "asin", "left").select("asin", "title", "average_rating", "price")


def scatter_frame(average: DataFrame, n: int | None = 10_000, seed: int | None = None) -> DataFrame:
    """n sampled books with no value missing: title, average_rating and price."""
    return sample_rows(average.na.drop("any"), n, "asin", seed)


def _display(books: DataFrame) -> DataFrame:
    return books.withColumnsRenamed(DISPLAY_NAMES)


def top_rated(sample: DataFrame, n: int = 10) -> DataFrame:
    """The n best rated, best first."""
    return _display(sample.orderBy(F.desc("average_rating"), "asin").limit(n))


def bottom_rated(sample: DataFrame, n: int = 10) -> DataFrame:
    """The n worst rated, still listed best first."""
    worst = sample.orderBy(F.asc("average_rating"), F.desc("asin")).limit(n)
    return _display(worst.orderBy(F.desc("average_rating"), "asin"))


def rmse(predictions: DataFrame, label: str = "overall") -> DataFrame:
    """Root mean squared error of a `prediction` column and the number of rows, in one row."""
    error = F.col(label) - F.col("prediction")
    return predictions.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.count("prediction").alias("n_scored")
    )


def item_mean_rmse(ratings: DataFrame, is_train: Column) -> DataFrame:
    """RMSE of predicting a book's mean training rating, on the training and held-out rows.

    Squared errors follow from counts, means and variances per book, so one
    aggregate over the ratings is enough. Held-out rows of books without
    training rows are not scored; the error of no rows is null.
    """
    sides = {"train": is_train, "test": ~is_train}
    measures = {"n": F.count, "mean": F.avg, "spread": F.var_pop}
    sums = [
        measure(F.when(side, F.col("overall"))).alias(f"{name}_{part}")
        for name, side in sides.items()
        for part, measure in measures.items()
    ]
    per_item = ratings.groupBy("asin").agg(*sums).where("train_n > 0")

    def error(name: str) -> Column:
        n, mean, spread = (F.col(f"{name}_{part}") for part in measures)
        off = mean - F.col("train_mean")
        squared = F.coalesce(n * (spread + off * off), F.lit(0.0))
        return F.sqrt(F.try_divide(F.sum(squared), F.sum(n)))

    return per_item.agg(
        F.sum("train_n").cast("bigint").alias("n_train"),
        F.sum("test_n").cast("bigint").alias("n_test"),
        F.round(error("train"), 6).alias("train_rmse"),
        F.round(error("test"), 6).alias("test_rmse"),
    )
