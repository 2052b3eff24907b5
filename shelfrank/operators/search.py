"""Title search, book pages and review lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.columns import cover_or_placeholder, or_default
from shelfrank.operators.metadata import one_per_book
from shelfrank.operators.statistics import item_review_stats

REVIEW_COLUMNS = ("summary", "reviewerName", "reviewText", "overall")


def search_titles(
    books: DataFrame, text: str, limit: int = 50, wildcards: bool = False
) -> DataFrame:
    """Books whose title starts with the text, case-sensitively.

    The text is matched literally; with `wildcards`, % and _ keep their LIKE
    meaning. What comes before the first of them reaches the scan as a string-prefix
    filter.
    """
    title = F.col("title")
    literal = re.match(r"[^%_\\]*", text)[0] if wildcards else text
    matches = title.startswith(literal)
    if wildcards:
        matches = matches & title.like(text + "%")
    return books.where(matches).select("imUrl", "title", "asin").orderBy("title", "asin").limit(limit)


def review_order(reviews: DataFrame) -> list[Column]:
    """Best rating first; then all other columns at hand, so that no two different
    reviews are level."""
    rest = [c for c in ("reviewerID", *REVIEW_COLUMNS) if c in reviews.columns and c != "overall"]
    return [F.desc("overall"), *[F.asc(c) for c in rest]]


def reviews_for_item(reviews: DataFrame, asin: str, n: int = 10) -> DataFrame:
    """Up to n reviews of one book, best rating first."""
    return (
        reviews.where(F.col("asin") == asin)
        .orderBy(*review_order(reviews))
        .select(*REVIEW_COLUMNS)
        .limit(n)
    )


def top_reviews_per_item(reviews: DataFrame, n: int = 10) -> DataFrame:
    """The first n reviews of every book, numbered from 1.

    Spark cuts each book to n rows per task before the shuffle (window group
    limit), so a book with very many reviews does not end up in one task. It does so
    up to n = 1000, its setting spark.sql.optimizer.windowGroupLimitThreshold.
    """
    order = Window.partitionBy("asin").orderBy(*review_order(reviews))
    return reviews.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= n)


def book_details(books: DataFrame, reviews: DataFrame, url_root: str) -> DataFrame:
    """Page header of every book: metadata with defaults, review count and mean rating."""
    page = one_per_book(books).join(item_review_stats(reviews), "asin", "left")
    return page.select(
        "asin",
        or_default("title", "").alias("title"),
        cover_or_placeholder("imUrl", url_root).alias("cover"),
        "description",
        F.coalesce("review_no", F.lit(0)).alias("review_no"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
    )


def book_pages(details: DataFrame, first_reviews: DataFrame) -> DataFrame:
    """Page headers with the books' first reviews as an array, empty if there are none."""
    entry = F.struct("pos", *REVIEW_COLUMNS)
    lists = first_reviews.groupBy("asin").agg(
        F.sort_array(F.collect_list(entry)).alias("reviews")
    )
    pages = details.join(lists, "asin", "left")
    return pages.withColumn("reviews", F.coalesce("reviews", F.array()))


def one_book_page(
    books: DataFrame, reviews: DataFrame, asin: str, url_root: str, n: int = 10
) -> DataFrame:
    """The page of one book; no row if the book is unknown."""
    book, own = books.where(F.col("asin") == asin), reviews.where(F.col("asin") == asin)
    return book_pages(book_details(book, own, url_root), top_reviews_per_item(own, n))
