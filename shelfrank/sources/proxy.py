"""Book tables derived from the order tables of the test data.

A line item stands for one review: the customer is the reviewer, the part is
the book and the quantity gives the rating. Events stand for visitors' answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First id given to visitors, above every indexed reviewer.
FIRST_VISITOR = 2000000001


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def part(spark: SparkSession, folder: str, asin: str | None = None) -> DataFrame:
    """Books; with `asin` the one row of that book."""
    books = table(spark, folder, "part")
    return books if asin is None else books.where(F.col("p_partkey") == F.lit(asin).try_cast("bigint"))


def ratings(spark: SparkSession, folder: str, asin: str | None = None) -> DataFrame:
    """reviewerID, asin, overall, summary; `asin` filters on the stored key at the scan."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    if asin is not None:
        lines = lines.where(F.col("l_partkey") == F.lit(asin).try_cast("bigint"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("reviewerID"),
        F.col("l_partkey").cast("string").alias("asin"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("overall"),
        F.col("o_orderpriority").alias("summary"),
    )


def with_text(
    spark: SparkSession, folder: str, rows: DataFrame, asin: str | None = None
) -> DataFrame:
    """Add reviewerName and reviewText; call it after filters and limits.

    With `asin`, all rows are of that book: its text is a single row, and the
    rows of a popular book need not meet in one place to get it.
    """
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("reviewerID"),
        F.col("c_name").alias("reviewerName"),
    )
    texts = part(spark, folder, asin).select(
        F.col("p_partkey").cast("string").alias("asin"),
        F.concat("p_name", F.lit(" "), "p_type").alias("reviewText"),
    )
    return rows.join(people, "reviewerID").join(F.broadcast(texts) if asin else texts, "asin")


def reviews(spark: SparkSession, folder: str, asin: str | None = None) -> DataFrame:
    """The full review table."""
    return with_text(spark, folder, ratings(spark, folder, asin), asin).select(
        "asin", "reviewerID", "reviewerName", "summary", "reviewText", "overall"
    )


def titled_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw ratings with the title on every row, ready for id indexing."""
    titles = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("asin"), F.col("p_name").alias("title")
    )
    rows = ratings(spark, folder).select("reviewerID", "asin", "overall")
    return rows.join(titles, "asin").select("asin", "overall", "reviewerID", "title")


def books(spark: SparkSession, folder: str, asin: str | None = None) -> DataFrame:
    """Book metadata; most books have no cover."""
    parts = part(spark, folder, asin)
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("imUrl"))
    return parts.join(pages, parts.p_partkey == pages.page_id, "left").select(
        F.col("p_partkey").cast("string").alias("asin"),
        F.col("p_name").alias("title"),
        "imUrl",
        F.concat("p_brand", F.lit(" "), "p_type").alias("description"),
        F.col("p_retailprice").alias("price"),
    )


def feedback_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Visitors' answers as typed: text, some of it malformed or out of range."""
    events = table(spark, folder, "events")
    number = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select(
        (F.col("user_id") + FIRST_VISITOR).cast("int").alias("user_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("book "), number))
        .when(F.col("event_type") == "view", F.concat(number, F.lit(".0")))
        .otherwise(number)
        .alias("book"),
        F.ceil(F.col("value") / 10).cast("string").alias("rating"),
    )


def feedback_forms(spark: SparkSession, folder: str) -> DataFrame:
    """One form per order: line n gives the pair book<n-1>, rating<n-1>; most have gaps."""
    lines = table(spark, folder, "lineitem")
    rating = F.ceil(F.col("l_quantity") / 10)
    answers = [
        F.max(F.when(F.col("l_linenumber") == i + 1, value)).cast("string").alias(f"{name}{i}")
        for i in range(5)
        for name, value in (("book", F.col("l_partkey")), ("rating", rating))
    ]
    user = F.col("l_orderkey").cast("int").alias("user_id")
    return lines.groupBy(user).agg(*answers)
