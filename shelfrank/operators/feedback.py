"""Answers of new visitors: parsing, shaping and merging with the ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.columns import index_from_text, rating_from_text

# What a feedback row carries where a rating row has ids and a title.
UNKNOWN_ASIN = "unknown_asin"
VISITOR_NAME = "test_user"
UNKNOWN_TITLE = "random_title"


def answers_from_forms(forms: DataFrame, questions: int = 5) -> DataFrame:
    """One (user_id, book, rating) per pair book0/rating0, book1/rating1, ... of a form."""
    pairs = [
        F.struct(F.col(f"book{i}").alias("book"), F.col(f"rating{i}").alias("rating"))
        for i in range(questions)
    ]
    return forms.select("user_id", F.inline(F.array(*pairs)))


def parse_feedback(raw: DataFrame) -> DataFrame:
    """user_id, asin_index, overall; answers that are no valid book and rating are left out."""
    parsed = raw.select(
        "user_id",
        index_from_text("book").alias("asin_index"),
        rating_from_text("rating").alias("overall"),
    )
    return parsed.na.drop("any")


def feedback_rows(raw: DataFrame) -> DataFrame:
    """Answers in the shape of the ratings table, one visitor id per visitor."""
    return parse_feedback(raw).select(
        F.lit(UNKNOWN_ASIN).alias("asin"),
        "asin_index",
        "overall",
        F.lit(VISITOR_NAME).alias("reviewerID"),
        F.col("user_id").alias("reviewerID_index"),
        F.lit(UNKNOWN_TITLE).alias("title"),
    )


def add_feedback(ratings: DataFrame, feedback: DataFrame) -> DataFrame:
    """Ratings with the feedback rows appended, matched by column name."""
    return ratings.unionByName(feedback.select(*ratings.columns))


def feedback_with_titles(raw: DataFrame, items: DataFrame) -> DataFrame:
    """The visitors' own answers with the titles of the books they rated."""
    return (
        parse_feedback(raw)
        .join(items.select("asin_index", "title"), "asin_index", "left")
        .select("user_id", "asin_index", "title", "overall")
    )
