"""Train/test splits, exact-size samples and random picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.columns import hash_percent
from shelfrank.operators.metadata import one_per_book
from shelfrank.session import checkpointed

HASH_DIGITS, DIGITS_PER_PASS = 32, 4
# So many rows may be sorted in one task whatever n is.
ROWS_IN_ONE_TASK = 100_000


def random_split(ratings: DataFrame, train: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Random [train, test]; the draw depends on how the rows are partitioned."""
    return ratings.randomSplit([train, 1.0 - train], seed)


def in_train(train_percent: int = 80):
    """True for (reviewer, book) pairs on the training side of the hash split."""
    return hash_percent("reviewerID", "asin") < train_percent


def hash_split(ratings: DataFrame, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the pair: the same rows on any cluster, in any run."""
    return ratings.where(in_train(train_percent)), ratings.where(~in_train(train_percent))


def _threshold(hashed: DataFrame, n: int) -> tuple[str, int]:
    """(prefix, rest): rows whose hash comes before the prefix belong to the n rows of least
    hash, and the first `rest` of those that start with it.

    Each pass counts the rows by the next hex digits, 65,536 counters, and the driver gets one
    row of it. It ends when the rows of one prefix are few against a merge of n rows.
    """
    prefix, rest = "", n
    while len(prefix) < HASH_DIGITS:
        digits = F.substring("sample_hash", len(prefix) + 1, DIGITS_PER_PASS).alias("digits")
        counts = hashed.where(F.col("sample_hash").startswith(prefix)).groupBy(digits).count()
        running = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counts.withColumn("upto", F.sum("count").over(running))
        border = summed.where(F.col("upto") >= rest).orderBy("digits").first()
        if border is None:
            return "g", 0  # all rows: no digit comes after f
        prefix, rest = prefix + border["digits"], rest - (border["upto"] - border["count"])
        if border["count"] <= max(n, ROWS_IN_ONE_TASK):
            break
    return prefix, rest


def sample_rows(df: DataFrame, n: int | None, key: str, seed: int | None = None) -> DataFrame:
    """Exactly n rows without replacement, all of them if there are fewer or n is None.

    The rows of least hash of the key are taken, the same every time; a seed gives another
    hash. A counting pass finds the hash up to which all rows belong, so only the rows at that
    border are sorted: no task gets n rows from every partition. Rows with a null key come
    first without a seed, as they do in an order by the hash.
    """
    if n is None:
        return df
    drawn = F.md5(F.col(key).cast("string") if seed is None else F.concat_ws("|", key, F.lit(seed)))
    hashed = df.withColumn("sample_hash", F.coalesce(drawn, F.lit("0" * HASH_DIGITS)))
    prefix, rest = _threshold(hashed, n)
    sure = hashed.where(F.substring("sample_hash", 1, len(prefix)) < prefix)
    edge = hashed.where(F.col("sample_hash").startswith(prefix)).orderBy("sample_hash", key).limit(rest)
    return sure.unionByName(edge).drop("sample_hash")


def random_books(
    ratings: DataFrame, n: int = 5, seed: int | None = None, distinct: bool = False
) -> DataFrame:
    """n random (asin, asin_index, title) drawn from rating rows.

    Popular books are likelier and may repeat, unless `distinct` is set.
    """
    rows = ratings.select("asin", "asin_index", "title")
    if distinct:
        rows = rows.groupBy("asin", "asin_index").agg(F.min("title").alias("title"))
    return rows.orderBy(F.rand(seed)).limit(n)


def covers_for_few(picked: DataFrame, books: DataFrame) -> DataFrame:
    """Add the cover to a handful of picked books.

    The picks come from a limit, so they are safe to broadcast; the metadata is
    filtered in place and never shuffled as a whole.
    """
    picked = checkpointed(picked)
    wanted = F.broadcast(picked.select("asin").distinct())
    covers = one_per_book(books.join(wanted, "asin", "left_semi").select("asin", "imUrl"))
    return picked.join(covers, "asin", "left")
