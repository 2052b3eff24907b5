"""Matrix factorisation and top-k recommendations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.metadata import one_per_book
from shelfrank.operators.scoring import best_items, nested
from shelfrank.operators.split_als import fit_split_als, rating_sums, rating_value, solved
from shelfrank.session import checkpointed, kept, use_checkpoints

# Book factors are broadcast for scoring in slices of at most this size.
SLICE_BYTES = 256 << 20
ROWS_PER_BLOCK = 10_000_000
USERS_PER_PARTITION = 100_000

USER, ITEM, RATING = "reviewerID_index", "asin_index", "overall"


@dataclass(frozen=True)
class AlsSettings:
    """Training settings; `blocks` follows from the cluster and the data when left out.

    `method` is the caller's choice alone, whatever the data. "split" sums the normal
    equations of a user or book by parts of its ratings, so that no group lies in one task;
    `blocks` and `checkpoint_interval` are of no meaning to it. "blocks" is Spark's ALS, which
    keeps all ratings of one user or book in one task: its limit is the memory of a task. The
    two start from different first factors.
    """

    max_iter: int = 20
    reg: float = 0.01
    rank: int = 10
    seed: int = 42
    blocks: int | None = None
    checkpoint_interval: int = 5
    method: str = "split"


def als_triples(ratings: DataFrame) -> DataFrame:
    return ratings.select(USER, ITEM, RATING)


def als_blocks(spark: SparkSession, rows: int) -> int:
    """A block per core, more if blocks would exceed ROWS_PER_BLOCK.

    Each partitioning task of Spark's ALS holds a small buffer per pair of blocks.
    """
    return max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_BLOCK + 1)


def fit_als(ratings: DataFrame, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Explicit-feedback ALS on all rows; repeated pairs count as often as they occur.

    A null or NaN rating and a fractional index are errors.
    """
    spark = ratings.sparkSession
    use_checkpoints(spark)
    if settings.method == "split":
        return fit_split_als(als_triples(ratings), settings)
    if settings.method != "blocks":
        raise ValueError(f"no such training method: {settings.method}")
    # Sizes and fit read the ratings several times; keep the three columns meanwhile.
    checked = als_triples(ratings).withColumn(RATING, rating_value())
    with kept(checked) as triples:
        blocks = settings.blocks or als_blocks(spark, triples.count())
        als = ALS(
            rank=settings.rank,
            maxIter=settings.max_iter,
            regParam=settings.reg,
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            userCol=USER,
            itemCol=ITEM,
            ratingCol=RATING,
            coldStartStrategy="drop",
            checkpointInterval=settings.checkpoint_interval,
            seed=settings.seed,
        )
        return als.fit(triples)


def predict(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Rows with a `prediction`; rows of users or books the model has not seen are dropped."""
    return model.transform(ratings)


def evaluate_rmse(predictions: DataFrame) -> float:
    evaluator = RegressionEvaluator(metricName="rmse", labelCol=RATING, predictionCol="prediction")
    return evaluator.evaluate(predictions)


def _spread(users: DataFrame) -> DataFrame:
    """Users dealt evenly, over all cores and into partitions of a bounded size."""
    cores = users.sparkSession.sparkContext.defaultParallelism
    return users.repartition(max(cores, users.count() // USERS_PER_PARTITION + 1), "id")


def seen_pairs(ratings: DataFrame) -> DataFrame:
    """Distinct (id, item) of rated books; repeated ratings collapse before anything moves."""
    user, item = F.col(USER).cast("int").alias("id"), F.col(ITEM).cast("int").alias("item")
    return ratings.select(user, item).distinct()


def recommend_all(
    model: ALSModel, n: int = 5, slice_bytes: int = SLICE_BYTES, exclude_seen: DataFrame | None = None
) -> DataFrame:
    """Top n books for every user, as an array of (asin_index, rating) per user.

    With `exclude_seen`, a table of ratings, books that a user rated there are passed over; a
    user with fewer than n others gets those.
    """
    users = _spread(model.userFactors)
    hidden = None if exclude_seen is None else seen_pairs(exclude_seen)
    return nested(best_items(users, model, n, slice_bytes, hidden), USER, ITEM)


def recommend_subset(
    model: ALSModel,
    users: DataFrame,
    n: int = 5,
    slice_bytes: int = SLICE_BYTES,
    exclude_seen: DataFrame | None = None,
) -> DataFrame:
    """The same for the users in the frame; users the model does not know give no row."""
    wanted = users.select(F.col(USER).cast("int").alias("id")).distinct()
    factors = _spread(model.userFactors.join(wanted, "id", "left_semi"))
    hidden = None if exclude_seen is None else seen_pairs(exclude_seen).join(wanted, "id", "left_semi")
    return nested(best_items(factors, model, n, slice_bytes, hidden), USER, ITEM)


def fold_in(model: ALSModel, feedback: DataFrame, reg: float = AlsSettings.reg) -> DataFrame:
    """(id, features) of new users from their ratings of known books, without training.

    Each solves the ridge system that a half step of training would solve against the model's
    book factors, its regularisation scaled by their number of ratings. Ratings of books
    the model does not know count for nothing; users with no other give no row. The ratings of a
    user meet before they are summed, as the sums of few ratings take more room than these; a
    partition that a user with very many ratings makes large is split at run time, so they are no
    hot group.
    """
    rank = model.rank
    rated = als_triples(feedback).select(
        F.col(USER).cast("int").alias("id"), F.col(ITEM).cast("int").alias("item"), rating_value().alias("total")
    )
    books = model.itemFactors.select(F.col("id").alias("item"), "features")
    met = rated.join(books, "item").select("id", "total", "features").hint("rebalance", "id").sortWithinPartitions("id")
    sums = met.mapInArrow(rating_sums, "id int, n double, sums array<double>, targets array<int>")
    together = sums.repartition("id").sortWithinPartitions("id")
    found = together.mapInArrow(solved(rank, reg), "id int, f array<float>, targets array<int>")
    return found.select("id", F.col("f").alias("features"))


def recommend_folded(
    model: ALSModel,
    feedback: DataFrame,
    n: int = 5,
    reg: float = AlsSettings.reg,
    slice_bytes: int = SLICE_BYTES,
    exclude_seen: bool = False,
) -> DataFrame:
    """Top n books for new users from their feedback and a trained model as it is."""
    users = _spread(checkpointed(fold_in(model, feedback, reg)))
    hidden = seen_pairs(feedback) if exclude_seen else None
    return nested(best_items(users, model, n, slice_bytes, hidden), USER, ITEM)


def for_user(recommendations: DataFrame, user: int) -> DataFrame:
    return recommendations.where(F.col(USER) == user)


def exploded(recommendations: DataFrame) -> DataFrame:
    """One row per recommendation: user, rank from 1, book index, predicted rating."""
    rows = recommendations.select(USER, F.posexplode("recommendations").alias("pos", "rec"))
    return rows.select(
        USER,
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.asin_index").alias(ITEM),
        F.col("rec.rating").alias("rating"),
    )


def catalogue(items: DataFrame, books: DataFrame) -> DataFrame:
    """asin_index, asin, title, imUrl; one row per book, so recommendations join only once."""
    covers = one_per_book(books.select("asin", "imUrl"))
    return items.join(covers, "asin", "left").select(ITEM, "asin", "title", "imUrl")


def with_titles(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Exploded recommendations with asin and title; those without a title are dropped."""
    named = rows.join(items, ITEM).where(F.length("title") > 0)
    return named.select(USER, "rank", ITEM, "rating", *[c for c in items.columns if c != ITEM])


def with_covers(rows: DataFrame, items: DataFrame, books: DataFrame) -> DataFrame:
    """Exploded recommendations with asin, title and cover."""
    return with_titles(rows, catalogue(items, books))
