"""The user-level jobs: each takes frames or paths and composes operators."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import feedback as fb
from shelfrank.operators import recommend as rec
from shelfrank.operators import sampling, search, statistics
from shelfrank.operators.dictionary import IdDictionary
from shelfrank.operators.indexing import clean_ratings, columns_to_index, index_ids, item_dimension
from shelfrank.operators.metadata import one_per_book
from shelfrank.operators.recommend import AlsSettings
from shelfrank.session import checkpointed, scratch, stored, stored_for_now
from shelfrank.sources import readers, sinks, versions
from shelfrank.sources.artefact import save_artefact


def prepare_ratings(raw: DataFrame) -> DataFrame:
    """Cleaned ratings with user and book indices, as a stored table.

    The cleaned rows are written once, because every label count and every
    index join reads them again.
    """
    with stored_for_now(clean_ratings(raw), "cleaned_ratings") as cleaned:
        return stored(index_ids(cleaned), "indexed_ratings")


def prepare_with_dictionaries(raw: DataFrame, dictionaries: str) -> DataFrame:
    """The same with indices from the dictionaries stored in a folder, which first get the new ids.

    An id keeps its index from one batch to the next, so models stay valid.
    """
    spark = raw.sparkSession
    with stored_for_now(clean_ratings(raw), "cleaned_ratings") as cleaned:
        labels = {
            column: IdDictionary(spark, f"{dictionaries}/{column}", column).append(cleaned)
            for column in columns_to_index(cleaned)
        }
        return stored(index_ids(cleaned, dictionaries=labels), "indexed_ratings")


def train_artefact(
    ratings: DataFrame, path: str, settings: AlsSettings = AlsSettings()
) -> int:
    """Fit on all indexed ratings and store model, ids and titles together; the new version."""
    users = ratings.select("reviewerID", rec.USER).distinct()
    return save_artefact(path, rec.fit_als(ratings, settings), users, item_dimension(ratings))


def update_average_sums(path: str, reviews: DataFrame, batch: str) -> DataFrame:
    """Merge the reviews of a batch into the stored rating sums; the merged sums.

    Only sums are read back, never earlier reviews. A batch that has been merged before
    changes nothing, so a job that is run again counts none twice.
    """
    spark = reviews.sparkSession
    schema, done = "asin string, n long, total double", "batch string"
    last = max(versions.committed(spark, path, "batches"), default=None)
    own = statistics.rating_sums(reviews)
    names = spark.createDataFrame([(batch,)], done)
    if last is not None:
        before = versions.folder_of(path, last)
        merged = spark.read.schema(schema).parquet(f"{before}/sums")
        batches = spark.read.schema(done).parquet(f"{before}/batches")
        if not batches.where(F.col("batch") == batch).isEmpty():
            return merged
        own, names = statistics.merged_sums(merged, own), batches.unionByName(names)
    folder = versions.new_folder(spark, path)[1]
    own.select("asin", "n", F.col("total").cast("double")).write.parquet(f"{folder}/sums")
    names.coalesce(1).write.parquet(f"{folder}/batches")
    return spark.read.schema(schema).parquet(f"{folder}/sums")


def titled(reviews: DataFrame, books: DataFrame) -> DataFrame:
    """Raw ratings with the title of their book; ratings of unknown books are dropped."""
    titles = one_per_book(books.select("asin", "title"))
    rows = reviews.select("asin", "overall", "reviewerID")
    return rows.join(titles, "asin").select("asin", "overall", "reviewerID", "title")


def prepare_and_write(raw: DataFrame, path: str) -> None:
    """The same as a file of indexed ratings, written once; no scratch table is left."""
    with scratch(raw.sparkSession):
        cleaned = stored(clean_ratings(raw), "cleaned_ratings")
        sinks.write_ratings(index_ids(cleaned), path)


def train_and_save(
    spark: SparkSession, ratings_path: str, model_path: str, settings: AlsSettings = AlsSettings()
) -> float:
    """Fit on 80 % of the ratings, store the model, return the RMSE on the rest."""
    ratings = readers.as_view(readers.read_ratings(spark, ratings_path), "ratings")
    train, test = sampling.random_split(ratings)
    sinks.save_model(rec.fit_als(train, settings), model_path)
    # Score with the stored factors: they outlive any executor.
    model = sinks.load_model(spark, model_path)
    return rec.evaluate_rmse(rec.predict(model, test))


def train_and_recommend_all(
    spark: SparkSession,
    ratings_path: str,
    output_path: str,
    settings: AlsSettings = AlsSettings(max_iter=5),
    n: int = 5,
    partitions: int | None = None,
) -> ALSModel:
    """Fit on 80 % of the ratings and write the top n of every user as JSON.

    The ratings are dealt into `partitions`, by default as many as there are cores.
    """
    ratings = readers.as_view(readers.read_ratings(spark, ratings_path), "ratings")
    partitions = partitions or spark.sparkContext.defaultParallelism
    with scratch(spark):
        # A stored copy keeps the random split the same when a task is run again.
        train, _ = sampling.random_split(stored(ratings.repartition(partitions), "ratings"))
        model = rec.fit_als(train, settings)
        sinks.write_json(rec.recommend_all(model, n), output_path)
    return model


def recommend_from_model(
    spark: SparkSession,
    model_path: str,
    users: DataFrame,
    ratings: DataFrame,
    n: int = 5,
    exclude_seen: bool = False,
) -> DataFrame:
    """Titled top n for the users of a frame from a stored model; unknown users give no row.

    Titles come from the indexed ratings the model was trained on; with `exclude_seen`, books
    a user rated there are passed over.
    """
    model = sinks.load_model(spark, model_path)
    seen = ratings if exclude_seen else None
    recommended = rec.exploded(rec.recommend_subset(model, users, n, exclude_seen=seen))
    return rec.with_titles(recommended, item_dimension(ratings))


def books_to_rate(
    ratings: DataFrame, books: DataFrame, n: int = 5, seed: int | None = None
) -> DataFrame:
    """n random books with their covers, for a new visitor to rate."""
    return sampling.covers_for_few(sampling.random_books(ratings, n, seed), books)


def recommend_for_feedback(
    ratings: DataFrame,
    raw_feedback: DataFrame,
    books: DataFrame,
    settings: AlsSettings = AlsSettings(),
    n: int = 5,
    method: str = "refit",
    model: ALSModel | None = None,
    exclude_seen: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(own answers with titles, recommendations with titles and covers) for new visitors.

    With "refit", one fit over ratings and answers serves the whole batch of visitors. With
    "fold_in", each visitor's factor is solved against the book factors of `model`, which
    was trained on the ratings before and stays as it is. Titles come from the base
    ratings only, not from the placeholder titles of the feedback rows. Only
    answers about books of the base ratings train: any other book would have no
    title and leave a gap among the recommendations. A visitor with the id of a
    base reviewer is an error, as the fit would take both for one person.
    """
    items = stored(item_dimension(ratings), "items")
    known = fb.feedback_rows(raw_feedback).join(items.select(rec.ITEM), rec.ITEM, "left_semi")
    feedback = stored(known, "feedback")
    visitors = feedback.select(F.col(rec.USER).cast("int").alias("id")).distinct()
    taken = ratings.select(F.col(rec.USER).cast("int").alias("id")).join(visitors, "id", "left_semi")
    if not taken.isEmpty():
        raise ValueError(f"visitor id {taken.first()['id']} belongs to a reviewer of the ratings")
    if method == "fold_in":
        if model is None:
            raise ValueError("folding in needs a trained model")
        lists = rec.recommend_folded(model, feedback, n, settings.reg, exclude_seen=exclude_seen)
    elif method == "refit":
        model = rec.fit_als(fb.add_feedback(ratings, feedback), settings)
        lists = rec.recommend_subset(model, feedback, n, exclude_seen=feedback if exclude_seen else None)
    else:
        raise ValueError(f"no such method for new visitors: {method}")
    recommended = rec.exploded(lists)
    return fb.feedback_with_titles(raw_feedback, items), rec.with_covers(recommended, items, books)


def search_books(books: DataFrame, text: str) -> DataFrame:
    return search.search_titles(books, text)


def book_page(books: DataFrame, reviews: DataFrame, asin: str, url_root: str) -> DataFrame:
    return search.one_book_page(books, reviews, asin, url_root)


def rating_dashboard(
    average: DataFrame, n: int | None = 10_000, seed: int | None = None
) -> dict[str, DataFrame]:
    """Scatter points and the ten best and worst books, all from one and the same sample."""
    sample = checkpointed(statistics.scatter_frame(average, n, seed))
    return {
        "scatter": sample.select("average_rating", "price", "title"),
        "top": statistics.top_rated(sample),
        "bottom": statistics.bottom_rated(sample),
    }


def check_raw_file(spark: SparkSession, path: str, dump_path: str) -> DataFrame:
    """Count the lines of a raw file, broken ones too, and dump them all as they are."""
    lines = readers.read_lines(spark, path)
    sinks.write_text_dump(lines, dump_path)
    return statistics.line_count(lines)
