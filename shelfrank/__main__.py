"""spark-submit entry point: one job per call."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfrank.operators import statistics
from shelfrank.plans import jobs
from shelfrank.session import build_session, scratch
from shelfrank.sources import readers, schemas, sinks
from shelfrank.sources.artefact import load_artefact
from shelfrank.sources.quarantine import read_and_quarantine


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfrank")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, arguments in {
        "prepare": ("titled_reviews", "output"),
        "prepare-untitled": ("reviews", "books", "output"),
        "prepare-batch": ("titled_reviews", "dictionaries", "output", "quarantine"),
        "train": ("ratings", "model"),
        "train-artefact": ("ratings", "artefact"),
        "recommend-all": ("ratings", "output"),
        "recommend-reviewers": ("artefact", "reviewers", "output"),
        "recommend": ("model", "users", "ratings", "output"),
        "feedback": ("ratings", "answers", "books", "output"),
        "check-raw": ("reviews", "output"),
        "search": ("books", "text"),
        "page": ("books", "reviews", "asin", "url_root"),
        "dashboard": ("average_ratings",),
        "update-averages": ("reviews", "batch", "sums", "books", "output"),
        "books-to-rate": ("ratings", "books"),
    }.items():
        command = commands.add_parser(name)
        for argument in arguments:
            command.add_argument(argument)
    args = parser.parse_args(argv)

    spark = build_session()
    with scratch(spark):
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    """All files are JSON lines; tables to look at are printed."""
    if args.job == "prepare":
        schema = "asin string, overall double, reviewerID string, title string"
        raw = readers.read_files(spark, args.titled_reviews, schema)
        jobs.prepare_and_write(raw, args.output)
    elif args.job == "prepare-batch":
        schema = "asin string, overall double, reviewerID string, title string"
        good = read_and_quarantine(spark, args.titled_reviews, schema, args.quarantine)
        sinks.write_ratings(jobs.prepare_with_dictionaries(good, args.dictionaries), args.output)
    elif args.job == "train-artefact":
        print("version", jobs.train_artefact(readers.read_ratings(spark, args.ratings), args.artefact))
    elif args.job == "recommend-reviewers":
        reviewers = readers.read_files(spark, args.reviewers, "reviewerID string")
        sinks.write_json(load_artefact(spark, args.artefact).recommend(reviewers), args.output)
    elif args.job == "update-averages":
        sums = jobs.update_average_sums(args.sums, readers.read_reviews(spark, args.reviews), args.batch)
        table = statistics.averages_from_sums(sums, readers.read_books(spark, args.books))
        sinks.write_json(table, args.output)
    elif args.job == "prepare-untitled":
        reviews = readers.read_reviews(spark, args.reviews)
        titled = jobs.titled(reviews, readers.read_books(spark, args.books))
        jobs.prepare_and_write(titled, args.output)
    elif args.job == "train":
        print("rmse", jobs.train_and_save(spark, args.ratings, args.model))
    elif args.job == "recommend-all":
        jobs.train_and_recommend_all(spark, args.ratings, args.output)
    elif args.job == "recommend":
        users = readers.read_files(spark, args.users, "reviewerID_index int")
        ratings = readers.read_ratings(spark, args.ratings)
        found = jobs.recommend_from_model(spark, args.model, users, ratings)
        sinks.write_json(found, args.output)
    elif args.job == "feedback":
        answers = readers.read_files(spark, args.answers, schemas.FEEDBACK_RAW)
        ratings, books = readers.read_ratings(spark, args.ratings), readers.read_books(spark, args.books)
        echo, found = jobs.recommend_for_feedback(ratings, answers, books)
        echo.show(truncate=False)
        sinks.write_json(found, args.output)
    elif args.job == "search":
        jobs.search_books(readers.read_books(spark, args.books), args.text).show(50, truncate=False)
    elif args.job == "page":
        books, reviews = readers.read_books(spark, args.books), readers.read_reviews(spark, args.reviews)
        jobs.book_page(books, reviews, args.asin, args.url_root).show(truncate=False)
    elif args.job == "dashboard":
        frames = jobs.rating_dashboard(readers.read_average_ratings(spark, args.average_ratings))
        for name in ("top", "bottom"):
            frames[name].show(truncate=False)
    elif args.job == "books-to-rate":
        ratings, books = readers.read_ratings(spark, args.ratings), readers.read_books(spark, args.books)
        jobs.books_to_rate(ratings, books).show(truncate=False)
    else:
        jobs.check_raw_file(spark, args.reviews, args.output).show()


if __name__ == "__main__":
    main()
