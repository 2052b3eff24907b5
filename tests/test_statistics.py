import math

from conftest import plan_of, rows
from pyspark.sql import functions as F

from shelfrank.operators import recommend
from shelfrank.operators import statistics as st

ID, MEAN = st.DISPLAY_NAMES["asin"], st.DISPLAY_NAMES["average_rating"]
AVERAGE = "asin string, title string, average_rating double, price double"


def average(spark, ratings):
    return spark.createDataFrame([(f"b{i:02d}", f"T{i}", r, 1.0) for i, r in enumerate(ratings)], AVERAGE)


def test_one_item_stats(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "asin string, overall double")
    assert tuple(st.one_item_stats(df, "a").first()) == (2, 1.5)
    assert tuple(st.one_item_stats(df, "nope").first()) == (0, 0.0)


def test_average_rating_table_keeps_books_without_metadata(spark):
    reviews = spark.createDataFrame([("a", 4.0), ("a", 5.0), ("x", 1.0)], "asin string, overall double")
    books = spark.createDataFrame([("a", "A", 9.5), ("b", "B", 1.0)], "asin string, title string, price double")
    assert rows(st.average_rating_table(reviews, books)) == [("a", "A", 4.5, 9.5), ("x", None, 1.0, None)]


def test_scatter_drops_rows_with_null_or_nan(spark):
    df = spark.createDataFrame(
        [
            ("a", "A", 1.0, 1.0),
            ("b", None, 1.0, 1.0),
            ("c", "C", 1.0, None),
            ("d", "D", 1.0, float("nan")),
        ],
        AVERAGE,
    )
    assert [r.asin for r in st.scatter_frame(df).collect()] == ["a"]


def test_top_and_bottom(spark):
    df = average(spark, [float(x) for x in range(12)])
    top = [r[MEAN] for r in st.top_rated(df).collect()]
    bottom = [r[MEAN] for r in st.bottom_rated(df).collect()]
    assert top == [11.0, 10.0, 9.0, 8.0, 7.0, 6.0, 5.0, 4.0, 3.0, 2.0]
    assert bottom == [9.0, 8.0, 7.0, 6.0, 5.0, 4.0, 3.0, 2.0, 1.0, 0.0]
    assert st.top_rated(df).columns == list(st.DISPLAY_NAMES.values())


def test_ties_follow_the_asin(spark):
    df = average(spark, [3.0] * 5)
    assert [r[ID] for r in st.top_rated(df, 2).collect()] == ["b00", "b01"]
    assert [r[ID] for r in st.bottom_rated(df, 2).collect()] == ["b03", "b04"]


def test_rmse_equals_evaluator(spark):
    df = spark.range(100).select(
        (F.col("id") % 5).cast("double").alias("overall"), F.rand(1).alias("prediction")
    )
    assert math.isclose(st.rmse(df).first()[0], recommend.evaluate_rmse(df), rel_tol=1e-9)


def test_item_mean_rmse_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True), ("a", 3.0, True), ("a", 5.0, False), ("b", 4.0, False)],
        "asin string, overall double, side boolean",
    )
    got = st.item_mean_rmse(df, F.col("side")).first()
    assert tuple(got) == (2, 1, 1.0, 3.0)


def test_one_per_book(spark):
    df = spark.createDataFrame([("a", "T2"), ("a", "T1"), ("b", None)], "asin string, title string")
    assert rows(st.one_per_book(df)) == [("a", "T1"), ("b", None)]


def test_baseline_error_of_equal_ratings_and_of_no_rows(spark):
    df = spark.createDataFrame([("a", "u", 1.1)] * 7, "asin string, reviewerID string, overall double")
    row = st.item_mean_rmse(df, F.lit(True)).first()
    assert (row.n_train, row.n_test, row.train_rmse, row.test_rmse) == (7, 0, 0.0, None)
    none = st.item_mean_rmse(df, F.lit(False)).first()
    assert none.train_rmse is None and none.test_rmse is None


def test_of_several_metadata_rows_the_fullest_counts(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("a", "", 2.0), ("a", "A", 3.0), ("b", "B", None), ("b", None, float("nan")),
         ("c", "Z", 1.0), ("c", "C", 1.0), ("c", "C", 1.0), ("d", None, None)],
        "asin string, title string, price double",
    )
    got = st.one_per_book(df)
    assert rows(got) == rows(spark.createDataFrame(
        [("a", "A", 3.0), ("b", "B", None), ("c", "C", 1.0), ("d", None, None)], df.schema))
    # Only keys are counted over the whole table; no sort moves all texts.
    assert "Window" not in plan_of(got)
