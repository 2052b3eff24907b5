import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfrank.functions import columns as c


@pytest.mark.parametrize(
    "text, index",
    [
        ("12", 12),
        ("12.0", 12),
        ("0", 0),
        ("x", None),
        ("", None),
        (None, None),
        ("0.5", None),
        ("-1", None),
        ("2147483647", 2147483647),
        ("2147483648", None),
        ("NaN", None),
        ("Infinity", None),
    ],
)
def test_index_from_text(spark, text, index):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(c.index_from_text("t")).first()[0] == index


@pytest.mark.parametrize(
    "text, rating",
    [("1", 1.0), ("5", 5.0), ("0", None), ("6", None), ("4.5", None), ("four", None), (None, None)],
)
def test_rating_from_text(spark, text, rating):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(c.rating_from_text("t")).first()[0] == rating


def test_defaults_replace_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "t string")
    got = df.select(c.or_default("t", "d"), c.cover_or_placeholder("t", "http://h/"))
    cover = "http://h/static/image404.png"
    assert rows(got) == [("d", cover), ("d", cover), ("x", "x")]


@pytest.mark.parametrize(
    "values, mean",
    [([2.67, 2.68], 2.68), ([0.125], 0.13), ([1.0, 2.0, 2.0], 1.67), ([], 0.0)],
)
def test_mean_rounds_half_up(spark, values, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(c.mean_2dp("v")).first()[0] == mean


def test_hash_percent_ignores_partitioning(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit("b").alias("b"))
    one = rows(df.repartition(1).select("a", c.hash_percent("a", "b")))
    many = rows(df.repartition(7).select("a", c.hash_percent("a", "b")))
    assert one == many
    assert {percent for _, percent in one} <= set(range(100))
