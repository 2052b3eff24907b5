import pytest
from conftest import plan_of, rows
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from shelfrank.operators import indexing
from shelfrank.session import stored
from shelfrank.sources import proxy

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ratings(spark):
    return stored(proxy.titled_ratings(spark, FOLDER), "titled")


@pytest.fixture(scope="module")
def hot_ratings(ratings):
    """A third of all rows are one book, most of them copies of one rating."""
    hot = F.rand(5) < 0.34
    return stored(
        ratings.withColumn("hot", hot).select(
            F.when(F.col("hot"), "1").otherwise(F.col("asin")).alias("asin"),
            "overall",
            F.when(F.col("hot") & (F.col("overall") > 1), "9")
            .otherwise(F.col("reviewerID"))
            .alias("reviewerID"),
            "title",
        ).repartition(8),
        "hot",
    )


def test_clean_drops_null_and_nan(spark):
    good = ("a", "u", 1.0)
    bad = [(None, "u", 1.0), ("a", None, 1.0), ("a", "u", None), ("a", "u", float("nan"))]
    df = spark.createDataFrame([good, *bad], "asin string, reviewerID string, overall double")
    assert rows(indexing.clean_ratings(df)) == [good]


def test_ties_follow_the_label(spark):
    df = spark.createDataFrame([(x,) for x in "cbbad"], "label string")
    got = {r.label: r.label_index for r in indexing.frequency_index(df, "label").collect()}
    assert got == {"b": 0, "a": 1, "c": 2, "d": 3}


def test_null_labels_get_no_index(spark):
    df = spark.createDataFrame([("a",), (None,)], "label string")
    assert rows(indexing.frequency_index(df, "label")) == [("a", 1, 0)]


@pytest.mark.parametrize("data", ["ratings", "hot_ratings"])
@pytest.mark.parametrize("column", ["asin", "reviewerID"])
def test_equals_string_indexer(request, data, column):
    df = request.getfixturevalue(data)
    ours = indexing.index_ids(df, [column]).groupBy(column, f"{column}_index").count()
    model = StringIndexer(inputCol=column, outputCol="i").fit(df)
    theirs = model.transform(df).groupBy(column, F.col("i").cast("int")).count()
    assert rows(ours) == rows(theirs)


def test_indices_are_dense_whatever_the_partitions(ratings, settings):
    n = ratings.select("asin").distinct().count()
    settings(adaptive__coalescePartitions__enabled="false", shuffle__partitions="13")
    index = indexing.frequency_index(ratings, "asin")
    assert [r.asin_index for r in index.orderBy("asin_index").collect()] == list(range(n))


def test_columns_to_index(ratings):
    assert sorted(indexing.columns_to_index(ratings)) == ["asin", "reviewerID"]


def test_hot_book_is_split_between_tasks(hot_ratings, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        files__maxPartitionBytes="8KB",
        shuffle__partitions="16",
    )
    indexed = indexing.index_ids(hot_ratings, ["asin"])
    plan = plan_of(indexed)
    assert "skew=true" in plan
    assert indexed.count() == hot_ratings.count()


def test_item_dimension_prefers_a_title(spark):
    df = spark.createDataFrame(
        [(0.0, "a", ""), (0.0, "a", "T"), (0.0, "a", None), (1.0, "b", ""), (1.0, "b", "")],
        "asin_index double, asin string, title string",
    )
    assert rows(indexing.item_dimension(df)) == [(0, "a", "T"), (1, "b", "")]
