"""Dictionaries that grow, artefacts that notice other ids, folders of versions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfrank.operators import recommend as rec
from shelfrank.operators.dictionary import IdDictionary, new_indices
from shelfrank.operators.indexing import frequency_index, item_dimension
from shelfrank.plans import jobs
from shelfrank.session import scratch_path, stored
from shelfrank.sources import artefact, versions

QUICK = rec.AlsSettings(max_iter=2, rank=3)


def labelled(spark, *labels):
    return spark.createDataFrame([(x,) for x in labels], "asin string")


def test_old_labels_keep_their_index(spark):
    words = IdDictionary(spark, scratch_path(spark, "ids"), "asin")
    assert rows(words.append(labelled(spark, "b", "b", "a", None))) == [("a", 1), ("b", 0)]
    # The second batch has other frequencies; ties among the new ones follow the label.
    grown = words.append(labelled(spark, "a", "a", "a", "d", "c", "e", "e", "b"))
    assert rows(grown) == [("a", 1), ("b", 0), ("c", 3), ("d", 4), ("e", 2)]
    assert rows(words.append(labelled(spark, "a", "e"))) == rows(grown)
    assert rows(words.read(1)) == [("a", 1), ("b", 0)]
    assert words.append(labelled(spark)).count() == 5


def test_first_indices_are_those_of_the_frequency_index(spark):
    df = spark.range(3000).select(F.concat(F.lit("b"), (F.col("id") * F.col("id")) % 97).alias("asin"))
    want = frequency_index(df, "asin").select("asin", "asin_index")
    assert rows(new_indices(df, "asin")) == rows(want)


def test_more_labels_than_an_index_can_number(spark):
    known = spark.createDataFrame([("a", 2147483646)], "asin string, asin_index int")
    assert rows(new_indices(labelled(spark, "b"), "asin", known)) == [("b", 2147483647)]
    with pytest.raises(Exception, match="32-bit"):
        new_indices(labelled(spark, "b", "c"), "asin", known).collect()


def test_a_version_without_its_last_part_is_no_version(spark):
    path = scratch_path(spark, "versions")
    assert versions.committed(spark, path) == []
    number, folder = versions.new_folder(spark, path)
    spark.range(1).write.parquet(f"{folder}/rows")
    assert versions.committed(spark, path, "done") == []
    assert versions.new_folder(spark, path)[0] == number + 1
    spark.range(1).write.parquet(f"{folder}/done")
    assert versions.committed(spark, path, "done") == [number]


@pytest.fixture(scope="module")
def raw(spark):
    draw = F.pmod(F.xxhash64("id"), F.lit(7))
    df = spark.range(4000).select(
        F.format_string("b%02d", F.col("id") % 40).alias("asin"),
        (draw % 5 + 1).cast("double").alias("overall"),
        F.format_string("r%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(150))).alias("reviewerID"),
        F.concat(F.lit("Title "), F.col("id") % 40).alias("title"),
    )
    return stored(df, "raw")


def test_prepare_again_keeps_a_model_valid(spark, raw):
    ids, path = scratch_path(spark, "ids"), scratch_path(spark, "model")
    first = jobs.prepare_with_dictionaries(raw.where("asin < 'b30'"), ids)
    version = jobs.train_artefact(first, path, QUICK)
    loaded = artefact.load_artefact(spark, path)
    assert loaded.version == version
    second = jobs.prepare_with_dictionaries(raw, ids)
    assert second.count() == raw.count()
    loaded.check_ids(second)
    # Indices made anew are others: the artefact refuses them.
    anew = jobs.prepare_ratings(raw.where("reviewerID != 'r007'"))
    with pytest.raises(ValueError, match="has index"):
        loaded.check_ids(anew)
    with pytest.raises(ValueError, match="has index"):
        loaded.recommend(raw, exclude_seen=anew)


def test_recommend_from_the_artefact_alone(spark, raw):
    path = scratch_path(spark, "model")
    indexed = jobs.prepare_ratings(raw)
    jobs.train_artefact(indexed, path, QUICK)
    loaded = artefact.load_artefact(spark, path)
    asked = spark.createDataFrame([("r001",), ("r002",), ("r001",), ("nobody",), (None,)], "reviewerID string")
    got = loaded.recommend(asked, 3, exclude_seen=indexed)
    assert rows(got.groupBy("reviewerID").count()) == [("r001", 3), ("r002", 3)]
    assert got.where(F.concat(F.lit("Title "), F.substring("asin", 2, 2).cast("int")) != F.col("title")).count() == 0
    assert got.join(raw, ["reviewerID", "asin"], "left_semi").count() == 0


def test_versions_and_damage(spark, raw):
    path = scratch_path(spark, "model")
    indexed = jobs.prepare_ratings(raw)
    model = rec.fit_als(indexed, QUICK)
    users, items = indexed.select("reviewerID", rec.USER).distinct(), item_dimension(indexed)
    assert [artefact.save_artefact(path, model, users, items) for _ in range(2)] == [1, 2]
    assert artefact.load_artefact(spark, path).version == 2
    assert artefact.load_artefact(spark, path, 1).items.count() == 40
    with pytest.raises(ValueError, match="no version 7"):
        artefact.load_artefact(spark, path, 7)
    with pytest.raises(ValueError, match="no version"):
        artefact.load_artefact(spark, scratch_path(spark, "nothing"))
    items.where("asin_index != 3").write.mode("overwrite").parquet(f"{versions.folder_of(path, 2)}/items")
    with pytest.raises(ValueError, match="items of version 2"):
        artefact.load_artefact(spark, path)
    assert artefact.load_artefact(spark, path, verify=False).version == 2


def test_digest_does_not_depend_on_order_but_on_every_value(spark, raw):
    assert artefact.digest(raw) == artefact.digest(raw.repartition(7).select(*reversed(raw.columns)))
    other = raw.withColumn("overall", F.when(F.col("title") == "Title 3", 1.0).otherwise(F.col("overall")))
    assert artefact.digest(raw) != artefact.digest(other)
    assert artefact.digest(raw.limit(0))[0] == 0


def test_fold_in_and_refit_recommend_the_same_visitors(spark, raw):
    indexed = jobs.prepare_ratings(raw)
    model = rec.fit_als(indexed, QUICK)
    books = raw.select("asin", "title").distinct().withColumn("imUrl", F.lit(None).cast("string"))
    answers = [(2000000001, "1", "5"), (2000000001, "2", "1"), (2000000002, "3", "4"), (2000000003, "4000", "4")]
    feedback = spark.createDataFrame(answers, "user_id int, book string, rating string")
    lists = {}
    for method in ("refit", "fold_in"):
        echo, got = jobs.recommend_for_feedback(
            indexed, feedback, books, QUICK, 4, method=method, model=model, exclude_seen=True
        )
        assert echo.count() == 4
        lists[method] = rows(got.select("reviewerID_index", "rank"))
        rated = {(2000000001, 1), (2000000001, 2), (2000000002, 3)}
        assert not rated & {(r.reviewerID_index, r.asin_index) for r in got.collect()}
    assert lists["refit"] == lists["fold_in"] and len(lists["refit"]) == 8
    with pytest.raises(ValueError, match="trained model"):
        jobs.recommend_for_feedback(indexed, feedback, books, method="fold_in")
    with pytest.raises(ValueError, match="no such method"):
        jobs.recommend_for_feedback(indexed, feedback, books, method="guess")


def test_a_batch_of_sums_counts_once(spark, raw):
    path = scratch_path(spark, "sums")
    parts = [raw.where(F.col("reviewerID") < "r050"), raw.where(F.col("reviewerID") >= "r050")]
    for name, part in (("mon", parts[0]), ("tue", parts[1]), ("mon", parts[0]), ("tue", parts[1])):
        sums = jobs.update_average_sums(path, part, name)
    want = raw.groupBy("asin").agg(F.count("overall"), F.sum("overall"))
    assert rows(sums) == rows(want)
    assert versions.committed(spark, path, "batches") == [1, 2]
