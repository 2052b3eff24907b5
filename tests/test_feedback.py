from conftest import rows
from pyspark.sql import functions as F

from shelfrank.operators import feedback as fb
from shelfrank.sources import readers, schemas


def test_malformed_answers_are_left_out(spark):
    raw = readers.feedback_from_rows(
        spark,
        [(1, "3", "5"), (1, "x", "5"), (1, "3", "6"), (1, "3", ""), (2, "4.0", "1"), (2, None, "1")],
    )
    assert rows(fb.parse_feedback(raw)) == [(1, 3, 5.0), (2, 4, 1.0)]


def test_forms_become_rows(spark):
    names = [f"{kind}{i}" for i in range(5) for kind in ("book", "rating")]
    values = [str(x) for i in range(5) for x in (10 + i, i + 1)]
    forms = spark.createDataFrame([(7, *values)], ["user_id", *names])
    answers = fb.answers_from_forms(forms)
    assert answers.columns == ["user_id", "book", "rating"]
    assert rows(answers) == [(7, str(10 + i), str(i + 1)) for i in range(5)]


def test_rows_carry_placeholders_and_own_user_id(spark):
    raw = readers.feedback_from_rows(spark, [(2000000001, "3", "5"), (2000000002, "3", "4")])
    assert rows(fb.feedback_rows(raw)) == [
        ("unknown_asin", 3, 4.0, "test_user", 2000000002, "random_title"),
        ("unknown_asin", 3, 5.0, "test_user", 2000000001, "random_title"),
    ]


def test_union_goes_by_name_and_leaves_the_base_alone(spark):
    base = spark.createDataFrame([("a", 0.0, 1.0, "u", 0.0, "T")], schemas.RATINGS)
    new = fb.feedback_rows(readers.feedback_from_rows(spark, [(2000000001, "3", "5")]))
    shuffled = new.select("title", "reviewerID_index", "overall", "asin", "asin_index", "reviewerID")
    merged = fb.add_feedback(base, shuffled)
    assert merged.schema["asin_index"].dataType.typeName() == "double"
    assert rows(merged) == rows(fb.add_feedback(base, new))
    assert merged.count() == 2 and base.count() == 1


def test_echo_has_titles_and_keeps_unknown_books(spark):
    items = spark.createDataFrame([(3, "a", "T")], "asin_index int, asin string, title string")
    raw = readers.feedback_from_rows(spark, [(1, "3", "5"), (1, "99", "2")])
    assert rows(fb.feedback_with_titles(raw, items)) == [(1, 3, "T", 5.0), (1, 99, None, 2.0)]


def test_hot_answer_counts_in_full(spark):
    raw = spark.range(3000).select(
        F.col("id").cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("book"),
        F.lit("5").alias("rating"),
    )
    items = spark.range(3000).select(
        F.col("id").cast("int").alias("asin_index"), F.format_string("T%d", "id").alias("title")
    )
    echoed = fb.feedback_with_titles(raw, items)
    assert echoed.count() == 3000
    assert echoed.where("title = 'T1'").count() == 1001
