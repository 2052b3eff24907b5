"""Clustered lookups, quarantined lines, exact samples and merged metadata."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfrank.operators import sampling
from shelfrank.operators.metadata import one_per_book
from shelfrank.session import scratch_path, stored
from shelfrank.sources import clustered, quarantine, schemas


@pytest.fixture(scope="module")
def table(spark):
    """Sixteen files; a third of all rows has one key."""
    key = F.when(F.col("id") % 3 == 0, "k0500").otherwise(F.format_string("k%04d", "id"))
    df = spark.range(3000).select(key.alias("asin"), F.col("id").alias("other"))
    path = scratch_path(spark, "clustered")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    clustered.write_with_zones(df, path, "asin", "other")
    for k, v in before.items():
        spark.conf.set(k, v)
    return path, df


def test_a_lookup_reads_few_files(spark, table):
    path, df = table
    assert spark.read.parquet(f"{path}/zones").count() == 16
    for key in ("k0001", "k1000", "k2999"):
        found = clustered.rows_of_key(spark, path, "asin", key)
        assert len(found.inputFiles()) <= 2
        assert rows(found) == rows(df.where(F.col("asin") == key))
    assert "PushedFilters: [IsNotNull(asin), EqualTo(asin,k2999)]" in found._jdf.queryExecution().toString()


def test_a_key_of_many_files_is_read_whole(spark, table):
    path, df = table
    found = clustered.rows_of_key(spark, path, "asin", "k0500")
    assert 2 < len(found.inputFiles()) < 16
    assert found.count() == df.where("asin = 'k0500'").count() == 1000 + (500 % 3 != 0)


def test_prefix_lookup(spark, table):
    path, df = table
    found = clustered.rows_of_prefix(spark, path, "asin", "k29")
    assert len(found.inputFiles()) < 16
    assert rows(found) == rows(df.where("asin like 'k29%'"))
    assert clustered.rows_of_prefix(spark, path, "asin", "z").count() == 0
    assert clustered.rows_of_key(spark, path, "asin", "a").columns == df.columns


def test_broken_lines_are_set_apart(spark, tmp_path):
    good = ['{"asin": "a", "overall": 5.0, "extra": [1]}', '{"overall": 2}', '  {"asin": null}']
    bad = ['{"asin": "b"', "no json", '{"overall": "five"}', "[1, 2]", "7", '"text"', "null"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text("\n".join([*good, "", "  ", *bad[:2]]) + "\n")
    (tmp_path / "in" / "two.json").write_text("\n".join(bad[2:]) + "\n")
    source = str(tmp_path / "in")
    checked = quarantine.read_checked(spark, source, schemas.REVIEWS)
    assert rows(checked.good.select("asin", "overall")) == [("a", 5.0), (None, 2.0), (None, None)]
    assert checked.good.columns == spark.createDataFrame([], schemas.REVIEWS).columns
    assert sorted(r.line for r in checked.broken.collect()) == sorted(bad)
    counts = {r.file.rsplit("/", 1)[1]: (r.n_good, r.n_broken) for r in checked.counts.collect()}
    assert counts == {"one.json": (3, 2), "two.json": (0, 5)}
    path = str(tmp_path / "quarantine")
    assert quarantine.read_and_quarantine(spark, source, schemas.REVIEWS, path).count() == 3
    assert spark.read.json(path).count() == 7
    with pytest.raises(Exception, match="exists"):
        quarantine.read_and_quarantine(spark, source, schemas.REVIEWS, path)


@pytest.mark.parametrize("n", [0, 1, 17, 1999, 2000, 2001, 10_000])
def test_sample_takes_the_rows_of_least_hash(spark, n, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS_IN_ONE_TASK", 1)
    monkeypatch.setattr(sampling, "DIGITS_PER_PASS", 1)
    df = stored(spark.range(2000).select(F.col("id").cast("string").alias("k")), "keys")
    want = df.orderBy(F.md5("k"), "k").limit(n)
    assert rows(sampling.sample_rows(df, n, "k")) == rows(want)
    drawn = rows(sampling.sample_rows(df, n, "k", seed=5))
    assert len(drawn) == min(n, 2000) and drawn == rows(sampling.sample_rows(df.repartition(5), n, "k", seed=5))
    if 1 < n < 1999:
        assert drawn != rows(want)


def test_sample_with_a_key_that_holds_most_rows(spark):
    keys = [("hot",)] * 500 + [(str(k),) for k in range(50)] + [(None,)] * 3
    df = spark.createDataFrame(keys, "k string")
    for n in (2, 3, 40, 300, 553):
        assert sampling.sample_rows(df, n, "k").count() == n
    assert rows(sampling.sample_rows(df, 3, "k")) == [(None,)] * 3
    assert sampling.sample_rows(df.limit(0), 5, "k").count() == 0


def test_values_of_repeated_metadata_are_put_together(spark):
    nan, inf = float("nan"), None
    given = [
        ("a", "T", None, None, nan), ("a", "", "url", "text", 2.0),
        ("b", None, "", None, nan), ("b", "", None, "", None),
        ("c", "Z", "u", "x", 1.0), ("c", "A", None, "x", 1.0), ("c", "Y", "u", "x", 1.0),
        ("d", "only", None, "", nan), (None, "n", None, None, inf), (None, "m", None, None, inf),
    ]
    books = spark.createDataFrame(given, "asin string, title string, imUrl string, description string, price double")
    got = {r.asin: tuple(r)[1:] for r in one_per_book(books).where("asin is not null").collect()}
    assert got["a"] == ("T", "url", "text", 2.0)
    assert got["b"] == (None, None, None, None)
    assert got["c"] == ("Y", "u", "x", 1.0)
    assert got["d"][:3] == ("only", None, "") and got["d"][3] != got["d"][3]
    assert one_per_book(books).columns == books.columns
    assert one_per_book(books.limit(0)).count() == 0


def test_texts_of_books_listed_once_are_not_sorted(spark):
    books = stored(spark.range(100).select(F.col("id").cast("string").alias("asin"), F.lit("t").alias("title")), "books")
    plan = one_per_book(books)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
