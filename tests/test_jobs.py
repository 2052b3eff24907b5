from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfrank import session
from shelfrank.__main__ import main as cli
from shelfrank.operators import statistics
from shelfrank.operators.recommend import AlsSettings
from shelfrank.plans import jobs
from shelfrank.sources import proxy, readers, schemas, sinks

FOLDER = "/root/testdata/sf0.001"
QUICK = AlsSettings(max_iter=2)


@pytest.fixture(scope="module")
def ratings(spark):
    return jobs.prepare_ratings(proxy.titled_ratings(spark, FOLDER))


@pytest.fixture(scope="module")
def ratings_path(spark, ratings):
    path = session.scratch_path(spark, "ratings")
    sinks.write_ratings(ratings, path)
    return path


def test_prepared_ratings_read_back_with_the_schema(spark, ratings, ratings_path):
    again = readers.read_ratings(spark, ratings_path)
    assert rows(again.select("asin", "asin_index", "reviewerID_index")) == rows(
        ratings.select("asin", F.col("asin_index").cast("double"), F.col("reviewerID_index").cast("double"))
    )


def test_glob_of_json_files(spark, ratings, ratings_path):
    assert readers.read_ratings(spark, ratings_path + "/*.json").count() == ratings.count()


def test_train_and_save(spark, ratings_path):
    path = session.scratch_path(spark, "model")
    error = jobs.train_and_save(spark, ratings_path, path, QUICK)
    assert 0 < error < 10
    assert sinks.load_model(spark, path).rank == 10
    assert readers.read_table(spark, "ratings").count() == 6000


def test_train_and_recommend_all(spark, ratings_path):
    path = session.scratch_path(spark, "recommendations")
    jobs.train_and_recommend_all(spark, ratings_path, path, QUICK, partitions=8)
    got = readers.read_recommendations(spark, path)
    users = readers.read_ratings(spark, ratings_path).select("reviewerID_index").distinct()
    assert got.where(F.size("recommendations") == 5).count() == got.count() > 0.9 * users.count()


def test_command_line(spark, ratings_path, tmp_path, capsys):
    raw = str(tmp_path / "raw")
    sinks.write_json(proxy.titled_ratings(spark, FOLDER), raw)
    cli(["prepare", raw, str(tmp_path / "ratings")])
    again = readers.read_ratings(spark, str(tmp_path / "ratings"))
    assert rows(again) == rows(readers.read_ratings(spark, ratings_path))
    cli(["check-raw", raw, str(tmp_path / "dump")])
    assert "6000" in capsys.readouterr().out
    books, reviews = str(tmp_path / "books"), str(tmp_path / "reviews")
    sinks.write_json(proxy.books(spark, FOLDER), books)
    sinks.write_json(proxy.reviews(spark, FOLDER), reviews)
    cli(["prepare-untitled", reviews, books, str(tmp_path / "again")])
    assert rows(readers.read_ratings(spark, str(tmp_path / "again"))) == rows(again)
    cli(["search", books, "red"])
    cli(["page", books, reviews, "7", "http://x/"])
    cli(["books-to-rate", ratings_path, books])
    sinks.write_json(statistics.average_rating_table(proxy.ratings(spark, FOLDER), proxy.books(spark, FOLDER)), str(tmp_path / "average"))
    cli(["prepare-batch", raw, str(tmp_path / "ids"), str(tmp_path / "batch"), str(tmp_path / "broken")])
    assert rows(readers.read_ratings(spark, str(tmp_path / "batch"))) == rows(again)
    cli(["train-artefact", str(tmp_path / "batch"), str(tmp_path / "artefact")])
    asked = again.select("reviewerID").distinct().limit(3)
    sinks.write_json(asked, str(tmp_path / "reviewers"))
    cli(["recommend-reviewers", str(tmp_path / "artefact"), str(tmp_path / "reviewers"), str(tmp_path / "found")])
    assert spark.read.json(str(tmp_path / "found")).count() == 15
    cli(["update-averages", reviews, "monday", str(tmp_path / "sums"), books, str(tmp_path / "merged")])
    whole = statistics.average_rating_table(proxy.ratings(spark, FOLDER), proxy.books(spark, FOLDER))
    assert rows(readers.read_average_ratings(spark, str(tmp_path / "merged"))) == rows(whole)
    cli(["dashboard", str(tmp_path / "average")])
    assert "Average Rating" in capsys.readouterr().out



def test_recommend_for_two_new_visitors(spark, ratings):
    raw = readers.feedback_from_rows(
        spark,
        [(2000000001, str(i), "5") for i in range(5)]
        + [(2000000002, str(i), "1") for i in range(5)]
        + [(2000000003, "x", "1")],
    )
    echo, recommended = jobs.recommend_for_feedback(
        ratings, raw, proxy.books(spark, FOLDER), QUICK
    )
    assert echo.count() == 10 and echo.where("title is null").count() == 0
    counts = rows(recommended.groupBy("reviewerID_index").count())
    assert counts == [(2000000001, 5), (2000000002, 5)]
    assert recommended.columns == (
        "reviewerID_index rank asin_index rating asin title imUrl".split()
    )
    assert recommended.where("title = 'random_title'").count() == 0


def test_books_to_rate(spark, ratings):
    got = jobs.books_to_rate(ratings, proxy.books(spark, FOLDER), seed=1)
    assert got.count() == 5
    assert set(got.columns) == {"asin", "asin_index", "title", "imUrl"}


def test_dashboard_frames_share_one_sample(spark):
    average = spark.range(300).select(
        F.format_string("b%03d", "id").alias("asin"),
        F.lit("T").alias("title"),
        F.rand(2).alias("average_rating"),
        F.lit(1.0).alias("price"),
    )
    frames = jobs.rating_dashboard(average, n=50, seed=4)
    points = sorted((r.average_rating for r in frames["scatter"].collect()), reverse=True)
    assert len(points) == 50
    assert [r["Average Rating"] for r in frames["top"].collect()] == points[:10]
    assert [r["Average Rating"] for r in frames["bottom"].collect()] == points[-10:]


def test_average_rating_file(spark):
    path = session.scratch_path(spark, "average")
    average = spark.createDataFrame([("a", "T", 4.5, 9.99)], schemas.AVERAGE_RATING)
    sinks.write_json(average, path)
    assert rows(readers.read_average_ratings(spark, path)) == rows(average)


def test_check_raw_file(spark):
    raw, dump = (session.scratch_path(spark, name) for name in ("raw", "dump"))
    sinks.write_json(proxy.reviews(spark, FOLDER), raw)
    assert jobs.check_raw_file(spark, raw, dump).first()[0] == 6000
    lines = spark.read.text(dump)
    assert lines.count() == 6000
    assert lines.where(F.get_json_object("value", "$.asin").isNull()).count() == 0


def test_clustered_files_hold_separate_key_ranges(spark):
    path = session.scratch_path(spark, "clustered")
    third_hot = F.when(F.col("id") % 3 == 0, "k0500").otherwise(F.format_string("k%04d", "id"))
    df = spark.range(3000).select(third_hot.alias("asin"), F.col("id").alias("other"))
    sinks.write_clustered(df.repartition(7), path, "asin", "other")
    files = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min("asin").alias("low"), F.max("asin").alias("high"), F.count("*").alias("n"))
        .orderBy("low", "high")
        .collect()
    )
    assert sum(f.n for f in files) == 3000
    assert all(a.high <= b.low for a, b in zip(files, files[1:]))


def test_sinks_do_not_overwrite_unasked(spark):
    path = session.scratch_path(spark, "x")
    sinks.write_parquet(spark.range(1), path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_parquet(spark.range(1), path)
    sinks.write_parquet(spark.range(2), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 2


class FakeSession:
    """Only what shared_folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="fake")


def test_shared_folder_comes_from_the_session():
    folder = "hdfs://cluster/checkpoints"
    path = session.scratch_path(FakeSession("yarn", folder + "/"), "t")
    assert path.startswith(folder + "/shelfrank-") and path.endswith("/t")


@pytest.mark.parametrize(
    ("system", "folder"),
    [("hdfs://cluster:9000", "hdfs://cluster:9000/shared"), ("hdfs://cluster/", "hdfs://cluster/shared")],
)
def test_a_bare_folder_is_one_of_the_default_file_system(system, folder):
    fake = FakeSession("yarn", "/shared/")
    settings = SimpleNamespace(get=lambda key, default: system)
    fake._jsc = SimpleNamespace(hadoopConfiguration=lambda: settings)
    assert session.shared_folder(fake) == folder
    settings.get = lambda key, default: "file:///"
    with pytest.raises(RuntimeError, match="single machines"):
        session.shared_folder(fake)
    fake.conf[session.MOUNTED] = "true"
    assert session.shared_folder(fake) == "file:/shared"


def test_local_mode_falls_back_to_one_folder_per_application():
    fake = FakeSession("local[2]")
    assert session.shared_folder(fake) == session.shared_folder(fake)


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))


def test_intermediate_tables_are_deleted(spark):
    with session.stored_for_now(spark.range(3), "t") as table:
        folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
        assert table.count() == 3 and folder.exists()
    assert not folder.exists()


def test_kept_frames_are_released(spark):
    with session.kept(spark.range(10)) as df:
        assert df.count() == 10 and df.is_cached
    assert not df.is_cached


@pytest.mark.parametrize("folder", ["file:///tmp/checkpoints", "file:/tmp/checkpoints"])
def test_machine_local_folders_are_refused_on_a_cluster(folder):
    with pytest.raises(RuntimeError, match="single machines"):
        session.shared_folder(FakeSession("yarn", folder))
    assert session.shared_folder(FakeSession("local-cluster[3,2,3000]", folder)) == folder


class ClusterSession:
    """The session of the tests as that of a cluster of its own, with other settings."""

    def __init__(self, spark, checkpoint_dir=None, **settings):
        self.inner, self.conf = spark, {"spark.checkpoint.dir": checkpoint_dir} | settings
        context = spark.sparkContext
        self.sparkContext = SimpleNamespace(
            master="spark://host:7077", applicationId=str(id(self)), defaultParallelism=context.defaultParallelism
        )

    def __getattr__(self, name):
        return getattr(self.inner, name)


def test_a_mounted_folder_of_a_cluster_is_used(spark, tmp_path):
    folder = f"file:{tmp_path}"
    assert session.shared_folder(ClusterSession(spark, folder)) == folder
    assert list(tmp_path.iterdir()) == []


def test_a_folder_that_does_not_hold_what_tasks_write_is_refused(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    with pytest.raises(RuntimeError, match="single machines"):
        session.shared_folder(ClusterSession(spark, f"file:{blocked}"))


def test_a_cluster_without_a_checkpoint_folder_uses_the_warehouse(spark, tmp_path):
    warehouse = {"spark.sql.warehouse.dir": f"file:{tmp_path}"}
    assert session.shared_folder(ClusterSession(spark, **warehouse)) == f"file:{tmp_path}"
    named = ClusterSession(spark, **warehouse)
    named.sparkContext.getCheckpointDir = lambda: "hdfs://cluster/checkpoints/0f3a"
    assert session.shared_folder(named) == "hdfs://cluster/checkpoints"


def test_the_warehouse_stands_in_for_a_checkpoint_folder_of_single_machines(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    cluster = ClusterSession(spark, f"file:{blocked}", **{"spark.sql.warehouse.dir": f"file:{tmp_path}"})
    assert session.shared_folder(cluster) == f"file:{tmp_path}"
    found = [f"file:{blocked}/0f3a"]
    cluster.sparkContext.getCheckpointDir = lambda: found[-1]
    cluster.sparkContext.setCheckpointDir = lambda folder: found.append(f"{folder}/1b2c")
    for _ in range(2):
        session.use_checkpoints(cluster)
        assert found == [f"file:{blocked}/0f3a", f"file:{tmp_path}/1b2c"]


def scratch_tables(spark):
    return set(Path(session.shared_folder(spark).removeprefix("file:")).glob("shelfrank-*"))


def test_jobs_that_write_leave_only_their_output(spark, ratings_path, tmp_path):
    raw = str(tmp_path / "raw")
    sinks.write_json(proxy.titled_ratings(spark, FOLDER), raw)
    before = scratch_tables(spark)
    jobs.prepare_and_write(readers.read_files(spark, raw, "asin string, overall double, reviewerID string, title string"), str(tmp_path / "ratings"))
    jobs.train_and_recommend_all(spark, ratings_path, str(tmp_path / "recommendations"), QUICK)
    jobs.check_raw_file(spark, raw, str(tmp_path / "dump")).collect()
    assert scratch_tables(spark) == before


def test_stored_for_now_leaves_nothing(spark):
    before = scratch_tables(spark)
    with session.stored_for_now(spark.range(3), "t") as table:
        assert table.count() == 3
    assert scratch_tables(spark) == before


def test_raw_check_keeps_every_line(spark, tmp_path):
    lines = ['{"asin": "a", "extra": [1, {"x": null}]}', '{"asin": "b"', "no json", '{"overall":  5}']
    (tmp_path / "raw.json").write_text("\n".join([*lines, "", "  "]) + "\n")
    counts = jobs.check_raw_file(spark, str(tmp_path / "raw.json"), str(tmp_path / "dump"))
    assert rows(counts) == [(4, 2)]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "dump")).collect()) == sorted(lines)
    with pytest.raises(Exception):
        readers.read_files(spark, str(tmp_path / "raw.json"), schemas.REVIEWS, strict=True).collect()


def test_a_dump_takes_less_room_than_its_lines(spark, tmp_path):
    lines = [f'{{"asin": "{i}", "reviewerName": "reviewer {i % 7}", "overall": 5.0}}' for i in range(5000)]
    (tmp_path / "raw.json").write_text("\n".join(lines) + "\n")
    counts = jobs.check_raw_file(spark, str(tmp_path / "raw.json"), str(tmp_path / "dump"))
    assert rows(counts) == [(5000, 0)]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "dump")).collect()) == sorted(lines)
    size = sum(file.stat().st_size for file in (tmp_path / "dump").iterdir())
    assert size < (tmp_path / "raw.json").stat().st_size / 3
    sinks.write_text_dump(spark.read.text(str(tmp_path / "raw.json")), str(tmp_path / "plain"), compression="none")
    assert sum(len(f.read_text()) for f in (tmp_path / "plain").glob("*.txt")) == len("\n".join(lines)) + 1


def test_visitor_with_the_id_of_a_reviewer_is_an_error(spark, ratings):
    raw = readers.feedback_from_rows(spark, [(7, "1", "5")])
    with pytest.raises(ValueError, match="visitor id 7"):
        jobs.recommend_for_feedback(ratings, raw, proxy.books(spark, FOLDER), QUICK)


def test_answers_about_unknown_books_do_not_train(spark, ratings):
    raw = readers.feedback_from_rows(
        spark, [(2000000001, "1", "5"), (2000000001, "1000000", "5"), (2000000002, "1000001", "5")]
    )
    echo, recommended = jobs.recommend_for_feedback(ratings, raw, proxy.books(spark, FOLDER), QUICK)
    assert echo.count() == 3
    assert rows(recommended.groupBy("reviewerID_index").count()) == [(2000000001, 5)]


def test_recommend_from_a_stored_model(spark, ratings, ratings_path):
    path = session.scratch_path(spark, "model")
    jobs.train_and_save(spark, ratings_path, path, QUICK)
    users = spark.createDataFrame([(0,), (1,), (10**8,)], "reviewerID_index int")
    got = jobs.recommend_from_model(spark, path, users, ratings, 3)
    assert rows(got.groupBy("reviewerID_index").count()) == [(0, 3), (1, 3)]
    assert got.where("title is null").count() == 0
