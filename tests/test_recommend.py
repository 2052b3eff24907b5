import hypothesis
import numpy as np
import pytest
from conftest import rows
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfrank.operators import recommend as rec
from shelfrank.operators import split_als
from shelfrank.operators.scoring import improve, item_slices
from shelfrank.session import scratch_path, stored
from shelfrank.sources import readers, sinks

SCHEMA = "reviewerID_index int, asin_index int, overall double"


def low_rank(spark, users=120, items=60, share=0.4, seed=3):
    """Ratings of rank 2 with some of the cells observed: (observed, held out)."""
    random = np.random.default_rng(seed)
    full = random.uniform(0.5, 1.5, (users, 2)) @ random.uniform(0.5, 1.5, (2, items))
    cells = [(u, i, float(full[u, i])) for u in range(users) for i in range(items)]
    seen = random.random(len(cells)) < share
    parts = [[c for c, s in zip(cells, seen) if bool(s) == flag] for flag in (True, False)]
    return [spark.createDataFrame(p, SCHEMA) for p in parts]


@pytest.fixture(scope="module")
def data(spark):
    observed, held_out = low_rank(spark)
    return stored(observed, "observed"), stored(held_out, "held_out")


@pytest.fixture(scope="module")
def model(data):
    return rec.fit_als(data[0], rec.AlsSettings(max_iter=10))


def item_mean_error(observed, held_out):
    means = observed.groupBy("asin_index").agg(F.avg("overall").alias("prediction"))
    return rec.evaluate_rmse(held_out.join(means, "asin_index"))


def test_als_beats_the_item_mean(data, model):
    error = rec.evaluate_rmse(rec.predict(model, data[1]))
    assert error < 0.2 * item_mean_error(*data)


def test_ratings_of_a_visitor_meet_before_they_are_summed(spark, model, settings, monkeypatch):
    """Sums are five times the size of a rating: a visitor has few rows of them, however many tasks read the answers."""
    answers = [(2000000000 + u, i, 3.0) for u in range(20) for i in range(50)]
    feedback = spark.createDataFrame(answers, SCHEMA).repartition(16)
    settings(autoBroadcastJoinThreshold=-1, adaptive__coalescePartitions__enabled="false")
    moved, keep = [], type(feedback).repartition

    def seen(df, *keys):
        moved.append((keys, df.count() if keys == ("id",) else None))
        return keep(df, *keys)

    monkeypatch.setattr(type(feedback), "repartition", seen)
    assert rec.fold_in(model, feedback).count() == 20
    assert dict(moved)[("id",)] <= 25


def test_recommendations_equal_brute_force(model):
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for row in rec.recommend_all(model, 5).collect():
        scores = {i: float(users[row.reviewerID_index] @ f) for i, f in items.items()}
        best = sorted(scores, key=scores.get, reverse=True)[:5]
        assert [r.asin_index for r in row.recommendations] == best
        assert np.allclose([r.rating for r in row.recommendations], [scores[i] for i in best], atol=1e-4)


@pytest.mark.parametrize("slice_bytes", [rec.SLICE_BYTES, 20 * 48])
def test_own_and_built_in_scoring_agree(model, slice_bytes):
    users = model.userFactors.where("id < 7").select(F.col("id").alias("reviewerID_index"))
    ours = (
        rec.recommend_all(model, 4, slice_bytes),
        rec.recommend_subset(model, users, 4, slice_bytes),
    )
    theirs = model.recommendForAllUsers(4), model.recommendForUserSubset(users, 4)
    for a, b in zip(ours, theirs):
        index = ("reviewerID_index", "recommendations.asin_index")
        assert rows(a.select(*index)) == rows(b.select(*index))
        assert a.schema.simpleString() == b.schema.simpleString()


def test_buckets_of_users_and_slices_of_books(model, monkeypatch):
    from shelfrank.operators import scoring

    monkeypatch.setattr(scoring, "USERS_PER_BUCKET", 30)
    index = ("reviewerID_index", "recommendations.asin_index")
    ours = rec.recommend_all(model, 5, 13 * 48).select(*index)
    assert rows(ours) == rows(model.recommendForAllUsers(5).select(*index))


@pytest.mark.parametrize("slice_bytes", [rec.SLICE_BYTES, 13 * 48])
def test_seen_books_are_passed_over(spark, data, model, slice_bytes, monkeypatch):
    from shelfrank.operators import scoring

    monkeypatch.setattr(scoring, "USERS_PER_BUCKET", 30)
    # User 0 has seen all but two books, one of them twice, and one the model does not know.
    more = [(0, i, 3.0) for i in range(58)] + [(0, 1, 2.0), (0, 999, 1.0), (777, 1, 1.0)]
    ratings = stored(data[0].unionByName(spark.createDataFrame(more, SCHEMA)), "seen")
    seen = {tuple(r) for r in rec.seen_pairs(ratings).collect()}
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for got in (
        rec.recommend_all(model, 4, slice_bytes, ratings),
        rec.recommend_subset(model, ratings.where("reviewerID_index < 50"), 4, slice_bytes, ratings),
    ):
        lists = {r.reviewerID_index: r.recommendations for r in got.collect()}
        assert len(lists) in (50, len(users)) and 777 not in lists
        for user, books in lists.items():
            scores = sorted((float(users[user] @ f) for i, f in items.items() if (user, i) not in seen), reverse=True)
            assert np.allclose([b.rating for b in books], scores[:4], atol=1e-4)
            assert not seen & {(user, b.asin_index) for b in books}
        assert len(lists[0]) == sum((0, i) not in seen for i in items) <= 2


def test_settled_users_take_no_part_in_the_rest():
    """Products are counted: one user with a short reach must not make all others read every book."""

    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += self.shape[0] * other.shape[1]
            return np.asarray(self) @ np.asarray(other)

    rng = np.random.default_rng(4)
    factors = np.sort(rng.uniform(0.1, 3, 40_000))[::-1, None] * np.array([1.0, 0.0])
    factors = factors.astype(np.float32)
    users = np.tile(np.array([[1, 0.1]], dtype=np.float32), (200, 1))
    users[7] = [0, 1]  # orthogonal to every book: never settled
    items = (np.arange(40_000, dtype=np.int32), factors, np.linalg.norm(factors, axis=1))
    nothing = np.empty((200, 0), np.int32), np.empty((200, 0), np.float32)
    ids, scores = improve(users.view(Counted), items, 3, *nothing)
    want = np.sort(users @ factors.T, axis=1)[:, :-4:-1]
    assert np.allclose(scores, want, atol=1e-5)
    assert (ids[np.arange(200) != 7] == [0, 1, 2]).all()
    assert Counted.products < 200 * 40_000 / 4


def test_a_slice_is_read_from_tables_with_row_groups_of_other_slices(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from shelfrank.operators.scoring import arrays, stored_slice

    f = np.random.default_rng(1).normal(size=(100, 3)).astype(np.float32)
    table = pa.table({"number": np.arange(100), "id": np.arange(100, dtype=np.int32)[::-1], "features": arrays(f)})
    for part, low in enumerate(range(0, 100, 50)):
        pq.write_table(table.slice(low, 50), tmp_path / f"part-{part}.parquet", row_group_size=20)
    ids, factors, norms, by_id = stored_slice(str(tmp_path), 45, 62)
    assert ids.tolist() == list(range(99 - 45, 99 - 62, -1)) and (factors == f[45:62]).all()
    assert np.allclose(norms, np.linalg.norm(f[45:62], axis=1)) and (ids[by_id] == np.sort(ids)).all()


def test_book_factors_of_many_slices_are_not_shuffled(spark, model, monkeypatch):
    from shelfrank.operators import scoring

    planned, keep = [], scoring.checkpointed
    monkeypatch.setattr(scoring, "USERS_PER_BUCKET", 30)
    monkeypatch.setattr(scoring, "checkpointed", lambda df: planned.append(df._jdf.queryExecution().toString()) or keep(df))
    got = rec.recommend_all(model, 5, 13 * 48)
    assert got.count() == model.userFactors.count()
    assert "MapInArrow" in planned[-1] and "CoGroup" not in planned[-1] and "Join" not in planned[-1]


def test_fold_in_equals_numpy(spark, model):
    rng = np.random.default_rng(6)
    answers = [(2000000000 + u, int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.integers(0, 60, 1 + u % 5)]
    hot = [(2000000099, int(i), float(r)) for i, r in zip(rng.integers(0, 60, 30_000), rng.integers(1, 6, 30_000))]
    unknown = [(2000000200, 999, 5.0), (2000000001, 999, 1.0)]
    feedback = spark.createDataFrame(answers + hot + unknown, SCHEMA)
    items = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    want = {}
    for user in {a[0] for a in answers + hot}:
        own = [(items[i], r) for u, i, r in answers + hot if u == user]
        v, r = np.array([x for x, _ in own]), np.array([x for _, x in own])
        want[user] = np.linalg.solve(v.T @ v + 0.01 * len(r) * np.eye(10), v.T @ r)
    folded = rec.fold_in(model, feedback)
    got = {r.id: r.features for r in folded.collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[u], want[u], atol=2e-3) for u in want)
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    books = rec.recommend_folded(model, feedback, 3, exclude_seen=True).collect()
    rated = {(u, i) for u, i, _ in answers + hot}
    assert not rated & {(b.reviewerID_index, r.asin_index) for b in books for r in b.recommendations}
    assert {len(b.recommendations) for b in books if b.reviewerID_index != 2000000099} == {3}


def test_slices_cover_all_books(model):
    assert item_slices(model, rec.SLICE_BYTES) == [(0, 60)]
    assert item_slices(model, 25 * 48) == [(0, 25), (25, 50), (50, 60)]


def best_for_block(users, items, k):
    nothing = np.empty((len(users), 0))
    return improve(users, items, k, nothing.astype(np.int32), nothing.astype(np.float32))


def test_pruned_scan_of_many_books_is_exact():
    random = np.random.default_rng(1)
    factors = random.normal(size=(60_000, 4)) * random.uniform(0, 1, (60_000, 1)) ** 4
    factors = factors.astype(np.float32)
    factors = factors[np.argsort(-np.linalg.norm(factors, axis=1))]
    users = random.normal(size=(50, 4)).astype(np.float32)
    items = (np.arange(60_000, dtype=np.int32), factors, np.linalg.norm(factors, axis=1))
    _, scores = best_for_block(users, items, 5)
    assert np.allclose(scores, -np.sort(-(users @ factors.T), axis=1)[:, :5])


@hypothesis.settings(max_examples=60, deadline=None)
@hypothesis.given(
    st.integers(1, 40), st.integers(1, 5000), st.integers(1, 7), st.integers(0, 2**32 - 1), st.booleans()
)
def test_best_books_for_any_shape(n_users, n_items, k, seed, with_copies):
    random = np.random.default_rng(seed)
    factors = random.normal(size=(n_items, 3)).astype(np.float32)
    if with_copies:
        factors[n_items // 3 :] = factors[0]
    factors = factors[np.argsort(-np.linalg.norm(factors, axis=1))]
    users = random.normal(size=(n_users, 3)).astype(np.float32)
    users[0] = 0
    items = (np.arange(n_items, dtype=np.int32), factors, np.linalg.norm(factors, axis=1))
    ids, scores = best_for_block(users, items, k)
    want = -np.sort(-(users @ factors.T), axis=1)[:, :k]
    assert np.allclose(scores, want, atol=1e-5)
    assert all(len(set(row)) == min(k, n_items) for row in ids.tolist())


def test_fewer_books_than_asked_for(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 4.0), (2, 2, 3.0)], SCHEMA)
    got = rec.recommend_all(rec.fit_als(df, rec.AlsSettings(max_iter=2)), 5)
    assert rows(got.select("reviewerID_index", F.size("recommendations"))) == [(1, 2), (2, 2)]


def test_unknown_user_gives_no_row(spark, model):
    users = spark.createDataFrame([(3,), (999999,), (3,)], "reviewerID_index int")
    got = rec.recommend_subset(model, users, 5)
    assert [r.reviewerID_index for r in got.collect()] == [3]


def test_unseen_users_and_books_are_not_scored(spark, model):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 999, 1.0), (999, 1, 1.0)], SCHEMA)
    assert rec.predict(model, df).count() == 1


def test_fractional_index_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 0.5, 3.0), (2.0, 1.0, 3.0)], SCHEMA.replace("int", "double"))
    with pytest.raises(Exception, match="Integer range|integer"):
        rec.fit_als(df, rec.AlsSettings(max_iter=1))
    with pytest.raises(Exception, match="whole number"):
        split_als.fit_split_als(df, rec.AlsSettings(max_iter=1))


def test_one_user_and_exploded(spark, model):
    one = rec.exploded(rec.for_user(rec.recommend_all(model, 3), 5))
    got = one.orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2, 3]
    assert got[0].rating >= got[1].rating >= got[2].rating


def test_titles_and_covers(spark):
    rows_in = spark.createDataFrame(
        [(1, 1, 10, 5.0), (1, 2, 11, 4.0), (1, 3, 12, 3.0), (1, 4, 13, 2.0)],
        "reviewerID_index int, rank int, asin_index int, rating float",
    )
    items = spark.createDataFrame(
        [(10, "a", "A"), (11, "b", ""), (12, "c", None), (13, "d", "D")],
        "asin_index int, asin string, title string",
    )
    books = spark.createDataFrame([("a", "http://c/a"), ("x", "y")], "asin string, imUrl string")
    got = rec.with_covers(rows_in, items, books).select("rank", "asin", "title", "imUrl")
    assert rows(got) == [(1, "a", "A", "http://c/a"), (4, "d", "D", None)]
    assert rows(rec.with_titles(rows_in, items).select("title")) == [("A",), ("D",)]


def test_model_survives_a_round_trip(spark, model):
    path = scratch_path(spark, "model")
    sinks.save_model(model, path)
    loaded = sinks.load_model(spark, path)
    assert rows(loaded.userFactors) == rows(model.userFactors)
    assert rows(loaded.itemFactors) == rows(model.itemFactors)
    with pytest.raises(Exception, match="exists"):
        sinks.save_model(model, path)


def test_recommendations_survive_json(spark, model):
    recommendations = stored(rec.recommend_all(model, 5), "recommendations")
    path = scratch_path(spark, "json")
    sinks.write_json(recommendations, path)
    again = readers.read_recommendations(spark, path)
    assert rows(again) == rows(recommendations)
    assert again.schema.simpleString() == recommendations.schema.simpleString()


# The path for groups too large for one block


def brute_force(triples, rank, reg, iterations, items):
    users = {}
    by_user, by_item = {}, {}
    for u, i, r in triples:
        by_user.setdefault(u, []).append((i, r))
        by_item.setdefault(i, []).append((u, r))

    def solve(groups, factors):
        out = {}
        for key, seen in groups.items():
            v = np.array([factors[i] for i, _ in seen])
            r = np.array([x for _, x in seen])
            out[key] = np.linalg.solve(v.T @ v + reg * len(seen) * np.eye(rank), v.T @ r)
        return out

    for _ in range(iterations):
        users = solve(by_user, items)
        items = solve(by_item, users)
    return users, items


@pytest.mark.parametrize("part_rows", [7, 1_000_000, None])
def test_split_groups_equal_brute_force(spark, data, part_rows):
    copies = spark.createDataFrame([(0, 0, 2.0)] * 500 + [(0, 0, 1.0)] * 20, SCHEMA)
    triples = stored(data[0].unionByName(copies), "triples")
    settings = rec.AlsSettings(max_iter=2, rank=3)
    model = split_als.fit_split_als(triples, settings, part_rows)
    ids = split_als.merged_pairs(triples).select(F.col("item").alias("id")).distinct()
    first = split_als.first_factors(ids, "id", 3, settings.seed)
    start = {r.id: np.array(r.f) for r in first.collect()}
    users, items = brute_force(triples.collect(), 3, settings.reg, 2, start)
    for found, want in ((model.userFactors, users), (model.itemFactors, items)):
        found = {r.id: r.features for r in found.collect()}
        assert found.keys() == want.keys()
        assert all(np.allclose(found[k], want[k], atol=1e-3) for k in want)


@pytest.mark.parametrize("part_rows", [7, None])
def test_factors_are_read_in_slices_of_bounded_size(data, monkeypatch, part_rows):
    settings = rec.AlsSettings(max_iter=2, rank=3)
    whole = split_als.fit_split_als(data[0], settings, part_rows)
    monkeypatch.setattr(split_als, "FACTOR_BYTES", 4 * 3 * 11)
    monkeypatch.setattr(split_als, "IDS_AT_ONCE", 5)
    sliced = split_als.fit_split_als(data[0], settings, part_rows)
    for a, b in ((whole.userFactors, sliced.userFactors), (whole.itemFactors, sliced.itemFactors)):
        want = {r.id: r.features for r in a.collect()}
        found = {r.id: r.features for r in b.collect()}
        assert found.keys() == want.keys()
        assert all(np.allclose(found[k], want[k], atol=1e-3) for k in want)


def test_what_a_fit_keeps_does_not_grow_with_its_iterations(spark, data, monkeypatch):
    made, deleted = [], []
    kept, removed = split_als.checkpointed, split_als.delete_scratch
    monkeypatch.setattr(split_als, "checkpointed", lambda df: made.append(1) or kept(df))
    monkeypatch.setattr(split_als, "delete_scratch", lambda s, path: deleted.append(path) or removed(s, path))
    split_als.fit_split_als(data[0], rec.AlsSettings(max_iter=3, rank=2))
    assert len(made) == 2
    # Seven tables of factors, two of numbers and two of blocks, each once.
    assert len(deleted) == len(set(deleted)) == 11


def test_the_method_is_the_callers_choice_alone(spark, data, monkeypatch):
    calls = []
    monkeypatch.setattr(rec, "fit_split_als", lambda *args: calls.append(args))
    rec.fit_als(data[0], rec.AlsSettings(max_iter=1, rank=2, method="blocks"))
    assert calls == []
    rec.fit_als(data[0], rec.AlsSettings(max_iter=1, rank=2))
    assert len(calls) == 1
    with pytest.raises(ValueError, match="no such"):
        rec.fit_als(data[0], rec.AlsSettings(method="other"))


@pytest.mark.parametrize("method", ["blocks", "split"])
@pytest.mark.parametrize("rating", [None, float("nan")])
def test_null_and_nan_ratings_are_errors(spark, method, rating):
    df = spark.createDataFrame([(1, 1, 3.0), (2, 1, rating)], SCHEMA)
    with pytest.raises(Exception, match="null or NaN"):
        rec.fit_als(df, rec.AlsSettings(max_iter=1, method=method))


def test_split_model_scores_like_any_other(data):
    model = split_als.fit_split_als(data[0], rec.AlsSettings(max_iter=10), 20)
    error = rec.evaluate_rmse(rec.predict(model, data[1]))
    assert error < 0.2 * item_mean_error(*data)


def test_hot_groups_are_dealt_over_blocks(spark):
    df = spark.range(3000).select(
        F.col("id").cast("int").alias("reviewerID_index"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).cast("int").alias("asin_index"),
        F.lit(3.0).alias("overall"),
    )
    pairs = split_als.in_blocks(split_als.merged_pairs(df), "item", 40, 100)
    sizes = pairs.groupBy("item_block").count()
    assert pairs.count() == 3000
    assert pairs.where("item = 0").select("item_block").distinct().count() > 5
    single = pairs.where("item != 0").groupBy("item").agg(F.countDistinct("item_block").alias("n"))
    assert single.where("n > 1").count() == 0
    assert rows(pairs.select(F.col("item") == 0, F.col("item_parts") > 1).distinct()) == [(False, False), (True, True)]
    assert sizes.agg(F.max("count")).first()[0] < 450


def test_blocks_of_either_side_are_alike_with_a_book_that_has_a_third_of_all_ratings(spark):
    """What a task of a half step reads follows its block."""
    df = spark.range(200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("int").alias("reviewerID_index"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(F.col("id") + 7), F.lit(4000))).cast("int").alias("asin_index"),
        F.lit(3.0).alias("overall"),
    )
    merged = stored(split_als.merged_pairs(df), "merged")
    part = merged.count() // (8 * split_als.PARTS_PER_BLOCK)
    pairs = split_als.in_blocks(split_als.in_blocks(merged, "user", 8, part), "item", 8, part)
    for key in ("user", "item"):
        sizes = sorted(r["count"] for r in pairs.groupBy(f"{key}_block").count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_sums_of_an_id_are_added_over_batches():
    import pyarrow as pa

    rank, reg = 2, 0.1
    rng = np.random.default_rng(2)
    f, n, r = rng.normal(size=(9, rank)), np.ones(9), rng.normal(size=9)
    upper = np.triu_indices(rank)
    sums = np.hstack([f[:, upper[0]] * f[:, upper[1]], r[:, None] * f])
    ids = np.array([1, 1, 2, 2, 2, 2, 3, 3, 3], dtype=np.int32)
    targets = [[1], [2], [3], [3, 1], [2], [1], [5], [5], [5]]
    rows = pa.table({"id": ids, "n": n, "sums": split_als.arrays(sums), "targets": targets})
    batches = rows.to_batches(max_chunksize=2)
    found = list(split_als.solved(rank, reg)(iter(batches)))
    got = {i: x for b in found for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    sent = {i: x for b in found for i, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist())}
    assert sent == {1: [1, 2], 2: [1, 2, 3], 3: [5]}
    for i in (1, 2, 3):
        own = ids == i
        want = np.linalg.solve(f[own].T @ f[own] + reg * own.sum() * np.eye(rank), f[own].T @ r[own])
        assert np.allclose(got[i], want, atol=1e-5)


def test_blocks_follow_the_data(spark):
    cores = spark.sparkContext.defaultParallelism
    assert rec.als_blocks(spark, 1000) == cores
    assert rec.als_blocks(spark, 5_000_000_000) == 501
    assert rec.als_blocks(spark, 10**12) == 100_001
