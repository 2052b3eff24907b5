"""Top-k scoring of users against the book factors.

Spark's own scoring pairs every block of users with every block of books and
shuffles k candidates per user and pair. Here book factors that fit one slice of
bounded size are broadcast, so that nothing is shuffled. More of them are stored,
longest first, and every task reads them from the shared folder slice by slice for a
bucket of users, whose best books so far go along; no copy of a factor moves. Nothing
but a single slice passes through the driver; a Python worker holds one slice and one
bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark import Broadcast
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.numbering import numbered
from shelfrank.session import checkpointed, delete_scratch, scratch_path
from shelfrank.sources.parts import batches_of

USERS_AT_ONCE = 256
# The first, longest factors set the marks the remaining books have to beat.
FIRST_BOOKS = 512
BOOKS_AT_ONCE = 4096
USERS_PER_BUCKET = 1 << 16
# Covers the rounding of single-precision products in the bound below.
SLACK = 1.0001

STATE = ("id", "features", "item_ids", "scores")
STATE_TYPES = "id int, features array<float>, item_ids array<int>, scores array<float>"


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a two-dimensional array."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), len(flat) // max(len(lists), 1))


def arrays(values: np.ndarray) -> pa.Array:
    """The reverse of `matrix`."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(ends, values.ravel())


def broadcast_items(item_factors: DataFrame) -> Broadcast:
    """(ids, factors, norms, order by id), longest factor first; the caller bounds the size."""
    table = item_factors.select("id", "features").toArrow()
    factors = matrix(table["features"])
    norms = np.linalg.norm(factors, axis=1)
    order = np.argsort(-norms, kind="stable")
    ids = table["id"].to_numpy()
    context = item_factors.sparkSession.sparkContext
    return context.broadcast((ids[order], factors[order], norms[order], np.argsort(ids[order])))


def item_slices(model: ALSModel, slice_bytes: int) -> list[tuple[int, int]]:
    """Row ranges of the book factors that fit slice_bytes each."""
    count = model.itemFactors.count()
    size = max(1, slice_bytes // ((model.rank + 2) * 4))
    return [(first, min(first + size, count)) for first in range(0, count, size)]


def places_of(lists: pa.Array | pa.ChunkedArray, ids: np.ndarray, by_id: np.ndarray) -> tuple:
    """(place, row) of the listed ids among `ids`, in the order of places; ids not there are left out."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    rows = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    wanted = lists.flatten().to_numpy(zero_copy_only=False)
    found = np.searchsorted(ids, wanted, sorter=by_id)
    found = by_id[np.minimum(found, len(ids) - 1)] if len(ids) else found
    known = ids[found] == wanted if len(ids) else np.zeros(len(wanted), dtype=bool)
    place, row = found[known], rows[known]
    order = np.argsort(place, kind="stable")
    return place[order], row[order]


def improve(
    users: np.ndarray, items: tuple, k: int, ids: np.ndarray, scores: np.ndarray, hidden: tuple | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) per user among those given and the items, best first.

    A score is at most the product of both norms. Books come longest first, so once a user's
    k-th best cannot be beaten by that bound, the user is settled and takes no part in the rest.
    Only users and books of a score that beats a user's k-th best are ranked. `hidden` are (place,
    user) pairs in the order of places that must not be chosen: they score minus infinity, and
    stand for nothing where a user has fewer than k other books.
    """
    item_ids, factors, norms = items[:3]
    reach = np.linalg.norm(users, axis=1) * SLACK
    left, mine, spot = np.arange(len(users)), users, np.arange(len(users))
    start, step = 0, FIRST_BOOKS
    while start < len(factors):
        full = scores.shape[1] == k
        if full:
            still = ~(scores[left, -1] >= reach[left] * norms[start])
            if not still.all():
                left = left[still]
                if not len(left):
                    break
                mine, spot = users[left], np.full(len(users), -1)
                spot[left] = np.arange(len(left))
        chunk = mine @ factors[start : start + step].T
        if hidden is not None:
            low, high = np.searchsorted(hidden[0], (start, start + step))
            own = spot[hidden[1][low:high]]
            chunk[own[own >= 0], hidden[0][low:high][own >= 0] - start] = -np.inf
        if full:
            better = chunk > scores[left, -1:]
            candidates = np.flatnonzero(better.any(axis=0))
            ranked = np.flatnonzero(better[:, candidates].any(axis=1))
        else:
            candidates, ranked = np.arange(chunk.shape[1]), np.arange(len(left))
        if len(candidates):
            own = left[ranked]
            chunk = chunk[np.ix_(ranked, candidates)]
            width = min(k, len(candidates))
            top = np.argpartition(-chunk, width - 1, axis=1)[:, :width]
            found = np.hstack([scores[own], np.take_along_axis(chunk, top, axis=1)])
            places = np.hstack([ids[own], item_ids[candidates[top] + start]])
            order = np.argsort(-found, axis=1, kind="stable")[:, :k]
            found, places = np.take_along_axis(found, order, axis=1), np.take_along_axis(places, order, axis=1)
            if full:
                scores, ids = scores.copy(), ids.copy()
                scores[own], ids[own] = found, places
            else:
                scores, ids = found, places
        start, step = start + step, BOOKS_AT_ONCE
    return ids, scores


def score_slice(state: DataFrame, items: Broadcast, k: int) -> DataFrame:
    """The users with their k best books so far, improved by one slice of books."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), USERS_AT_ONCE):
                block = batch.slice(start, USERS_AT_ONCE)
                users, ids, scores = (matrix(block.column(i)) for i in (1, 2, 3))
                hidden = places_of(block.column(4), items.value[0], items.value[3])
                ids, scores = improve(users, items.value, k, ids, scores, hidden)
                columns = [block.column(0), block.column(1), arrays(ids), arrays(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=STATE)

    return state.mapInArrow(score, STATE_TYPES)


def best_items(
    users: DataFrame, model: ALSModel, k: int, slice_bytes: int, hidden: DataFrame | None = None
) -> DataFrame:
    """id, item_ids, scores: the k best books for the users (id, features), best first.

    `hidden` are distinct (id, item) pairs that are passed over: each user's lie with the user
    while the books are scored, so k candidates are enough. Where fewer than k books remain,
    the rest of a list scores minus infinity.
    """
    slices = item_slices(model, slice_bytes)
    if hidden is None:
        users = users.withColumn("hidden", F.array().cast("array<int>"))
    else:
        users = users.join(hidden.groupBy("id").agg(F.collect_list("item").alias("hidden")), "id", "left")
    if len(slices) > 1:
        return score_buckets(users, model, k, slices)
    state = users.select(
        "id",
        "features",
        F.array().cast("array<int>").alias("item_ids"),
        F.array().cast("array<float>").alias("scores"),
        "hidden",
    )
    return score_slice(state, broadcast_items(model.itemFactors), k)


def stored_slice(path: str, low: int, high: int) -> tuple:
    """(ids, factors, norms, order by id) of the stored books numbered from `low` to below `high`."""
    ids, factors = np.empty(high - low, np.int32), np.empty((high - low, 0), np.float32)
    number = ds.field("number")
    for batch in batches_of([path], ["number", "id", "features"], (number >= low) & (number < high)):
        places, rows = batch.column(0).to_numpy() - low, matrix(batch.column(2))
        if not factors.shape[1]:
            factors = np.empty((high - low, rows.shape[1]), np.float32)
        ids[places], factors[places] = batch.column(1).to_numpy(), rows
    return ids, factors, np.linalg.norm(factors, axis=1), np.argsort(ids)


def _in_slices(path: str, slices: list[tuple[int, int]], k: int, bucket: int):
    """Function from users (id, features, hidden) to their k best books of all stored slices."""

    def scored(users: pa.Table) -> Iterator[pa.RecordBatch]:
        users = users.combine_chunks()
        blocks = [users.slice(start, USERS_AT_ONCE) for start in range(0, users.num_rows, USERS_AT_ONCE)]
        factors = [matrix(block.column("features")) for block in blocks]
        best = [(np.empty((len(f), 0), np.int32), np.empty((len(f), 0), np.float32)) for f in factors]
        for low, high in slices:
            items = stored_slice(path, low, high)
            for i, block in enumerate(blocks):
                hidden = places_of(block.column("hidden"), items[0], items[3])
                best[i] = improve(factors[i], items, k, *best[i], hidden)
            # The books of later slices are no longer than the last of this one.
            reach = [np.linalg.norm(f, axis=1) * SLACK * items[2][-1] for f in factors]
            if all(s.shape[1] == k and (s[:, -1] >= r).all() for (_, s), r in zip(best, reach, strict=True)):
                break
        for block, (ids, scores) in zip(blocks, best, strict=True):
            columns = [block.column("id").combine_chunks(), arrays(ids), arrays(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "item_ids", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, len(batch), bucket):
                part = batch.slice(start, bucket)
                if size and size + len(part) > bucket:
                    yield from scored(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(part)
                size += len(part)
        if size:
            yield from scored(pa.Table.from_batches(held))

    return run


def score_buckets(users: DataFrame, model: ALSModel, k: int, slices: list[tuple[int, int]]) -> DataFrame:
    """id, item_ids, scores: every bucket of users (id, features, hidden) against every slice of books.

    Of equal scores the longer factor comes first.
    """
    spark = users.sparkSession
    norm = F.aggregate("features", F.lit(0.0), lambda total, x: total + x * x)
    ranked = numbered(model.itemFactors.withColumn("norm", norm), F.desc("norm"), "id")
    path = scratch_path(spark, "ranked_items")
    ranked.select("number", "id", "features").write.parquet(path)
    try:
        found = users.select("id", "features", "hidden").mapInArrow(
            _in_slices(path, slices, k, USERS_PER_BUCKET), "id int, item_ids array<int>, scores array<float>"
        )
        return checkpointed(found)
    finally:
        delete_scratch(spark, path)


def nested(scored: DataFrame, user: str, item: str) -> DataFrame:
    """The layout of Spark's recommendations: an array of (item, rating) per user."""
    pairs = F.zip_with(
        "item_ids", "scores", lambda i, s: F.struct(i.alias(item), s.alias("rating"))
    )
    # What was passed over scores minus infinity.
    pairs = F.filter(pairs, lambda pair: pair["rating"] > F.lit(float("-inf")))
    return scored.select(F.col("id").alias(user), pairs.alias("recommendations"))
