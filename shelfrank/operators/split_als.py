"""ALS for ratings in which one user or book may hold a large share of all rows.

A user's factor solves (sum n v v' + reg N I) x = sum r v over the factors v of the rated
books. The pairs lie twice in blocks of bounded size, once by user and once by book, each
block packed into arrays that tasks read from the shared folder. A user whose pairs lie in
one block is solved there; one with more pairs than a part holds lies in several blocks,
which return sums that are added and solved together. The ids of a side are numbered block by
block, pairs name the other side by number, and a half step writes its factors as arrays once.
The tasks of the next one read them from there, a slice of bounded size at a time, so no
factor is shuffled; only the sums of large groups are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.numbering import numbered
from shelfrank.operators.scoring import arrays, matrix
from shelfrank.session import checkpointed, delete_scratch, free_shuffles, scratch_path, stored_for_now
from shelfrank.sources.parts import batches_of

if TYPE_CHECKING:
    from shelfrank.operators.recommend import AlsSettings

PAIRS_PER_BLOCK = 1_000_000
# Blocks stay alike if the groups they are made of are small against them.
PARTS_PER_BLOCK = 8
LEAST_PART = 1000
# Products are held for so many pairs at a time, sums for so many ids.
PAIRS_AT_ONCE = 1 << 16
IDS_AT_ONCE = 1 << 15
# A task holds factors of the other side up to this size; it reads more of them slice by slice.
FACTOR_BYTES = 320 << 20
# Tasks of a half step; each reads the factors once.
TASKS_PER_CORE = 3

USER, ITEM, RATING = "reviewerID_index", "asin_index", "overall"


def rating_value() -> Column:
    """The rating; null or NaN is an error, as in Spark's ALS."""
    value = F.col(RATING).cast("double")
    problem = F.raise_error(F.lit(f"{RATING} must not be null or NaN")).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(problem)


def whole(index: str) -> Column:
    """An index as int; a fraction is an error, as in Spark's ALS."""
    value = F.col(index)
    problem = F.raise_error(F.lit(f"{index} must be a whole number in integer range"))
    return F.when(value == F.floor(value), value.cast("int")).otherwise(problem.cast("int"))


def merged_pairs(triples: DataFrame) -> DataFrame:
    """One row per (user, book) with the number of ratings n and their total.

    Repeated pairs are merged by a partial aggregate before the shuffle.
    """
    return triples.groupBy(whole(USER).alias("user"), whole(ITEM).alias("item")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(rating_value()).alias("total")
    )


def in_blocks(pairs: DataFrame, key: str, blocks: int, part_rows: int) -> DataFrame:
    """Pairs with the block they are summed in for `key` and the number of its parts.

    An id with more than part_rows pairs is dealt over several blocks by the hash of
    the other id; all pairs of any other id share one.
    """
    other = "item" if key == "user" else "user"
    parts = F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias(f"{key}_parts")
    large = pairs.groupBy(key).agg(parts).where(f"{key}_parts > 1")
    count = F.coalesce(f"{key}_parts", F.lit(1))
    part = F.pmod(F.xxhash64(other), count)
    block = F.pmod(F.xxhash64(key, part), F.lit(blocks)).cast("int")
    return pairs.join(large, key, "left").withColumns({f"{key}_block": block, f"{key}_parts": count})


def numbered_ids(pairs: DataFrame, key: str, blocks: int) -> DataFrame:
    """(id, number) from 0 without gaps: the ids of a block follow each other, those with pairs in
    several blocks come last."""
    own = F.when(F.col(f"{key}_parts") > 1, F.lit(blocks)).otherwise(F.col(f"{key}_block"))
    ids = pairs.select(F.col(key).alias("id"), own.alias("block")).distinct()
    return numbered(ids, "block", "id").select("id", F.col("number").cast("int"))


def looked_up(wanted: np.ndarray, numbers: str) -> np.ndarray:
    """The numbers of distinct sorted ids, from the table (id, number) read a batch at a time."""
    found = np.full(len(wanted), -1, dtype=np.int32)
    for batch in batches_of([numbers], ["id", "number"]):
        ids = batch.column(0).to_numpy()
        places = np.minimum(np.searchsorted(wanted, ids), len(wanted) - 1)
        known = wanted[places] == ids
        found[places[known]] = batch.column(1).to_numpy()[known]
    return found


_PACKED = "block int, own binary, counts binary, large binary, other binary, n binary, total binary"


def packing(own_numbers: str, other_numbers: str):
    """Function from the pairs of one block, in the order of their id, to one row of arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        pairs = pa.Table.from_batches(held)
        ids, others, n, total, large = (
            pairs.column(c).to_numpy() for c in ("id", "other", "n", "total", "large")
        )
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        wanted, places = np.unique(others, return_inverse=True)
        row = {
            "own": looked_up(ids[starts], own_numbers),
            "counts": np.diff(np.r_[starts, len(ids)]).astype(np.int32),
            "large": large[starts],
            "other": looked_up(wanted, other_numbers)[places],
            "n": n,
            "total": total,
        }
        columns = [pa.array([pairs.column("block")[0].as_py()], pa.int32())]
        columns += [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in row.values()]
        yield pa.RecordBatch.from_arrays(columns, names=["block", *row])

    return run


def side_of(pairs: DataFrame, key: str, blocks: int) -> DataFrame:
    """The pairs with one block of `key` in each partition, in the order of its ids."""
    rows = pairs.select(
        F.col(f"{key}_block").alias("block"),
        F.col(key).alias("id"),
        F.col("item" if key == "user" else "user").alias("other"),
        "n",
        "total",
        (F.col(f"{key}_parts") > 1).alias("large"),
    )
    return rows.repartitionById(blocks, "block").sortWithinPartitions("id")


def first_factors(ids: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """The rows with a unit vector `f`, drawn from hashes of the id: the same on every run and
    partitioning."""
    draws = [
        (F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(1 << 20)) + 0.5) / (1 << 20)
        for i in range(rank)
    ]
    drawn = ids.withColumn("f", F.array(*draws))
    norm = F.sqrt(F.aggregate("f", F.lit(0.0), lambda total, x: total + x * x))
    return drawn.withColumn("f", F.transform("f", lambda x: (x / norm).cast("float")))


def _targets(places: np.ndarray, targets: np.ndarray, count: int) -> pa.ListArray:
    """Per id the distinct blocks that need its factor."""
    both = np.unique(places.astype(np.int64) << 32 | targets.astype(np.int64))
    ends = np.searchsorted(both, np.arange(count + 1, dtype=np.int64) << 32)
    own = (both & 0xFFFFFFFF).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own, pa.int32()))


def solve(n: np.ndarray, sums: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """Factors from the sums of each id: the upper triangle of n v v', then r v."""
    upper = np.triu_indices(rank)
    width = len(upper[0])
    left = np.zeros((len(n), rank, rank))
    left[:, upper[0], upper[1]] = left[:, upper[1], upper[0]] = sums[:, :width]
    left += (reg * n)[:, None, None] * np.eye(rank)
    return np.linalg.solve(left, sums[:, width:, None])[:, :, 0].astype(np.float32)


def summed(
    places: np.ndarray,
    n: np.ndarray,
    total: np.ndarray,
    factors: np.ndarray,
    count: int,
    rows: np.ndarray | None = None,
) -> np.ndarray:
    """The sums of `count` ids over pairs in the order of their places; `rows` are the pairs' rows
    among the factors if they are not the same."""
    rank = factors.shape[1]
    upper = np.triu_indices(rank)
    width = len(upper[0])
    out = np.zeros((width + rank, count))
    for low in range(0, len(places), PAIRS_AT_ONCE):
        here = slice(low, low + PAIRS_AT_ONCE)
        own = places[here]
        # A row for each place of the factor: products and sums run along it.
        f = np.array((factors[here] if rows is None else factors[rows[here]]).T, dtype=float, order="C")
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ids, weighted = own[starts], n[here] * f
        for k, (i, j) in enumerate(zip(*upper, strict=True)):
            out[k, ids] += np.add.reduceat(weighted[i] * f[j], starts)
        for i in range(rank):
            out[width + i, ids] += np.add.reduceat(total[here] * f[i], starts)
    return np.ascontiguousarray(out.T)


def factors_between(folders: Sequence[str], rank: int, low: int, high: int) -> np.ndarray:
    """The stored factors numbered from `low` to below `high`."""
    out = np.zeros((high - low, rank), dtype=np.float32)
    inside = (ds.field("low") < high) & (ds.field("high") >= low)
    for batch in batches_of(folders, ["numbers", "f"], inside):
        for numbers, f in zip(batch.column(0), batch.column(1), strict=True):
            places = np.frombuffer(numbers.as_buffer(), np.int32) - low
            rows = np.frombuffer(f.as_buffer(), np.float32).reshape(-1, rank)
            if places.min() < 0 or places.max() >= high - low:
                here = (places >= 0) & (places < high - low)
                places, rows = places[here], rows[here]
            out[places] = rows
    return out


_FACTORS = "low int, high int, numbers binary, f binary"
_STEP = _FACTORS + ", id int, n double, sums array<double>, targets array<int>"
_STEP_TYPES = {
    "low": pa.int32(), "high": pa.int32(), "numbers": pa.binary(), "f": pa.binary(),
    "id": pa.int32(), "n": pa.float64(), "sums": pa.list_(pa.float64()), "targets": pa.list_(pa.int32()),
}


def _step_batch(rows: int, **columns) -> pa.RecordBatch:
    """Step rows; columns that are not given are null."""
    every = [columns.get(name, pa.nulls(rows, kind)) for name, kind in _STEP_TYPES.items()]
    return pa.RecordBatch.from_arrays(every, schema=pa.schema(_STEP_TYPES))


def _factor_columns(numbers: np.ndarray, factors: np.ndarray) -> dict[str, pa.Array]:
    """Factors and their numbers as one row."""
    return {
        "low": pa.array([int(numbers.min())], pa.int32()),
        "high": pa.array([int(numbers.max())], pa.int32()),
        "numbers": pa.array([numbers.astype(np.int32).tobytes()], pa.binary()),
        "f": pa.array([np.ascontiguousarray(factors, dtype=np.float32).tobytes()], pa.binary()),
    }


def factor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, f), the id being a number, as one row of arrays a batch."""
    for batch in batches:
        if batch.num_rows:
            columns = _factor_columns(batch.column("id").to_numpy(), matrix(batch.column("f")))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def single_factors(rank: int):
    """The reverse of `factor_rows`: a row (number, f) for each factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, f in zip(batch.column("numbers"), batch.column("f"), strict=True):
                factors = np.frombuffer(f.as_buffer(), np.float32).reshape(-1, rank)
                own = pa.array(np.frombuffer(numbers.as_buffer(), np.int32))
                yield pa.RecordBatch.from_arrays([own, arrays(factors)], names=["number", "f"])

    return run


def block_step(packed: str, sent: Sequence[str], count: int, rank: int, reg: float):
    """Function from the numbers of blocks to their ids' new factors, or the sums of the ids that
    have pairs in other blocks too. `count` factors of the other side lie in the folders `sent`."""
    width = max(1, FACTOR_BYTES // (4 * rank))
    slices = [(low, min(low + width, count)) for low in range(0, count, width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}

        def factors_of(bounds: tuple[int, int]) -> np.ndarray:
            if bounds not in held:
                held.clear()
                held[bounds] = factors_between(sent, rank, *bounds)
            return held[bounds]

        def stepped(own, counts, large, other, n, total) -> Iterator[pa.RecordBatch]:
            places = np.repeat(np.arange(len(own)), counts)
            starts = np.r_[0, np.cumsum(counts[:-1], dtype=np.int64)]
            if len(slices) == 1:
                sums = summed(places, n, total, factors_of(slices[0]), len(own), other)
            else:
                sums = 0.0
                for low, high in slices:
                    here = (other >= low) & (other < high)
                    rows = other[here] - low
                    sums = sums + summed(places[here], n[here], total[here], factors_of((low, high)), len(own), rows)
            ratings = np.add.reduceat(n, starts)
            whole, parted = np.flatnonzero(~large), np.flatnonzero(large)
            if len(whole):
                found = solve(ratings[whole], sums[whole], rank, reg)
                yield _step_batch(1, **_factor_columns(own[whole], found))
            if len(parted):
                nowhere = _targets(np.arange(len(parted)), np.zeros(len(parted)), len(parted))
                yield _step_batch(
                    len(parted), id=pa.array(own[parted]), n=pa.array(ratings[parted]),
                    sums=arrays(sums[parted]), targets=nowhere,
                )

        kinds = {"own": np.int32, "counts": np.int32, "large": bool, "other": np.int32, "n": float, "total": float}
        for batch in batches:
            for block in batch.column(0).to_pylist():
                for part in batches_of([f"{packed}/block={block}"], list(kinds)):
                    for row in range(part.num_rows):
                        own, counts, large, *by_pair = (
                            np.frombuffer(part.column(i)[row].as_buffer(), kind) for i, kind in enumerate(kinds.values())
                        )
                        ends = np.cumsum(counts, dtype=np.int64)
                        for low in range(0, len(own), IDS_AT_ONCE):
                            high = min(low + IDS_AT_ONCE, len(own))
                            pairs = slice(ends[low - 1] if low else 0, ends[high - 1])
                            yield from stepped(own[low:high], counts[low:high], large[low:high], *(x[pairs] for x in by_pair))

    return run


def solved(rank: int, reg: float):
    """Function that adds the sums of each id, sorted by it, and solves its normal equations."""

    def solution(ids, n, sums, targets) -> pa.RecordBatch:
        places, counts = np.repeat(np.arange(len(ids)), list(map(len, targets))), np.concatenate(targets)
        columns = [pa.array(ids, pa.int32()), arrays(solve(n, sums, rank, reg)), _targets(places, counts, len(ids))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "f", "targets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last id, whose sums may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n, sums = batch.column("id").to_numpy(), batch.column("n").to_numpy(), matrix(batch.column("sums"))
            targets = [np.array(t, dtype=np.int32) for t in batch.column("targets").to_pylist()]
            if held:
                ids, n, sums = np.r_[held[0], ids], np.r_[held[1], n], np.vstack([held[2], sums])
                targets = held[3] + targets
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            ends = np.r_[starts[1:], len(ids)]
            targets = [np.unique(np.concatenate(targets[a:b])) for a, b in zip(starts, ends, strict=True)]
            n, sums, ids = np.add.reduceat(n, starts), np.add.reduceat(sums, starts), ids[starts]
            held = ids[-1:], n[-1:], sums[-1:], targets[-1:]
            if len(ids) > 1:
                yield solution(ids[:-1], n[:-1], sums[:-1], targets[:-1])
        if held:
            yield solution(*held)

    return run


def rating_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per id and batch of rows (id, total, features): one rating each."""
    for batch in batches:
        if batch.num_rows:
            ids, places = np.unique(batch.column("id").to_numpy(), return_inverse=True)
            order = np.argsort(places, kind="stable")
            places, ones = places[order], np.ones(len(order))
            total, factors = batch.column("total").to_numpy()[order], matrix(batch.column("features"))
            sums = summed(places, ones, total, factors.astype(float)[order], len(ids))
            nowhere = _targets(np.arange(len(ids)), np.zeros(len(ids)), len(ids))
            columns = [pa.array(ids, pa.int32()), np.bincount(places).astype(float), arrays(sums), nowhere]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["id", "n", "sums", "targets"])


class Side:
    """The pairs of one side in the shared folder: packed blocks and the table of its numbers."""

    def __init__(self, pairs: DataFrame, key: str, blocks: int):
        self.spark, self.key, self.blocks = pairs.sparkSession, key, blocks
        self.numbers = self._written(numbered_ids(pairs, key, blocks), "numbers")
        self.count = self.table().count()
        self.parted = not pairs.where(f"{key}_parts > 1").isEmpty()
        self.packed = None

    def _written(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, f"{self.key}_{name}")
        df.write.parquet(path)
        return path

    def table(self) -> DataFrame:
        return self.spark.read.schema("id int, number int").parquet(self.numbers)

    def pack(self, pairs: DataFrame, other: Side) -> None:
        rows = side_of(pairs, self.key, self.blocks).mapInArrow(packing(self.numbers, other.numbers), _PACKED)
        self.packed = scratch_path(self.spark, f"{self.key}_blocks")
        rows.write.partitionBy("block").parquet(self.packed)

    def first(self, rank: int, seed: int) -> list[str]:
        """Folders of the first factors."""
        cores = self.spark.sparkContext.defaultParallelism
        drawn = first_factors(self.table().repartition(TASKS_PER_CORE * cores), "id", rank, seed)
        rows = drawn.select(F.col("number").alias("id"), "f").mapInArrow(factor_rows, _FACTORS)
        return [self._written(rows, "factors")]

    def half_step(self, sent: Sequence[str], count: int, rank: int, reg: float) -> list[str]:
        """Folders of the new factors, from `count` of the other side; large groups are put together here."""
        cores = self.spark.sparkContext.defaultParallelism
        tasks = self.spark.range(0, self.blocks, 1, min(self.blocks, TASKS_PER_CORE * cores))
        step = tasks.mapInArrow(block_step(self.packed, sent, count, rank, reg), _STEP)
        found = [self._written(step, "factors")]
        if self.parted:
            parts = self.spark.read.schema(_STEP).parquet(found[0]).where("sums is not null")
            together = parts.select("id", "n", "sums", "targets").repartition("id").sortWithinPartitions("id")
            large = together.mapInArrow(solved(rank, reg), "id int, f array<float>, targets array<int>")
            found.append(self._written(large.mapInArrow(factor_rows, _FACTORS), "large_factors"))
        return found

    def by_id(self, folders: Sequence[str], rank: int) -> DataFrame:
        """(id, f) of stored factors, in a table of their own."""
        rows = self.spark.read.schema(_FACTORS).parquet(*folders).where("f is not null").select("numbers", "f")
        single = rows.mapInArrow(single_factors(rank), "number int, f array<float>")
        return checkpointed(single.join(self.table(), "number").select("id", "f"))

    def delete(self) -> None:
        for path in (self.numbers, self.packed):
            if path:
                delete_scratch(self.spark, path)


def _delete_all(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        delete_scratch(spark, folder)


def as_model(users: DataFrame, items: DataFrame, rank: int) -> ALSModel:
    """Factor tables (id, f) as an ALSModel, for Spark's own scoring, top-k and storage."""
    java_model = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.recommendation.ALSModel",
        "split_als",
        rank,
        *[side.select("id", F.col("f").alias("features"))._jdf for side in (users, items)],
    )
    java_model.setUserCol(USER).setItemCol(ITEM).setColdStartStrategy("drop")
    return ALSModel(java_model)


def fit_split_als(triples: DataFrame, settings: AlsSettings, part_rows: int | None = None) -> ALSModel:
    """Alternate the two half steps; each one's factors are stored, and deleted when they have been used.

    The pairs are stored twice, in blocks of users and in blocks of books, so that only the sums
    of large groups move. A group is parted when it has more than `part_rows` pairs, if not
    given an eighth of a block. Lost partitions come back from the stored tables.
    """
    rank, reg, spark = settings.rank, settings.reg, triples.sparkSession
    cores = spark.sparkContext.defaultParallelism
    with ExitStack() as done:
        with stored_for_now(merged_pairs(triples), "merged_pairs") as merged:
            count = merged.count()
            blocks = max(TASKS_PER_CORE * cores, count // PAIRS_PER_BLOCK + 1)
            part_rows = part_rows or max(count // (blocks * PARTS_PER_BLOCK), LEAST_PART)
            both = in_blocks(in_blocks(merged, "user", blocks, part_rows), "item", blocks, part_rows)
            pairs = done.enter_context(stored_for_now(both, "blocks"))
        sides = []
        for key in ("user", "item"):
            sides.append(Side(pairs, key, blocks))
            done.callback(sides[-1].delete)
        users, items = sides
        free_shuffles(spark)
        for side, other in ((users, items), (items, users)):
            side.pack(pairs, other)
            free_shuffles(spark)
        of_users, of_items = [], items.first(rank, settings.seed)
        for _ in range(settings.max_iter):
            _delete_all(spark, of_users)
            of_users = users.half_step(of_items, items.count, rank, reg)
            _delete_all(spark, of_items)
            of_items = items.half_step(of_users, users.count, rank, reg)
        found = users.by_id(of_users, rank), items.by_id(of_items, rank)
        _delete_all(spark, [*of_users, *of_items])
    free_shuffles(spark)
    return as_model(*found, rank)
