"""Nearest neighbours with a hash-prefix forest.

Every vector gets one long hash string per tree, the signs of random projections; a
tree is the sorted array of these strings. A query descends in every tree to its longest
matching prefix, and then all trees ascend in step, one bit at a time, taking in whatever
shares the shorter prefix, until enough candidates are together. These are ranked by
their exact distances.

The rows are dealt into slices with a forest each, the queries into blocks, and every
block of queries visits every slice, which returns no more than its k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import delete, named, sorted_groups, written

TREES = 128
BITS = 24
SLICE_ROWS = 8192
QUERY_ROWS = 512
# Candidates per query and slice, as a share of the slice and at least so many. Measured
# recall is in the README; vectors of low contrast need a large share.
SHARE = 0.4
LEAST_CANDIDATES = 256
SEED = 5

_HIT = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not zero, and no component null or not finite."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    zero = F.forall(vector, lambda x: x == 0)
    return F.coalesce((F.size(vector) > 0) & ~odd & ~zero, F.lit(False))


class Forest:
    """Sorted hash strings of a slice: rows of a matrix, around a common centre."""

    def __init__(self, rows: np.ndarray, centre: np.ndarray):
        self.rows, self.centre = rows, centre
        rng = np.random.default_rng(SEED)
        self.planes = rng.standard_normal((rows.shape[1], TREES * BITS))
        codes = self.codes(rows)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """One hash string per tree and row, its first bit the highest."""
        found = np.empty((TREES, len(rows)), dtype=np.uint64)
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        for tree in range(TREES):
            planes = self.planes[:, tree * BITS : (tree + 1) * BITS]
            found[tree] = (((rows - self.centre) @ planes) > 0) @ weights
        return found

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """Per query the places of the rows met until `wanted` of them, or all, are together."""
        codes = self.codes(queries)
        depths = np.arange(BITS, -1, -1, dtype=np.uint64)
        low = np.empty((len(queries), BITS + 1, TREES), dtype=np.int64)
        high = np.empty_like(low)
        for tree in range(TREES):
            for k, depth in enumerate(depths):
                open_bits = np.uint64(BITS) - depth
                first = (codes[tree] >> open_bits) << open_bits
                last = first + (np.uint64(1) << open_bits)
                low[:, k, tree] = np.searchsorted(self.sorted[tree], first)
                high[:, k, tree] = np.searchsorted(self.sorted[tree], last)
        met_sizes = (high - low).sum(axis=2)
        for q in range(len(queries)):
            # Fewer meetings than wanted rows cannot be enough, so the ascent starts there.
            step = int(np.searchsorted(met_sizes[q], wanted))
            met = np.zeros(len(self.rows), dtype=bool)
            while True:
                step = min(step, BITS)
                for tree in range(TREES):
                    met[self.order[tree, low[q, step, tree] : high[q, step, tree]]] = True
                if step == BITS or np.count_nonzero(met) >= wanted:
                    break
                step += 1
            yield np.flatnonzero(met)


def _search(k: int, share: float, centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["dims", "slice", "block"]):
            ids = group.column("vec_id").to_numpy()
            asked = group.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
            dims = group.column("dims")[0].as_py()
            flat = group.column("vector").combine_chunks().flatten().to_numpy()
            matrix = flat.astype(np.float64).reshape(len(ids), dims)
            rows, row_ids = matrix[~asked], ids[~asked]
            queries, query_ids = matrix[asked], ids[asked]
            if not len(rows) or not len(queries):
                continue
            forest = Forest(rows, centres[dims])
            # The query may itself be among them.
            wanted = max(LEAST_CANDIDATES, int(np.ceil(share * len(rows)))) + 1
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for own, query, met in zip(
                query_ids, queries, forest.candidates(queries, wanted), strict=True
            ):
                met = met[row_ids[met] != own]
                distance = np.sqrt(((rows[met] - query) ** 2).sum(axis=1))
                best = np.lexsort((row_ids[met], distance))[:k]
                out.append((np.full(len(best), own), row_ids[met][best], distance[best]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(part)) for part in zip(*out, strict=True)],
                names=["query_id", "vec_id", "score"],
            )

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
    vector_column: str = "embedding", share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k nearest found of every query, without itself.

    The score is the Euclidean distance in double precision on the original vectors; ties
    go to the smaller id. Vectors that are null, zero or hold null or non-finite numbers
    take no part, nor do null ids; vectors are compared with those of their own length.
    Of copies of a vector only the k + 1 with the smallest ids can be among the k nearest
    of anything, so no more of them enter the slices, however common the vector is. Rows
    that repeat an id and a vector count once. An id with several vectors is several points:
    what is near any of a query's own is ranked in one list, with a row for each pair of points,
    so that an id can occur in it again. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    vector = F.transform(vectors[f"`{vector_column}`"], lambda x: x.cast("double"))
    rows = vectors.select(
        vectors[f"`{id_column}`"].cast("long").alias("vec_id"),
        vector.alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("dims", F.size("vector"))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.select("dims", "vector", "vec_id").distinct()
    first = first.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    first = written(first.drop("copy"), "vectors")
    asked = written(rows.where("is_query").select("dims", "vector", "vec_id").distinct(), "queries")

    sizes = {r["dims"]: r["n"] for r in first.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}
    queries = asked.count()
    blocks = max(1, -(-queries // QUERY_ROWS))
    slices = F.coalesce(
        *[F.when(F.col("dims") == d, F.lit(-(-n // SLICE_ROWS))) for d, n in sizes.items()], F.lit(1)
    )
    # One mean per dimension: as many rows as a vector has components.
    means = first.select("dims", F.posexplode("vector")).groupBy("dims", "pos").agg(F.avg("col").alias("m"))
    centres: dict[int, np.ndarray] = {d: np.zeros(d) for d in sizes}
    for r in means.collect():
        centres[r["dims"]][r["pos"]] = r["m"]

    dealt = first.select(
        "dims", F.pmod(F.xxhash64("vec_id"), slices).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(0).alias("is_query"), "vec_id", "vector",
    )
    visiting = asked.select(
        "dims", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"),
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(1).alias("is_query"), "vec_id", "vector",
    )
    keys = ["dims", "slice", "block"]
    together = dealt.unionByName(visiting).repartition(*keys).sortWithinPartitions(*keys)
    hits = together.mapInArrow(_search(k, share, centres), _HIT)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    result = written(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")
    delete(spark, first, asked)
    return result
