"""Exact duplicates by digest, screened with static filters over immutable snapshots.

Documents come in batches. A batch is first grouped within itself, so that a digest is one
row however many copies it has. Each row is then screened against the binary-fuse filters
of the snapshots before it, bucket by bucket. What passes is joined with the exact rows of
those snapshots; what is new makes the next snapshot, which never changes again. Only the
texts of documents that share a digest with another are read a second time and compared
byte for byte.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import binary_fuse
from shelfrank.llm.spark_io import delete, named, narrow_side, written

BLANKS = " \t\n\x0b\x0c\r"
BATCHES = 3
KEYS_PER_BUCKET = 1 << 17
# A text that holds this share of all rows or more is joined by broadcast. There are at most
# HEAVY of them; the rows of any other text are a small part of a partition.
HEAVY = 1000

_FILTERS = "snapshot int, bucket long, filter binary"
_CLASS = ["digest", "key", "n", "best"]
_MAXIMUM = (1 << 63) - 1
_IDS = 1 << 65


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rank(points: Column, own: Column) -> Column:
    """One number, greatest for the row that stays: most code points, then smallest id, null last.

    A decimal is updated in place by hash aggregation, a struct would need a sort.
    """
    place = F.lit(_MAXIMUM).cast("decimal(20,0)") - own.cast("decimal(20,0)") + F.lit(1)
    wide = points.cast("decimal(11,0)") * F.lit(str(_IDS)).cast("decimal(20,0)")
    return (wide + F.coalesce(place, F.lit(0))).cast("decimal(34,0)")


def _id_of(rank: Column) -> Column:
    place = (rank % F.lit(str(_IDS)).cast("decimal(34,0)")).cast("decimal(34,0)")
    own = (F.lit(str(_MAXIMUM + 1)).cast("decimal(34,0)") - place).cast("long")
    return F.when(place > 0, own)


def _classes(rows: DataFrame) -> DataFrame:
    """A row per digest: number of its rows and the rank of the one that stays."""
    return rows.groupBy("digest", "key").agg(F.sum("n").alias("n"), F.max("best").alias("best"))


@dataclass
class Snapshots:
    """Immutable sets of digests, each with a filter per bucket; all have the same buckets."""

    spark: SparkSession
    buckets: int
    tables: list[DataFrame]
    filters: list[DataFrame]

    def add(self, classes: DataFrame) -> None:
        """Freeze new classes as the next snapshot."""
        table = written(classes.select(*_CLASS, self.bucket().alias("bucket")), "snapshot")
        built = table.select("bucket", "key").groupBy("bucket").applyInArrow(_build(len(self.tables)), _FILTERS)
        self.tables.append(table)
        self.filters.append(written(built, "filters"))

    def bucket(self) -> Column:
        return F.pmod("key", F.lit(self.buckets)).cast("long")

    def screened(self, classes: DataFrame) -> DataFrame:
        """The classes with `passed`: whether a filter of any snapshot lets their key through."""
        rows = classes.select(*_CLASS, self.bucket().alias("bucket"))
        filters = reduce(DataFrame.unionByName, self.filters)
        kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns]
        pairs = rows.groupBy("bucket").cogroup(filters.groupBy("bucket"))
        return pairs.applyInArrow(_screen, ", ".join([*kinds, "passed boolean"]))

    def found(self, passed: DataFrame) -> DataFrame:
        """Passed classes that a snapshot does hold, with the class it holds."""
        parts = []
        for table in self.tables:
            home = table.select("bucket", "digest", F.col("n").alias("home_n"), F.col("best").alias("home_best"))
            parts.append(passed.join(home, ["bucket", "digest"]))
        return reduce(DataFrame.unionByName, parts)

    def delete(self) -> None:
        delete(self.spark, *self.tables, *self.filters)


def _build(snapshot: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().view(np.uint64)
        row = {
            "snapshot": pa.array([snapshot], pa.int32()),
            "bucket": table.column("bucket").slice(0, 1).combine_chunks(),
            "filter": pa.array([binary_fuse.build(keys)], pa.binary()),
        }
        return pa.table(row)

    return run


def _screen(classes: pa.Table, filters: pa.Table) -> pa.Table:
    keys = classes.column("key").to_numpy().view(np.uint64)
    passed = np.zeros(len(keys), dtype=bool)
    for one in filters.column("filter"):
        passed |= binary_fuse.contains(one.as_py(), keys)
    return classes.append_column("passed", pa.array(passed))


def _collided(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Digests of `shared` under which unequal texts lie.

    Equal texts collapse before they are sent, so many copies of one text cost no more
    than one for every task.
    """
    texts = rows.join(narrow_side(shared.select("key")), "key", "left_semi")
    variants = texts.select("digest", "body").distinct()
    return variants.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")


def _with_class(rows: DataFrame, classes: DataFrame, total: int, on: list[str]) -> DataFrame:
    """Rows with `size` and `best` of their class, null where it has one row only."""
    sizes = classes.select(*on, F.col("n").alias("size"), "best")
    heavy = sizes.where(F.col("size") * HEAVY >= total)
    rest = sizes.where(F.col("size") * HEAVY < total)
    marked = rows.join(F.broadcast(heavy.withColumnsRenamed({"size": "hs", "best": "hb"})), on, "left")
    known, open_rows = marked.where("hs is not null"), marked.where("hs is null")
    joined = open_rows.drop("hs", "hb").join(rest, on, "left")
    return known.withColumnsRenamed({"hs": "size", "hb": "best"}).unionByName(joined)


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    batches: int = BATCHES,
    digest: Callable[[Column], Column] = sha256,
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """Per document doc_id, keep_id, group_size, kept and text_sha256 of its normalised text.

    Texts are equal when they are the same after all ASCII blanks are deleted; a null text
    counts as empty, so that null, empty and blank texts make one group. Of equal texts the
    row with most code points stays, then that with the smallest id. Ids are integers. A
    row without an id stays only where no row as long has one; then keep_id is null. Rows
    that share text, length and id are one document and carry the same values. An empty
    table gives an empty result; other columns are not read.

    `digest` may be weaker than SHA-256: texts that it confuses are told apart by their
    bytes. Memory of a task: the keys of one bucket.
    """
    spark = docs.sparkSession
    source = named(docs, {"id": id_column, "text": text_column})
    body = normalised(F.col("text"))
    texts = source.select(F.col("id").cast("long").alias("id"), F.length("text").alias("points"), body.alias("body"))
    points = F.coalesce("points", F.lit(0))
    hashed = texts.withColumn("digest", digest(F.col("body"))).withColumn("key", F.xxhash64("digest"))
    narrow = written(
        hashed.select(
            "id", "digest", "key", F.sha2("body", 256).alias("sha"), _rank(points, F.col("id")).alias("best"),
            F.lit(1).cast("long").alias("n"), F.pmod(F.xxhash64("id"), F.lit(batches)).alias("batch"),
        ),
        "digests",
    )
    total = narrow.count()

    snapshots = Snapshots(spark, total // (batches * keys_per_bucket) + 1, [], [])
    # Classes of more than one row by batch; single rows that a later batch meets again.
    several, met, scratch = [], [], [narrow]
    for number in range(batches):
        own = written(_classes(narrow.where(F.col("batch") == number)), "classes")
        scratch.append(own)
        several.append(own.where("n > 1").select(*_CLASS))
        if number == 0:
            snapshots.add(own)
            continue
        screened = written(snapshots.screened(own), "screened")
        found = written(snapshots.found(screened.where("passed")), "found")
        scratch += [screened, found]
        several.append(found.where("n = 1").select(*_CLASS))
        home = found.select("digest", "key", F.col("home_n").alias("n"), F.col("home_best").alias("best"))
        met.append(home.where("n = 1"))
        if number < batches - 1:
            snapshots.add(screened.join(found.select("digest"), "digest", "left_anti"))

    if met:
        several.append(reduce(DataFrame.unionByName, met).distinct())
    union = reduce(DataFrame.unionByName, several)
    shared = written(_classes(union), "shared")
    collided = written(_collided(hashed, shared), "collided")
    plain = shared.join(collided, "digest", "left_anti") if not collided.isEmpty() else shared
    judged = _with_class(narrow.select("id", "digest", "sha", F.col("best").alias("own")), plain, total, ["digest"])
    if not collided.isEmpty():
        judged = judged.join(collided, "digest", "left_anti")
        rows = hashed.join(collided, "digest", "left_semi").withColumn("best", _rank(points, F.col("id")))
        rows = rows.withColumn("n", F.lit(1).cast("long"))
        apart = rows.groupBy("digest", "body").agg(F.sum("n").alias("n"), F.max("best").alias("best"))
        own = rows.select("id", "digest", "body", F.sha2("body", 256).alias("sha"), F.col("best").alias("own"))
        told = _with_class(own, apart, total, ["digest", "body"])
        judged = judged.unionByName(told.drop("body"))
    keep = _id_of(F.coalesce("best", "own"))
    out = judged.select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    result = written(out, "exact_duplicates")
    snapshots.delete()
    delete(spark, *scratch, shared, collided)
    return result
