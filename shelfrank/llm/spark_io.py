"""Steps the operators of this package share: stored tables, checked broadcasts, sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.session import scratch_path

# A table of at most so many narrow rows may be sent to every executor.
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, so that no later step repeats it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files of written tables that no later step reads."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent().getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def narrow_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast a narrow stored table if it is small; beyond that leave the join to Spark."""
    size = df.count() if rows is None else rows
    return F.broadcast(df) if size <= BROADCAST_ROWS else df


def named(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns an operator needs, under its own names: {own name: column}."""
    return df.select([df[f"`{column}`"].alias(own) for own, column in columns.items()])


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have, whatever the case of letters."""
    taken = {column.lower() for column in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without(docs: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The documents whose id is not among `ids`, a stored table of one column."""
    gone = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    same = F.col(f"d.`{id_column}`") == F.col("g.id")
    return docs.alias("d").join(narrow_side(gone).alias("g"), same, "left_anti")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition sorted by `keys`, each whole, over batch borders."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edge = np.zeros(batch.num_rows + 1, dtype=bool)
        edge[[0, -1]] = True
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        for column in columns:
            edge[1:-1] |= column[1:] != column[:-1]
        if held:
            last = held[-1]
            same = all(
                last.column(key)[last.num_rows - 1].as_py() == column[0]
                for key, column in zip(keys, columns, strict=True)
            )
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        bounds = np.flatnonzero(edge)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            held.append(batch.slice(low, high - low))
            if high < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
