"""Ids that keep their number: label dictionaries that only ever grow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions.columns import INT_MAX
from shelfrank.operators.numbering import numbered
from shelfrank.sources import versions


def new_indices(rows: DataFrame, label: str, known: DataFrame | None = None) -> DataFrame:
    """(label, label_index) of the labels in the rows that `known` does not hold.

    They are numbered on from the greatest known index, the most frequent of the rows first and
    ties by label, so that without known labels the indices are those of `frequency_index`.
    Rows are reduced to a row per label before they are compared with the known ones. A
    null label gets no index. More labels than a 32-bit index can number are an error.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    start = F.lit(0)
    if known is not None:
        counts = counts.join(known.select(label), label, "left_anti")
        # One row.
        top = known.agg(F.coalesce(F.max(f"{label}_index") + 1, F.lit(0))).first()[0]
        start = F.lit(top)
    index = start.cast("long") + F.col("number")
    many = F.raise_error(F.lit(f"{label} has more labels than a 32-bit index can number"))
    checked = F.when(index <= INT_MAX, index.cast("int")).otherwise(many.cast("int"))
    return numbered(counts, F.desc("n"), label).select(label, checked.alias(f"{label}_index"))


@dataclass(frozen=True)
class IdDictionary:
    """A stored dictionary of one label column. Every batch of new labels is a version of its
    own, written once; what an earlier version says is never changed."""

    spark: SparkSession
    path: str
    label: str

    def _schema(self) -> str:
        return f"{self.label} string, {self.label}_index int"

    def read(self, version: int | None = None) -> DataFrame:
        """(label, label_index) of all versions, or of those up to one."""
        numbers = [n for n in versions.committed(self.spark, self.path) if version is None or n <= version]
        if not numbers:
            return self.spark.createDataFrame([], self._schema())
        folders = [versions.folder_of(self.path, n) for n in numbers]
        return self.spark.read.schema(self._schema()).parquet(*folders)

    def append(self, rows: DataFrame) -> DataFrame:
        """Add the labels that are new in the rows; the whole dictionary."""
        known = self.read()
        fresh = new_indices(rows, self.label, known)
        fresh.write.parquet(versions.new_folder(self.spark, self.path)[1])
        return self.read()
