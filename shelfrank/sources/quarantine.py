"""JSON lines with sight of those that do not fit: good rows here, broken lines there."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROKEN = "_broken"


@dataclass(frozen=True)
class CheckedLines:
    """`good`: typed rows; `broken`: file and line as it is; `counts`: per file n_good, n_broken."""

    good: DataFrame
    broken: DataFrame
    counts: DataFrame


def read_checked(spark: SparkSession, path: str, schema: str) -> CheckedLines:
    """Read JSON lines against a schema.

    A line is broken if it is no JSON object or if a value does not have the type of its
    column; fields that the schema does not name are passed over, missing ones are null, and
    blank lines count for nothing.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = lines.withColumn("row", F.from_json("value", f"{schema}, {BROKEN} string", options))
    # An array or a bare value parses, but not into a row.
    is_object = F.ltrim("value").startswith("{")
    bad = F.col("row").isNull() | F.col(f"row.{BROKEN}").isNotNull() | ~is_object
    marked = parsed.withColumn("bad", bad)
    return CheckedLines(
        good=marked.where("not bad").select("row.*").drop(BROKEN),
        broken=marked.where("bad").select("file", F.col("value").alias("line")),
        counts=marked.groupBy("file").agg(
            F.count_if(~F.col("bad")).alias("n_good"), F.count_if("bad").alias("n_broken")
        ),
    )


def read_and_quarantine(spark: SparkSession, path: str, schema: str, quarantine: str) -> DataFrame:
    """The good rows; the broken lines are written to a folder of their own, which may not exist yet."""
    checked = read_checked(spark, path, schema)
    checked.broken.write.json(quarantine)
    return checked.good
