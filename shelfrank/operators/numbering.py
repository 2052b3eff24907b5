"""Row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import checkpointed

# monotonically_increasing_id keeps the row number in its low 33 bits.
ROW_BITS = 33


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows with a `number` from 0 upwards, without gaps, in the given order.

    A window without partitions would sort everything in one task. Here the rows
    are range-sorted, each sorted partition numbers its own rows and only one
    row per partition goes into the running offsets.
    """
    place = F.monotonically_increasing_id()
    # The checkpoint pins rows to partitions, so both passes below see the same places.
    ranked = checkpointed(rows.orderBy(*order).withColumn("place", place))
    ranked = ranked.withColumn("part", F.shiftright("place", ROW_BITS))
    sizes = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    row = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per sort partition: bounded by spark.sql.shuffle.partitions.
    return (
        ranked.join(F.broadcast(starts), "part")
        .withColumn("number", F.col("start") + row)
        .drop("part", "start", "place")
    )
