"""Places in one global order from totals of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Partitions summed in one block of the first level.
BLOCK = 1024


def part_offsets(totals: DataFrame, part: str, total: str, name: str = "offset") -> DataFrame:
    """(part, name): the sum of ``total`` over all partitions with a smaller number.

    ``totals`` has one row for each partition.  Two levels of prefix sums: over blocks of partitions, then inside each
    block, so a task meets ``BLOCK`` partitions or one row for each block.
    """
    placed = totals.select(F.col(part), F.col(total).alias("_t"), F.expr(f"`{part}` div {BLOCK}").alias("_block"))
    earlier = lambda w: F.coalesce(
        F.sum("_t").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    blocks = placed.groupBy("_block").agg(F.sum("_t").alias("_t"))
    blocks = blocks.select("_block", earlier(Window.orderBy("_block")).alias("_base"))
    inside = placed.select(part, "_block", earlier(Window.partitionBy("_block").orderBy(part)).alias("_own"))
    return inside.join(blocks, "_block").select(part, (F.col("_base") + F.col("_own")).alias(name))
