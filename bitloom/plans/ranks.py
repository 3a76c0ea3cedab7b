"""Numbering all rows of a table without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.plans.runtime import checkpointed


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, the zero-based place of each row in the order.

    One range-partitioned sort is checkpointed; a row's place is that within its partition plus
    the rows of the partitions before (a table of one row per partition). Rows equal in ``order`` are numbered in any order.
    """
    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count("*").alias("_c"), F.min("_id").alias("_start"))
    before = F.coalesce(F.sum("_c").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", (before - F.col("_start")).alias("_shift"))
    joined = placed.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(shifts), "_part")
    return joined.withColumn(name, F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")
