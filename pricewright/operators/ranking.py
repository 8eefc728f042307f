"""Dense numbering of a sorted set of distinct texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in the low 33 bits


def number_sorted(distinct: DataFrame, column: str, code: str) -> DataFrame:
    """Add ``code``: the 0-based rank of each row by ``column``, whose values must be distinct.

    The set is range-partitioned and sorted, written once, and a row's rank is the size of all earlier
    partitions plus its place in its own.
    """
    placed = materialise(
        distinct.select(column).repartitionByRange(column).sortWithinPartitions(column).withColumn("_place", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.shiftrightunsigned("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(column, (F.col("_offset") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)).cast("bigint").alias(code))
    )
