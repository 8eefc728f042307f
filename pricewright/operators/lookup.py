"""Joining a dimension onto many rows when nothing is known about either size or skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.session import materialise

BROADCAST_BYTES = 64 << 20


def table_bytes(dim: DataFrame, key: str) -> int:
    """Size of a dimension: its key text plus 16 bytes for every column. One small aggregate."""
    row = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(key).cast("string"))).alias("k")).first()
    return int(row["n"]) * 16 * len(dim.columns) + int(row["k"] or 0)


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys with more than ``share`` of all rows: at most 1 / share of them, whatever the data."""
    counts = materialise(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    return counts.where((F.col("_rows") > share * total) & F.col(key).isNotNull()).select(key)


def attach(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    limit_bytes: int = BROADCAST_BYTES,
    share: float | None = None,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Left equi-join of a dimension with one row per key.

    A dimension below ``limit_bytes`` is broadcast.  A larger one is joined in two parts.  Rows with a hot key get
    their values by a broadcast of the hot keys only, a bounded number, and rows without a key get none; neither is
    shuffled.  The rest, where no key has more than ``share`` of the rows, is shuffled by key.  By default that is
    the share of one shuffle partition, so no task gets more than about twice its part.
    """
    values = [c for c in dim.columns if c != key]
    size = table_bytes(dim, key) if dim_bytes is None else dim_bytes
    order = [key, *[c for c in df.columns if c != key], *values]
    if size <= limit_bytes:
        return df.join(F.broadcast(dim), key, "left").select(order)

    if share is None:
        share = 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = materialise(hot_keys(df, key, share).join(dim, key, "left").withColumn("_hot", F.lit(True)), "hot-keys")
    tagged = df.join(F.broadcast(hot), key, "left")
    loose = tagged.where(F.col("_hot").isNotNull() | F.col(key).isNull()).select(order)
    rest = df.where(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti").join(dim, key, "left").select(order)
    return loose.unionByName(rest)
