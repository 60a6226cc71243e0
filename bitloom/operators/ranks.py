"""Rows up to a rank without sorting the table.

The value at a rank is found by counting rows per value range and narrowing the range; each step
returns at most 4096 counts to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGES = 4096


def value_of_rank(values: DataFrame, rank: int) -> int:
    """Smallest integer of column ``v`` with more than ``rank`` values up to it."""
    low, high = values.agg(F.min("v"), F.max("v")).first()
    left = rank
    while low < high:
        width = -(-(high - low + 1) // _RANGES)
        inside = values.where(F.col("v").between(low, high))
        rows = inside.groupBy(F.floor((F.col("v") - low) / width).alias("b")).count().collect()
        for row in sorted(rows, key=lambda r: r["b"]):
            if left < row["count"]:
                low = low + row["b"] * width
                high = min(high, low + width - 1)
                break
            left -= row["count"]
    return low


def first_rows(df: DataFrame, n: int, order: str = "row_idx", tie: str = "sample_id") -> DataFrame:
    """The first n rows by an integer column, equal values by the unique column ``tie``; rows without a
    value come last. The value at rank n is found by counting, so no task sorts the table."""
    if n <= 0:
        return df.limit(0)
    key = F.col(order).cast("long")
    values = df.select(key.alias("v")).where("v IS NOT NULL")
    present = values.count()
    if present <= n:
        rest = df.where(key.isNull()).orderBy(tie).limit(n - present) if present < n else df.limit(0)
        return df.where(key.isNotNull()).unionByName(rest)
    bound = value_of_rank(values, n - 1)
    below = df.where(key < bound)
    return below.unionByName(df.where(key == bound).orderBy(tie).limit(n - below.count()))
