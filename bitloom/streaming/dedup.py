"""Repeated requests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_repeats(requests: DataFrame, keys: list[str], within: str = "1 hour") -> DataFrame:
    """Keeps one request per key; on a stream, repeats within the watermark delay are dropped."""
    if requests.isStreaming:
        return requests.withWatermark("ts", within).dropDuplicatesWithinWatermark(keys)
    return requests.dropDuplicates(keys)
