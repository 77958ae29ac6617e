"""Streaming forms of two operators: keyed de-duplication and time bars, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zoned(df: DataFrame, index: str = "timestamp") -> DataFrame:
    """Watermarks need a zoned timestamp; under a UTC session the wall clock stays the same."""
    return df.withColumn(index, F.col(index).cast("timestamp"))


def distinct_ticks(stream: DataFrame, keys: list[str], late: str = "10 minutes", index: str = "timestamp") -> DataFrame:
    """One row for each key and timestamp within the watermark (which of several is not determined)."""
    return zoned(stream, index).withWatermark(index, late).dropDuplicatesWithinWatermark([index, *keys])


def stream_bars(stream: DataFrame, every: str, value: str, by: list[str], late: str = "10 minutes", index: str = "timestamp") -> DataFrame:
    """Open, high, low, close of `value` by window and key."""
    own = zoned(stream, index).withWatermark(index, late).groupBy(F.window(index, every), *by)
    bars = own.agg(F.min_by(value, index).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, index).alias("close"))
    return bars.select(F.col("window.start").alias(index), *by, "open", "high", "low", "close")
