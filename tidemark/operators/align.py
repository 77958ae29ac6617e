"""Alignment of several series on their timestamps, with lagged daily values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, name: str, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """All but the keys as {name without _ohlc or _0dte}_{column}."""
    short = name.replace("_ohlc", "").replace("_0dte", "")
    return df.withColumnsRenamed({c: f"{short}_{c}" for c in df.columns if c not in keys})


def outer(frames: list[DataFrame], on: str = "timestamp") -> DataFrame:
    """Full outer join of all frames on one coalesced key."""
    return reduce(lambda a, b: a.join(b, on, "full"), frames)


def inner(frames: list[DataFrame], on: str = "timestamp") -> DataFrame:
    """Rows whose key all frames have."""
    return reduce(lambda a, b: a.join(b, on), frames)


def attach_daily(df: DataFrame, daily: DataFrame, index: str = "timestamp", date: str = "date") -> DataFrame:
    """Left join of daily rows (one a date) by the date of the index. A few thousand rows at most, so Spark broadcasts them by their size."""
    own = daily.withColumnRenamed(date, "_date")
    return df.withColumn("_date", F.to_date(index)).join(own, "_date", "left").drop("_date")
