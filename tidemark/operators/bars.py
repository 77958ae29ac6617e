"""Bars: OHLC resampling, last values of a day, bars from prices and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lag import feature_lag

UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}
CALENDAR = {"w": "WEEK", "mo": "MONTH", "q": "QUARTER", "y": "YEAR"}


def label(every: str, index: str = "timestamp") -> Column:
    """Left edge of the left-closed bar that holds the index: "5m", "1h", "1d", or calendar "1w", "1mo", "1q", "1y"."""
    m = re.fullmatch(r"(\d+)(s|mo|m|h|d|w|q|y)(?:in)?", every)
    if not m or int(m[1]) < 1:
        raise ValueError(f"not a bar length: {every!r}")
    if m[2] in CALENDAR:
        if m[1] != "1":
            raise ValueError(f"calendar bars hold one {CALENDAR[m[2]].lower()}: {every!r}")
        return F.date_trunc(CALENDAR[m[2]], F.col(index)).cast("timestamp_ntz")
    return F.window(F.col(index), f"{m[1]} {UNITS[m[2]]}")["start"]


def resample_ohlc(df: DataFrame, every: str, by: tuple[str, ...] = (), order: tuple[str, ...] = (), index: str = "timestamp") -> DataFrame:
    """Open, high, low, close (and volume) of each bar; bars without a close are left out.

    by: keys that keep series apart (none: one series); order: columns that break ties of the index.
    """
    if index not in df.columns:
        return df
    at = F.struct(index, *order)
    prices = [F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close")]
    volume = [F.sum("volume").alias("volume")] if "volume" in df.columns else []
    bars = df.where(F.col(index).isNotNull()).groupBy(*by, label(every, index).alias(index)).agg(*prices, *volume)
    return bars.where(F.col("close").isNotNull())


def daily_last(df: DataFrame, value: str, index: str = "timestamp", order: tuple[str, ...] = ()) -> DataFrame:
    """date, and the last value of each calendar date."""
    return df.groupBy(F.to_date(index).alias("date")).agg(F.max_by(value, F.struct(index, *order)).alias(value))


def ohlc_from_price(df: DataFrame, price: str = "price", keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    return df.select(*keep, *[F.col(price).alias(c) for c in ("open", "high", "low", "close")])


def bars_from_path(df: DataFrame, value: str, index: str = "timestamp", by: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> DataFrame:
    """Bars of a path: open is the value before (the first its own), high and low hold both ends. Blocks of days, as in feature_lag(): no series meets in one task."""
    before = f"{value}_lag1"
    out = feature_lag(df, [value], 1, list(by), order, index).withColumn("open", F.coalesce(before, value)).drop(before)
    return out.withColumns({"high": F.greatest("open", value), "low": F.least("open", value), "close": F.col(value)})
