"""Lags inside instruments and over sessions."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rules import contract_key

log = logging.getLogger(__name__)


def feature_lag(df: DataFrame, columns: list[str], bars: int, by: list[str] | None = None, order: tuple[str, ...] = (), index: str = "timestamp") -> DataFrame:
    """{column}_lag{bars}: the value `bars` rows earlier in the same instrument. by: keys instead of the contract's; [] is one series.

    Rows are numbered by instrument in blocks of (key, day) and joined to the numbers `bars` earlier, so an
    instrument that holds much of the data (or the one series) does not meet in one task.
    """
    if bars < 0:
        raise ValueError("a lag below 0 looks ahead")
    if not bars:
        return df
    have = [c for c in columns if c in df.columns]
    if missing := sorted(set(columns) - set(have)):
        log.warning("no such columns to lag: %s", missing)
    if not have:
        return df
    key = contract_key(df) if by is None else list(by)
    day = df.withColumn("_day", F.to_date(index))
    counts = day.groupBy(*key, "_day").agg(F.count(F.lit(1)).alias("_n"))
    past = Window.partitionBy(*key).orderBy(F.asc_nulls_first("_day")).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*key, "_day", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*key, "_day").orderBy(index, *order)
    ranked = day.withColumn("_own", F.row_number().over(inside))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*key, "_day"]]
    rows = ranked.alias("a").join(shift.alias("b"), on).select(*[F.col(f"a.{c}") for c in df.columns], (F.col("a._own") + F.col("b._shift")).alias("_at"))
    earlier = rows.select(*key, (F.col("_at") + bars).alias("_at"), *[F.col(c).alias(f"{c}_lag{bars}") for c in have])
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*key, "_at"]]
    return rows.alias("a").join(earlier.alias("b"), on, "left").select(*[F.col(f"a.{c}") for c in df.columns], *[F.col(f"b.{c}_lag{bars}") for c in have])


def session_lag(daily: DataFrame, sessions: int, date: str = "date") -> DataFrame:
    """Move each row to the date `sessions` observed dates later; the last ones, which have none, go. One row a date."""
    if sessions < 0:
        raise ValueError("a lag below 0 looks ahead")
    if not sessions:
        return daily
    later = F.lead(date, sessions).over(Window.orderBy(date))  # a row a session
    return daily.withColumn("_later", later).where("_later is not null").withColumn(date, F.col("_later")).drop("_later")
