"""Calendars and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))


def business_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Weekdays; holidays are not known here."""
    return days(spark, start, end).where(F.weekday("date") < 5)


def next_business_day(c: Column) -> Column:
    return F.date_add(c, F.when(F.weekday(c) == 4, 3).when(F.weekday(c) == 5, 2).otherwise(1))


def minute_grid(dates: DataFrame, date: str = "date", first: str = "09:30:00", minutes: int = 390) -> DataFrame:
    """One timestamp for each minute of each session."""
    start = F.to_timestamp_ntz(F.concat(F.col(date).cast("string"), F.lit(f" {first}")))
    return dates.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(minutes - 1)))).withColumn("timestamp", F.timestamp_add("MINUTE", F.col("_i"), start)).drop("_i")


def months(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """month ("YYYY_MM") and its first and last day inside the range."""
    first = F.explode(F.sequence(F.trunc(F.lit(start), "month"), F.lit(end), F.expr("interval 1 month")))
    rows = spark.range(1).select(first.alias("m"))
    return rows.select(F.date_format("m", "yyyy_MM").alias("month"), F.greatest(F.col("m"), F.lit(start)).alias("start"), F.least(F.last_day("m"), F.lit(end)).alias("end"))


def as_text(c: Column) -> Column:
    """A time as YYYY-MM-DD HH:MM:SS."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
