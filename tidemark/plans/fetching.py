"""What is to be fetched from a vendor, what has been, and how it is kept; the fetching itself is not part of this engine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates
from tidemark.sources.store import Files, coerced


def schedule(spark: SparkSession, dataset: str, start: dt.date, end: dt.date, dte: int | None = None) -> DataFrame:
    """key ("dataset/YYYY_MM"), start, end, expiration (null where there is none): a request a month, or one a business day for an expiry `dte` business days on."""
    months = dates.months(spark, start, end).withColumn("key", F.concat(F.lit(f"{dataset}/"), F.col("month")))
    if dte is None:
        return months.select("key", "start", "end", F.lit(None).cast("date").alias("expiration"))
    days = months.select("key", F.explode(F.sequence("start", "end")).alias("start")).where(F.weekday("start") < 5)
    expiry = F.col("start")
    for _ in range(dte):
        expiry = dates.next_business_day(expiry)
    return days.select("key", "start", F.col("start").alias("end"), expiry.alias("expiration"))


class Journal:
    """Keys that are done, a small file each, so that several writers can mark at once. path: a folder in any of Spark's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def mark(self, key: str, rows: int, size_mb: float) -> None:
        name = key.replace("%", "%25").replace("/", "%2F")
        self.files.write_text(f"{self.path}/{name}", f"{key} | {dt.datetime.now():%Y-%m-%dT%H:%M:%S} | {rows} rows | {size_mb:.1f} MB\n")

    def completed(self) -> set[str]:
        lines = [self.files.read_text(p) or "" for p, _, _ in self.files.find(f"{self.path}/*")]
        return {key for line in lines if (key := line.split("|")[0].strip())}

    def left(self, requests: DataFrame) -> DataFrame:
        """Requests whose key isn't done. The journal has a line a month and dataset."""
        done = self.spark.createDataFrame([(k,) for k in self.completed()], "key string")
        return requests.join(done, "key", "left_anti")


def save(df: DataFrame, path: str, schema: T.StructType) -> None:
    """One file of the schema's columns, coerced to their types; without rows, too, the file has its schema."""
    coerced(df, schema).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(path)
