"""Scans: dates, filters and projections that reach the Parquet reader."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.catalog import Dataset

COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def as_date(value: Any) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        return dt.datetime.strptime(value, "%Y%m%d").date() if len(value) == 8 and value.isdigit() else dt.date.fromisoformat(value[:10])
    raise TypeError(f"not a date: {value!r}")


def date_range(dates: Any) -> tuple[dt.date, dt.date]:
    """(start, end), both inclusive, from one date or a pair."""
    if isinstance(dates, (tuple, list)):
        if len(dates) != 2:
            raise ValueError("a range of dates has two ends")
        return as_date(dates[0]), as_date(dates[1])
    return as_date(dates), as_date(dates)


@dataclass(frozen=True)
class Request:
    """What to read. filters: (column, operator, value), all of which must hold."""

    dataset: str
    start: dt.date
    end: dt.date
    columns: tuple[str, ...] | None = None
    filters: tuple[tuple[str, str, Any], ...] = field(default=())
    resample: str | None = None
    clean: bool = True

    def fingerprint(self, *context: str) -> str:
        """Stable over runs; context: whatever else the result depends on (catalogue, snapshot of the store)."""
        shown = lambda v: {"type": type(v).__name__, "value": str(v)} if isinstance(v, (dt.date, dt.datetime)) else str(v)
        body = json.dumps([self.__dict__, context], default=shown, sort_keys=True)
        return hashlib.sha256(body.encode()).hexdigest()[:16]


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name; names are never parsed."""
    if name not in df.columns:
        raise ValueError(f"unknown column {name!r}")
    return F.col("`" + name.replace("`", "``") + "`")


def _literal(df: DataFrame, name: str, value: Any) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.FractionalType) and isinstance(value, (int, float)) and not isinstance(value, bool):
        return F.lit(float(value)).cast(kind)
    return F.lit(value)


def predicate(df: DataFrame, name: str, operator: str, value: Any) -> Column:
    """One filter. = != < <= > >= LIKE IN "NOT IN"; a LIKE pattern has no escape character."""
    op = " ".join(operator.upper().split())
    c = column(df, name)
    if op in COMPARISONS:
        return COMPARISONS[op](c, _literal(df, name, value))
    if op == "LIKE":
        return c.like(str(value).replace("\\", "\\\\"))
    if op in ("IN", "NOT IN"):
        values = list(value) if isinstance(value, (list, tuple, set, frozenset, range)) else [value]
        held = c.isin([_literal(df, name, v) for v in values]) if values else F.lit(False)
        return held if op == "IN" else ~held
    raise ValueError(f"Disallowed operator {operator!r}")


def where_all(df: DataFrame, filters) -> DataFrame:
    conditions = [predicate(df, *f) for f in filters]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def index_kind(df: DataFrame, index: str) -> str:
    """"timestamp" or "date", by type."""
    kind = df.schema[index].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return "timestamp"
    if isinstance(kind, T.DateType):
        return "date"
    raise ValueError(f"{index} is neither a timestamp nor a date")


def between(df: DataFrame, index: str, start: dt.date, end: dt.date) -> Column:
    """start <= index <= end in whole days: half-open on timestamps, closed on dates."""
    c = column(df, index)
    if index_kind(df, index) == "date":
        return c.between(F.lit(start), F.lit(end))
    day = lambda d: F.lit(dt.datetime(d.year, d.month, d.day)).cast(df.schema[index].dataType)
    return (c >= day(start)) & (c < day(end + dt.timedelta(days=1)))


def in_months(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Prunes year/month partitions that hold no day of the range."""
    if not {"year", "month"} <= set(df.columns):
        return df
    month = F.col("year") * 100 + F.col("month")
    return df.where(month.between(start.year * 100 + start.month, end.year * 100 + end.month))


#: A row's place in the store, where ties of the index are to be broken by it.
ORDINAL = ("_file", "_row")


def scan(spark: SparkSession, top: str, dataset: Dataset, request: Request, ordinal: bool = False) -> DataFrame:
    """Rows of a stored dataset in a range of dates. Columns are projected by project(), after the rules that may need others."""
    schema = T.StructType([*dataset.schema.fields, *[T.StructField(p, T.IntegerType()) for p in dataset.partitions]])
    path = f"{top}/{dataset.store_path if dataset.single_file else dataset.root}"
    have = spark.read.parquet(path).columns
    df = spark.read.schema(T.StructType([f for f in schema.fields if f.name in have])).parquet(path)
    if ordinal:
        df = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    df = in_months(df, request.start, request.end).where(between(df, dataset.index, request.start, request.end))
    return where_all(df, request.filters)


def project(df: DataFrame, columns) -> DataFrame:
    return df if columns is None else df.select(*[column(df, c) for c in columns])


def upcast(df: DataFrame) -> DataFrame:
    """Every 32-bit float as a 64-bit one."""
    return df.select(*[column(df, f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.FloatType) else column(df, f.name) for f in df.schema.fields])


def ordered(df: DataFrame, index: str) -> DataFrame:
    """Timestamp, strike, right on option chains, else the index."""
    keys = [index, "strike", "right"] if index == "timestamp" and {"strike", "right"} <= set(df.columns) else [index]
    return df.orderBy(*keys)


def expiry_column(df: DataFrame) -> str:
    for name in ("expiration", "expiry"):
        if name in df.columns:
            return name
    raise ValueError("no expiration or expiry column")


def with_dte(df: DataFrame, index: str = "timestamp", close: str = "16:00:00") -> DataFrame:
    """dte: calendar days to expiry; dte_fractional: days to the close on it, by boundaries of seconds."""
    day = expiry_day(F.col(expiry_column(df)), df.schema[expiry_column(df)].dataType)
    end = F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(f" {close}")))
    seconds = lambda c: F.unix_seconds(F.date_trunc("SECOND", c).cast("timestamp"))
    return df.withColumns({"dte": F.datediff(day, F.to_date(index)), "dte_fractional": (seconds(end) - seconds(F.col(index))) / F.lit(86400.0)})


def expiry_day(c: Column, kind: T.DataType) -> Column:
    """The date of an expiry held as text (YYYY-MM-DD at its start), date or timestamp; null where it is none."""
    if isinstance(kind, T.StringType):
        day = F.substring(c, 1, 10)  # a cast is far cheaper than a pattern, but takes shorter forms too
        return F.when((F.length(day) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-"), day.try_cast("date"))
    return c.cast("date")
