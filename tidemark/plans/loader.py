"""Loaders: from a request to a lazy DataFrame, plainly or under a point-in-time cutoff."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.align import attach_daily, inner, outer, prefixed
from tidemark.operators.bars import daily_last, resample_ohlc
from tidemark.operators.lag import feature_lag, session_lag
from tidemark.operators.rules import apply_rules
from tidemark.plans import regime
from tidemark.sources.cache import ResultCache
from tidemark.sources.catalog import DEFAULT, Catalog
from tidemark.sources.scan import ORDINAL, Request, as_date, column, date_range, index_kind, ordered, project, scan, upcast, with_dte
from tidemark.sources.store import Store

#: Rules for which the order of a file's rows counts.
TIES = ("filter_duplicate_timestamps", "ffill_zero_close")
ALIGNED = ("spx_ohlc", "vix_ohlc", "vvix_ohlc", "vol_regime")


class Loader:
    """top: folder above the store. A cache keeps results on shared storage, keyed by request, catalogue and snapshot."""

    def __init__(self, spark: SparkSession, top: str, catalog: Catalog = DEFAULT, cache: ResultCache | None = None):
        self.spark, self.top, self.catalog, self.cache = spark, top.rstrip("/"), catalog, cache
        self.store = Store(spark, top, top, catalog)

    def load(self, dataset: str, dates: Any, columns=None, filters=(), resample: str | None = None, clean: bool = True, floats64: bool = True, sort: bool = True) -> DataFrame:
        """Scan, clean, resample, project, up-cast: one lazy plan. Empty results keep their schema."""
        d = self.catalog.get(dataset)
        start, end = date_range(dates)
        request = Request(d.name, start, end, tuple(columns) if columns else None, tuple(filters), resample, clean)
        key = request.fingerprint(self.catalog.fingerprint(), self.store.snapshot(d.name)) if self.cache else None
        if key and (hit := self.cache.get(key)) is not None:
            return upcast(hit) if floats64 else hit
        ties = clean and any(r.name in TIES for r in d.rules)
        df = scan(self.spark, self.top, d, request, ordinal=ties)
        if clean:
            df = apply_rules(df, d.rules, ORDINAL if ties else ()).drop(*ORDINAL)
        if resample:
            df = resample_ohlc(df, resample)
        df = project(df, columns)
        if sort and d.index in df.columns:
            df = ordered(df, d.index)
        if key:
            df = self.cache.put(key, d.name, df)
        return upcast(df) if floats64 else df

    def load_with_dte(self, dataset: str, dates: Any, columns=None, filters=()) -> DataFrame:
        d = self.catalog.get(dataset)
        start, end = date_range(dates)
        df = with_dte(scan(self.spark, self.top, d, Request(d.name, start, end, None, tuple(filters))), d.index)
        return project(df, [*columns, "dte", "dte_fractional"] if columns else None)

    def load_aligned(self, dates: Any, datasets=ALIGNED, regime_lag: int = 1, resample: str | None = None) -> DataFrame:
        """Intraday datasets joined on their timestamps, with each row's regime of `regime_lag` sessions before."""
        start, end = date_range(dates)
        daily = [n for n in datasets if self.catalog.get(n).kind == "regime"]
        frames = [prefixed(self.load(n, (start, end), resample=resample, floats64=False, sort=False).drop("year", "month"), n) for n in datasets if n not in daily]
        if not frames:
            return self.spark.createDataFrame([], "timestamp timestamp_ntz")
        df = outer(frames)
        for n in daily:
            back = start - dt.timedelta(days=3 * max(regime_lag, 0) + 7)
            rows = session_lag(self.load(n, (back, end), floats64=False, sort=False), regime_lag)
            df = attach_daily(df, rows.where(F.col("date").between(F.lit(start), F.lit(end))))
        return upcast(df)

    def available_dates(self, dataset: str) -> list[dt.date]:
        return self.store.available(dataset)

    def invalidate_cache(self, dataset: str | None = None) -> int:
        return self.cache.invalidate(dataset and self.catalog.resolve(dataset)) if self.cache else 0


class PointInTimeLoader:
    """A loader that never returns a row after its cutoff date, and only lagged regimes."""

    def __init__(self, loader: Loader, cutoff: Any, regime_lag: int = 1, feature_lag_bars: int = 0):
        if regime_lag < 1:
            raise ValueError("a regime of the same session looks ahead: lag at least 1")
        if feature_lag_bars < 0:
            raise ValueError("a feature lag below 0 looks ahead")
        self.loader, self.cutoff, self.regime_lag, self.feature_lag_bars = loader, as_date(cutoff), regime_lag, feature_lag_bars

    def _clamped(self, dates: Any) -> tuple[dt.date, dt.date, bool]:
        start, end = date_range(dates)
        return start, min(end, self.cutoff), start > self.cutoff

    def load(self, dataset: str, dates: Any, **more) -> DataFrame:
        start, end, late = self._clamped(dates)
        df = self.loader.load(dataset, (start, start) if late else (start, end), **more)
        return df.where(F.lit(False)) if late else enforce(df, self.loader.catalog.get(dataset).index, self.cutoff)

    def load_aligned(self, dates: Any, **more) -> DataFrame:
        start, end, late = self._clamped(dates)
        df = self.loader.load_aligned((start, start) if late else (start, end), regime_lag=self.regime_lag, **more)
        return df.where(F.lit(False)) if late else enforce(df, "timestamp", self.cutoff)

    def with_feature_lag(self, df: DataFrame, columns: list[str], by: list[str] | None = None, order: tuple[str, ...] = ()) -> DataFrame:
        return feature_lag(df, columns, self.feature_lag_bars, by, order)


def enforce(df: DataFrame, index: str, cutoff: dt.date) -> DataFrame:
    """Rows up to the end of the cutoff date, by the dataset's own index column."""
    if index not in df.columns:
        return df
    if index_kind(df, index) == "date":
        return df.where(column(df, index) <= F.lit(cutoff))
    return df.where(column(df, index) < F.lit(dt.datetime.combine(cutoff + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz"))


def store_regime(loader: Loader, x: str = "vix_ohlc", y: str = "vvix_ohlc", name: str = "vol_regime") -> int:
    """Build the daily regime from all stored closes, as they were stored, and write it. Rows written."""
    whole = (dt.date(1900, 1, 1), dt.date(2199, 12, 31))
    last = lambda n, c: daily_last(loader.load(n, whole, clean=False, sort=False), "close").withColumnRenamed("close", c)
    rows = regime.build(inner([last(x, "vix"), last(y, "vvix")], "date"))
    d = loader.catalog.get(name)
    rows.select(*d.columns).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{loader.top}/{d.store_path}")
    return loader.spark.read.parquet(f"{loader.top}/{d.store_path}").count()
