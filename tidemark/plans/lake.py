"""A small store over the test tables, through the same ingestion, splitting and loaders as market data."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import ohlc_from_price, resample_ohlc
from tidemark.plans import views
from tidemark.plans.loader import Loader
from tidemark.session import shared_dir
from tidemark.sources.catalog import Catalog
from tidemark.sources.store import Files, Store, write_sessions

_BARS = {"timestamp": "timestamp[us]", "open": "float64", "high": "float64", "low": "float64", "close": "float64"}
_SOURCE = "{name}/year={{year}}/month={{month:02d}}/{{date}}.parquet"


def _dataset(name: str, columns: dict, rules=(), **more) -> dict:
    return {"columns": columns, "rules": list(rules), "source_path": _SOURCE.format(name=name), "store_path": "store/" + _SOURCE.format(name=name), **more}


CATALOG = Catalog.from_dict(
    {
        "datasets": {
            "ticks": _dataset("ticks", {"event_id": "int64", "timestamp": "timestamp[us]", "user_id": "int64", "event_type": "utf8", "value": "float32", "price": "float32"}, [{"filter_zero_price": {"price_gt": 0.0}}], granularity="tick"),
            "click_ohlc": _dataset("click_ohlc", _BARS, granularity="1h"),
            "view_ohlc": _dataset("view_ohlc", _BARS, granularity="1h"),
            "day_regime": {"columns": {"date": "date32", "n": "int64", "top": "float64"}, "source_path": "day_regime.parquet", "store_path": "store/day_regime/day_regime.parquet", "partitions": (), "index": "date", "granularity": "daily", "kind": "regime"},
        },
        "aliases": {"old_ticks": "ticks"},
    }
)

_made: dict[tuple[str, str], str] = {}


def top(spark: SparkSession, d: str) -> str:
    """The store over the tables in d; made once an application, in the shared folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _made:
        where = f"{shared_dir(spark)}/tidemark-lake/{uuid.uuid4().hex}"
        _fill(spark, d, where)
        _made[key] = where
        atexit.register(_remove, spark, where)
    return _made[key]


def _remove(spark: SparkSession, where: str) -> None:
    try:
        Files(spark).delete(where)
    except Exception:  # the session may be gone already; the folder is scratch space
        return


def _fill(spark: SparkSession, d: str, where: str) -> None:
    ticks = views.ticks(spark, d)
    store = Store(spark, f"{where}/raw", where, CATALOG)
    for kind in ("click", "view"):
        own = ohlc_from_price(ticks.where(F.col("event_type") == kind), "value", ("timestamp", "event_id"))
        write_sessions(resample_ohlc(own, "1h", order=("event_id",)), f"{where}/raw/{kind}_ohlc")
        _must(store.ingest(f"{kind}_ohlc"))
    daily(ticks).coalesce(1).write.parquet(f"{where}/raw/day_regime.parquet")
    _must(store.ingest("day_regime"))
    store.split("ticks", ticks)


def _must(stats: dict) -> None:
    if stats["errors"]:
        raise RuntimeError(str(stats))


def daily(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy(F.to_date("timestamp").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


def loader(spark: SparkSession, d: str) -> Loader:
    return Loader(spark, top(spark, d), CATALOG)
