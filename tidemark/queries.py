"""Queries of the engine over the test tables, and the DuckDB SQL of the same rows."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, pricing
from tidemark.operators import bars, lag
from tidemark.operators.align import attach_daily, inner, outer, prefixed
from tidemark.operators.rules import apply_rules, forward_fill, rules_of
from tidemark.plans import fetching, lake, quality, regime, synthetic, views
from tidemark.plans.loader import PointInTimeLoader, enforce
from tidemark.sources import scan, store

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

START, END = dt.date(1995, 3, 1), dt.date(1995, 6, 30)
CUTOFF = dt.date(2024, 1, 20)
ORDER = ("row_key",)
KEY = ["user_id", "event_type"]


def query(sql: str | None, *needs: str):
    """Register a query and its SQL, before which the views it needs are defined."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            given = ", ".join(f"{n} AS ({views.SQL[n]})" for n in needs)
            ORACLE_SQL[f.__name__] = f"WITH {given} {sql}" if not sql.lstrip().startswith(",") else f"WITH {given} {sql}"
        return f

    return put


def _named(name: str, sql: str | None, needs, f):
    f.__name__ = name
    query(sql, *needs)(f)


# scans, filters, projections

_RANGE = "\"timestamp\" >= TIMESTAMP '1995-03-01' AND \"timestamp\" < TIMESTAMP '1995-07-01'"


@query(f"SELECT row_key, \"timestamp\", strike FROM quotes WHERE {_RANGE}", "quotes")
def scan_date_range(spark: SparkSession, d: str) -> DataFrame:
    q = views.quotes(spark, d)
    return q.where(scan.between(q, "timestamp", START, END)).select("row_key", "timestamp", "strike")


@query("SELECT date, vix FROM daily WHERE date BETWEEN DATE '1995-03-01' AND DATE '1995-06-30'", "daily")
def scan_dates_closed(spark, d):
    q = views.daily(spark, d)
    return q.where(scan.between(q, "date", START, END)).select("date", "vix")


@query('SELECT strike, bid, ask FROM quotes', "quotes")
def scan_projection(spark, d):
    return scan.project(views.quotes(spark, d), ["strike", "bid", "ask"])


@query("SELECT row_key, strike, bid FROM quotes WHERE \"right\" = 'PUT' AND strike >= 905 AND bid < 500.5 AND ask != 0", "quotes")
def filter_ops(spark, d):
    return scan.where_all(views.quotes(spark, d), [("right", "=", "PUT"), ("strike", ">=", 905), ("bid", "<", 500.5), ("ask", "!=", 0)]).select("row_key", "strike", "bid")


@query("SELECT row_key FROM quotes WHERE expiration LIKE '1995-%-1_'", "quotes")
def filter_like(spark, d):
    return scan.where_all(views.quotes(spark, d), [("expiration", "LIKE", "1995-%-1_")]).select("row_key")


@query("SELECT event_id, event_type FROM ticks WHERE event_type IN ('click', 'view')", "ticks")
def filter_in(spark, d):
    return scan.where_all(views.ticks(spark, d), [("event_type", "in", ["click", "view"])]).select("event_id", "event_type")


@query("SELECT event_id, event_type FROM ticks WHERE event_type NOT IN ('click', 'view')", "ticks")
def filter_not_in(spark, d):
    return scan.where_all(views.ticks(spark, d), [("event_type", "not  in", ("click", "view"))]).select("event_id", "event_type")


@query("SELECT l_orderkey, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS tax, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS discount FROM lineitem".replace("SELECT", ", x AS (SELECT 1) SELECT", 1), "daily")
def float_upcast(spark, d):
    df = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.col("l_tax").cast("float").alias("tax"), F.col("l_discount").cast("float").alias("discount"))
    return scan.upcast(df)


@query('SELECT "timestamp", event_id AS a_event_id, price AS a_price FROM ticks', "ticks")
def prefix_rename(spark, d):
    return prefixed(views.ticks(spark, d).select("timestamp", "event_id", "price"), "a_ohlc")


@query('SELECT DISTINCT CAST("timestamp" AS DATE) AS date FROM ticks', "ticks")
def available_dates(spark, d):
    return views.ticks(spark, d).select(F.to_date("timestamp").alias("date")).distinct()


@query("SELECT row_key, CAST(date_diff('day', CAST(\"timestamp\" AS DATE), CAST(expiration AS DATE)) AS INTEGER) AS dte FROM quotes", "quotes")
def dte_days(spark, d):
    return scan.with_dte(views.quotes(spark, d)).select("row_key", "dte")


@query("SELECT row_key, date_diff('second', \"timestamp\", CAST(expiration AS DATE) + INTERVAL '16 hours') / 86400.0e0 AS dte_fractional FROM quotes", "quotes")
def dte_fractional(spark, d):
    return scan.with_dte(views.quotes(spark, d)).select("row_key", "dte_fractional")


# cleaning rules

_CHAIN = [
    ("bogus_expiry", "filter_bogus_expirations", "year(TRY_CAST(expiration AS DATE)) BETWEEN 2000 AND 2040"),
    ("drop_opening_bar", {"drop_opening_bar": {"time": "09:30:00"}}, "NOT (hour(\"timestamp\") = 9 AND minute(\"timestamp\") = 30)"),
    ("filter_illiquid", {"filter_illiquid": {"bid_gt": 0.0, "implied_vol_lte": 100.0, "underlying_price_gt": 0.0}}, "bid > 0 AND implied_vol <= 100 AND underlying_price > 0"),
    ("filter_zero_bid", {"filter_zero_bid": {"bid_gt": 0.0}}, "bid > 0"),
    ("outlier_spread", {"filter_outlier_spread": {"max_spread_pct": 5.0}}, "(bid+ask)/2 > 0 AND (ask-bid)/((bid+ask)/2)*100 <= 5"),
    ("zero_oi", {"filter_zero_oi": {"open_interest_gt": 0}}, "open_interest > 0"),
    ("zero_price", {"filter_zero_price": {"price_gt": 0.0}}, "price > 0"),
]
for _name, _rule, _where in _CHAIN:
    if _name == "bogus_expiry":
        _where = "year(TRY_CAST(expiration AS DATE)) BETWEEN 1990 AND 2040"
        _rule = {"filter_bogus_expirations": {"min_year": 1990}}
    _named(f"rule_{_name}", f"SELECT row_key, bid, ask FROM quotes WHERE {_where}", ["quotes"], lambda spark, d, r=_rule: apply_rules(views.quotes(spark, d), rules_of(r), ORDER).select("row_key", "bid", "ask"))


@query("SELECT row_key, CAST((bid+ask)/2 AS FLOAT) AS mid FROM quotes", "quotes")
def rule_add_mid(spark, d):
    return apply_rules(views.quotes(spark, d), rules_of("add_mid")).select("row_key", "mid")


@query("SELECT row_key, CASE WHEN bid+ask > 0 THEN CAST((ask-bid)/((bid+ask)/2)*100 AS FLOAT) END AS spread_pct FROM quotes", "quotes")
def rule_spread_pct(spark, d):
    return apply_rules(views.quotes(spark, d), rules_of("add_mid", "add_spread_pct")).select("row_key", "spread_pct")


@query("SELECT row_key, strike FROM quotes", "quotes")
def rule_outlier_without_quotes(spark, d):
    return apply_rules(views.quotes(spark, d).select("row_key", "strike"), rules_of("filter_outlier_spread", "add_spread_pct"))


@query("SELECT date, vix FROM daily WHERE date >= DATE '1996-04-13'", "daily")
def rule_valid_from(spark, d):
    return apply_rules(views.daily(spark, d), rules_of({"valid_from": "1996-04-13"})).select("date", "vix")


_DEDUPE = 'SELECT row_key, bid FROM quotes QUALIFY row_number() OVER (PARTITION BY "timestamp", symbol, expiration, strike, "right" ORDER BY row_key {way}) = 1'


@query(_DEDUPE.format(way="DESC"), "quotes")
def rule_dedupe_last(spark, d):
    return apply_rules(views.quotes(spark, d), rules_of({"filter_duplicate_timestamps": {"keep": "last"}}), ORDER).select("row_key", "bid")


@query(_DEDUPE.format(way="ASC"), "quotes")
def rule_dedupe_first(spark, d):
    return apply_rules(views.quotes(spark, d), rules_of({"filter_duplicate_timestamps": {"keep": "first"}}), ORDER).select("row_key", "bid")


_FILL = 'last_value(CASE WHEN price <> 0 THEN price END IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'


@query(f"SELECT event_id, {_FILL} AS price FROM ticks", "ticks")
def rule_ffill_zero(spark, d):
    return forward_fill(views.ticks(spark, d), ["price"], KEY, "timestamp", ("event_id",)).select("event_id", "price")


_CLEAN = [{"filter_bogus_expirations": {"min_year": 1990}}, *[r for n, r, _ in _CHAIN if n in ("drop_opening_bar", "filter_illiquid")], "add_mid", {"filter_outlier_spread": {"max_spread_pct": 5.0}}]
_CLEAN_SQL = " AND ".join(w for n, _, w in _CHAIN if n in ("drop_opening_bar", "filter_illiquid", "outlier_spread")) + " AND year(TRY_CAST(expiration AS DATE)) BETWEEN 1990 AND 2040"


@query(f"SELECT row_key, CAST((bid+ask)/2 AS FLOAT) AS mid FROM quotes WHERE {_CLEAN_SQL}", "quotes")
def rule_chain(spark, d):
    return apply_rules(views.quotes(spark, d), rules_of(*_CLEAN), ORDER).select("row_key", "mid")


@query(f"SELECT row_key, strike, CAST((bid+ask)/2 AS FLOAT) AS mid FROM quotes WHERE {_RANGE} AND \"right\" = 'PUT' AND strike >= 905 AND {_CLEAN_SQL}", "quotes")
def quote_slice(spark, d):
    q = views.quotes(spark, d)
    q = scan.where_all(q.where(scan.between(q, "timestamp", START, END)), [("right", "=", "PUT"), ("strike", ">=", 905)])
    return apply_rules(q, rules_of(*_CLEAN), ORDER).select("row_key", "strike", "mid")


# bars and lags


def _ohlc(spark, d):
    return bars.ohlc_from_price(views.ticks(spark, d), "value", ("timestamp", "event_id", "user_id", "event_type"))


def _bars_sql(bucket: str, by: str = "") -> str:
    return f"SELECT {by} {bucket} AS \"timestamp\", arg_min(value, (\"timestamp\", event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (\"timestamp\", event_id)) AS close FROM ticks GROUP BY ALL"


@query(_bars_sql("time_bucket(INTERVAL '5 minutes', \"timestamp\")"), "ticks")
def resample_5m(spark, d):
    return bars.resample_ohlc(_ohlc(spark, d), "5m", order=("event_id",))


@query(_bars_sql("time_bucket(INTERVAL '1 hour', \"timestamp\")"), "ticks")
def resample_1h(spark, d):
    return bars.resample_ohlc(_ohlc(spark, d), "1h", order=("event_id",))


@query(_bars_sql("CAST(date_trunc('week', \"timestamp\") AS TIMESTAMP)", "event_type,"), "ticks")
def resample_week_by_type(spark, d):
    return bars.resample_ohlc(_ohlc(spark, d), "1w", by=("event_type",), order=("event_id",))


@query('SELECT CAST("timestamp" AS DATE) AS date, arg_max(value, ("timestamp", event_id)) AS value FROM ticks GROUP BY 1', "ticks")
def daily_close(spark, d):
    return bars.daily_last(views.ticks(spark, d), "value", order=("event_id",))


@query('SELECT "timestamp", event_id, price AS open, price AS high, price AS low, price AS close FROM ticks', "ticks")
def ohlc_from_price(spark, d):
    return bars.ohlc_from_price(views.ticks(spark, d), "price", ("timestamp", "event_id"))


@query(
    ', p AS (SELECT *, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id), value) AS open FROM ticks) SELECT event_id, open, greatest(open, value) AS high, least(open, value) AS low, value AS close FROM p',
    "ticks",
)
def bars_from_path(spark, d):
    return bars.bars_from_path(views.ticks(spark, d), "value", by=("user_id",), order=("event_id",)).select("event_id", "open", "high", "low", "close")


@query('SELECT event_id, lag(value, 1) OVER (PARTITION BY user_id, event_type ORDER BY "timestamp", event_id) AS value_lag1 FROM ticks', "ticks")
def feature_lag1(spark, d):
    return lag.feature_lag(views.ticks(spark, d), ["value"], 1, KEY, ("event_id",)).select("event_id", "value_lag1")


@query('SELECT event_id, lag(value, 2) OVER (PARTITION BY event_type ORDER BY "timestamp", event_id) AS value_lag2 FROM ticks', "ticks")
def feature_lag2_by_key(spark, d):
    return lag.feature_lag(views.ticks(spark, d), ["value"], 2, ["event_type"], ("event_id",)).select("event_id", "value_lag2")


@query('SELECT event_id, lag(value, 3) OVER (ORDER BY "timestamp", event_id) AS value_lag3 FROM ticks', "ticks")
def feature_lag_single_series(spark, d):
    return lag.feature_lag(views.ticks(spark, d), ["value"], 3, [], ("event_id",)).select("event_id", "value_lag3")


# volatility regime

_RANK = "CAST(CASE WHEN rn >= 252 THEN (SELECT count(*) FILTER (WHERE b.{c} <= a.{c}) / CAST(count(b.{c}) AS DOUBLE) FROM r b WHERE b.rn BETWEEN a.rn - 251 AND a.rn) END AS FLOAT)"
_Z = "CASE WHEN rn >= 20 THEN (({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0)) END"
_REGIME = (
    ", r AS (SELECT *, CAST(CAST(vvix / nullif(vix, 0) AS FLOAT) AS DOUBLE) AS vov_ratio, row_number() OVER (ORDER BY date) AS rn FROM daily), s AS (SELECT date, vix, vvix, vov_ratio, "
    + ", ".join(f"{_RANK.format(c=c)} AS {c}_pct_252" for c in ("vix", "vvix", "vov_ratio"))
    + ", "
    + ", ".join(f"{_Z.format(c=c)} AS {n}_z_20" for c, n in (("vix", "vix"), ("vvix", "vvix"), ("vov_ratio", "vov")))
    + " FROM r a WINDOW w AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)), l AS (SELECT *, "
    + ", ".join(f"CASE WHEN {c}_pct_252 < 0.25 THEN 'low' WHEN {c}_pct_252 < 0.5 THEN 'mid' WHEN {c}_pct_252 < 0.75 THEN 'high' ELSE 'extreme' END AS {n}_regime" for c, n in (("vix", "vix"), ("vvix", "vvix"), ("vov_ratio", "vov")))
    + " FROM s WHERE vix_pct_252 IS NOT NULL), g AS (SELECT *, CAST((vix_regime IN ('high','extreme'))::INT + (vvix_regime IN ('high','extreme'))::INT + (vov_regime IN ('high','extreme'))::INT AS TINYINT) AS regime_score, "
    "CASE WHEN vix_pct_252 >= 0.5 AND vix_z_20 >= 0 THEN 'high_rising' WHEN vix_pct_252 >= 0.5 AND vix_z_20 < 0 THEN 'high_falling' WHEN vix_pct_252 < 0.5 AND vix_z_20 >= 0 THEN 'low_rising' ELSE 'low_falling' END AS regime_2x2 FROM l), "
    "f AS (SELECT *, CASE WHEN regime_score >= 3 THEN 'crisis' WHEN regime_score >= 2 THEN 'elevated' WHEN regime_score >= 1 THEN 'normal' ELSE 'calm' END AS desk_bucket FROM g) "
)


_SCORES = ("vix_z_20", "vvix_z_20", "vov_z_20")


def _regime(name: str, *columns: str):
    """A query of some of the regime's columns; z-scores are rounded."""
    sql = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" if c in _SCORES else c for c in columns)

    def run(spark, d):
        rounded = [F.round(F.col(c).cast("double"), 4).alias(c) if c in _SCORES else F.col(c) for c in columns]
        return regime.build(views.daily(spark, d)).select(*rounded)

    _named(name, _REGIME + f"SELECT {sql} FROM f", ["daily"], run)


_SHARES = ("vix_pct_252", "vvix_pct_252", "vov_ratio_pct_252")
_LABELS = ("vix_regime", "vvix_regime", "vov_regime")
_regime("rolling_pct_rank", "date", *_SHARES)
_regime("rolling_zscore", "date", *_SCORES)
_regime("regime_labels", "date", *_LABELS)
_regime("regime_score", "date", "regime_score")
_regime("regime_2x2", "date", "regime_2x2")
_regime("desk_bucket", "date", "desk_bucket")
_regime("regime_full", "date", *_SCORES, *_SHARES, *_LABELS, "regime_score", "regime_2x2", "desk_bucket")


@query("SELECT date, round((rank() OVER (ORDER BY vix) + (count(*) OVER (PARTITION BY vix) - 1) / 2.0e0) / count(*) OVER (), 8) AS share, round(coalesce((vix - avg(vix) OVER ()) / nullif(stddev_samp(vix) OVER (), 0), 0), 6) AS z FROM daily", "daily")
def rank_average_and_z(spark, d):
    df = views.daily(spark, d)
    return df.select("date", F.round(regime.rank_average(F.col("vix")), 8).alias("share"), F.round(regime.z_all(F.col("vix")), 6).alias("z"))


_DEMO = (
    ", r AS (SELECT *, vvix / nullif(vix, 0) AS vov FROM daily), s AS (SELECT date, "
    + ", ".join(f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0) / count(*) OVER () AS {c}" for c in ("vix", "vvix", "vov"))
    + " FROM r), p AS (SELECT *, CAST(floor(vix * 3) + floor(vvix * 3) AS TINYINT) AS regime_score FROM s) SELECT date, "
    + ", ".join(f"CASE WHEN {c} < 0.25 THEN 'low' WHEN {c} < 0.75 THEN 'mid' WHEN {c} < 0.95 THEN 'high' ELSE 'extreme' END AS {c}_regime" for c in ("vix", "vvix", "vov"))
    + ", regime_score, CASE WHEN vix >= 0.5 THEN 'hi' ELSE 'lo' END || 'VIX/' || CASE WHEN vvix >= 0.5 THEN 'hi' ELSE 'lo' END || 'VVIX' AS regime_2x2, CASE WHEN regime_score >= 4 THEN 'defensive' WHEN regime_score >= 2 THEN 'neutral' ELSE 'carry' END AS desk_bucket FROM p"
)


@query(_DEMO, "daily")
def regime_demo(spark, d):
    return synthetic.demo_regime(views.daily(spark, d)).select("date", *_LABELS, "regime_score", "regime_2x2", "desk_bucket")


@query(
    ", x AS (SELECT row_key, ln(strike / underlying_price) AS m, sqrt(greatest((open_interest + 1) / 365.0e0, 1 / 98280.0e0)) AS r, implied_vol AS v FROM quotes WHERE underlying_price > 0) "
    "SELECT row_key, round(CASE WHEN w < 0.05 THEN 0.05e0 WHEN w > 3 THEN 3.0e0 ELSE w END, 6) AS vol FROM (SELECT row_key, v + v * 0.02e0 * (-0.9e0 * m / r) + v * 0.01e0 * 1.5e0 * pow(m / r, 2) AS w FROM x)",
    "quotes",
)
def vol_smile(spark, d):
    q = views.quotes(spark, d).where("underlying_price > 0")
    vol = pricing.smile(F.col("underlying_price"), F.col("strike"), (F.col("open_interest") + 1) / F.lit(365.0), F.col("implied_vol"))
    return q.select("row_key", F.round(vol, 6).alias("vol"))


# alignment and point in time


def _side(spark, d, kind: str, name: str):
    rows = views.ticks(spark, d).where(F.col("event_type") == kind)
    return prefixed(bars.resample_ohlc(bars.ohlc_from_price(rows, "value", ("timestamp", "event_id")), "1h", order=("event_id",)), name)


def _aligned(spark, d):
    return outer([_side(spark, d, "click", "a"), _side(spark, d, "view", "b")])


def _side_sql(kind: str, n: str) -> str:
    return f"{n} AS (SELECT time_bucket(INTERVAL '1 hour', \"timestamp\") AS \"timestamp\", arg_min(value, (\"timestamp\", event_id)) AS {n}_open, max(value) AS {n}_high, min(value) AS {n}_low, arg_max(value, (\"timestamp\", event_id)) AS {n}_close FROM ticks WHERE event_type = '{kind}' GROUP BY 1)"


_ALIGN = f", {_side_sql('click', 'a')}, {_side_sql('view', 'b')}, ab AS (SELECT * FROM a FULL JOIN b USING (\"timestamp\")), d AS (SELECT CAST(\"timestamp\" AS DATE) AS date, count(*) AS n, max(value) AS top FROM ticks GROUP BY 1), dl AS (SELECT lead(date, {{lag}}) OVER (ORDER BY date) AS date, n, top FROM d QUALIFY lead(date, {{lag}}) OVER (ORDER BY date) IS NOT NULL) "


def _daily_ticks(spark, d):
    return views.ticks(spark, d).groupBy(F.to_date("timestamp").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


@query(_ALIGN.format(lag=1) + "SELECT * FROM ab", "ticks")
def align_full_outer(spark, d):
    return _aligned(spark, d)


@query(_ALIGN.format(lag=2) + "SELECT date, n, top FROM dl", "ticks")
def regime_session_lag(spark, d):
    return lag.session_lag(_daily_ticks(spark, d), 2)


@query(_ALIGN.format(lag=1) + 'SELECT ab.*, n, top FROM ab LEFT JOIN dl ON CAST(ab."timestamp" AS DATE) = dl.date', "ticks")
def align_with_regime(spark, d):
    return attach_daily(_aligned(spark, d), lag.session_lag(_daily_ticks(spark, d), 1))


@query("SELECT event_id, \"timestamp\", price FROM ticks WHERE \"timestamp\" < TIMESTAMP '2024-01-21'", "ticks")
def pit_cutoff(spark, d):
    return enforce(views.ticks(spark, d), "timestamp", CUTOFF).select("event_id", "timestamp", "price")


@query(
    _ALIGN.format(lag=1) + "SELECT ab.*, n, top, lag(a_close) OVER (ORDER BY ab.\"timestamp\") AS a_close_lag1 FROM ab LEFT JOIN dl ON CAST(ab.\"timestamp\" AS DATE) = dl.date WHERE ab.\"timestamp\" < TIMESTAMP '2024-01-21'",
    "ticks",
)
def pit_aligned(spark, d):
    seen = enforce(views.ticks(spark, d), "timestamp", CUTOFF)
    df = outer([prefixed(bars.resample_ohlc(bars.ohlc_from_price(seen.where(F.col("event_type") == k), "value", ("timestamp", "event_id")), "1h", order=("event_id",)), n) for k, n in (("click", "a"), ("view", "b"))])
    df = attach_daily(df, lag.session_lag(_daily_ticks(spark, d), 1))
    return lag.feature_lag(enforce(df, "timestamp", CUTOFF), ["a_close"], 1, [])


@query(", v AS (SELECT date, vix FROM daily), w AS (SELECT date, vvix FROM daily WHERE vvix > 200000) SELECT date, vix, vvix, vvix / vix AS ratio FROM v JOIN w USING (date)", "daily")
def inner_join_daily(spark, d):
    df = views.daily(spark, d)
    both = inner([df.select("date", "vix"), df.where("vvix > 200000").select("date", "vvix")], "date")
    return both.withColumn("ratio", F.try_divide(F.col("vvix"), F.col("vix")))


# option pricing

_BS_CTE = (
    ", o AS (SELECT row_key, \"right\" = 'CALL' AS call, underlying_price AS s, strike AS k, greatest((open_interest + 1) / 365.0e0, 1e-6) AS t, implied_vol AS v FROM quotes WHERE implied_vol < 5 AND underlying_price > 0), "
    "p AS (SELECT *, (ln(s/k) + (0.05e0 + v*v/2)*t) / (v*sqrt(t)) AS d1, k*exp(-0.05e0*t) AS b FROM o), "
    "q AS (SELECT *, d1 - v*sqrt(t) AS d2, exp(-0.5e0*d1*d1)/sqrt(2*pi()) AS n1 FROM p), "
)
_CDF = "(0.5e0*(1+sign({x})*(1-((((1.061405429e0*{t}-1.453152027e0)*{t}+1.421413741e0)*{t}-0.284496736e0)*{t}+0.254829592e0)*{t}*exp(-({x})*({x})/2))))"


def _cdf(x: str) -> str:
    return _CDF.format(x=x, t=f"(1/(1+0.3275911e0*abs({x})/{math.sqrt(2)!r}e0))")


_BS_CTE += f"c AS (SELECT *, {_cdf('d1')} AS c1, {_cdf('d2')} AS c2, {_cdf('(-d1)')} AS m1, {_cdf('(-d2)')} AS m2 FROM q), g AS (SELECT *, CASE WHEN call THEN s*c1 - b*c2 ELSE b*m2 - s*m1 END AS price, CASE WHEN call THEN c1 ELSE c1 - 1 END AS delta FROM c) "
_BS = {
    "price": "price",
    "delta": "delta",
    "gamma": "n1 / (s*v*sqrt(t))",
    "theta": "(-s*n1*v/(2*sqrt(t)) + CASE WHEN call THEN -0.05e0*b*c2 ELSE 0.05e0*b*m2 END) / 365",
    "vega": "s*n1*sqrt(t)/100",
    "rho": "CASE WHEN call THEN b*t*c2 ELSE -b*t*m2 END / 100",
}


def _priced(spark, d):
    q = views.quotes(spark, d).where("implied_vol < 5 and underlying_price > 0")
    return pricing.black_scholes(q, F.col("underlying_price"), F.col("strike"), (F.col("open_interest") + 1) / F.lit(365.0), F.col("implied_vol"), F.col("right") == "CALL")


# a zero added: no negative zeros
for _greek, _sql in _BS.items():
    _named(f"bs_{_greek}", _BS_CTE + f"SELECT row_key, round({_sql}, 5) + 0.0e0 AS {_greek} FROM g", ["quotes"], lambda spark, d, g=_greek: _priced(spark, d).select("row_key", (F.round(g, 5) + 0.0).alias(g)))
_named("bs_lambda", _BS_CTE + 'SELECT row_key, round(delta*s/price, 4) AS "lambda" FROM g WHERE price > 1', ["quotes"], lambda spark, d: _priced(spark, d).where("price > 1").select("row_key", F.round("lambda", 4).alias("lambda")))


@query(
    ", x AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY))::DATE AS date), b AS (SELECT date FROM x WHERE isodow(date) <= 5), t AS (SELECT date, unnest(range(0, 390)) AS i FROM b) SELECT date, CAST(date + INTERVAL '9 hours 30 minutes' + to_minutes(i::INT) AS TIMESTAMP) AS \"timestamp\" FROM t",
    "daily",
)
def minute_grid(spark, d):
    return dates.minute_grid(dates.business_days(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)))


@query(
    ", x AS (SELECT DISTINCT \"timestamp\", underlying_price AS s FROM quotes WHERE year(\"timestamp\") = 1995 AND underlying_price > 0), k AS (SELECT *, unnest(range(-2, 3)) AS i FROM x) SELECT \"timestamp\", s, round(s/5)*5 + 5*i AS strike, r AS \"right\" FROM k, (VALUES ('CALL'), ('PUT')) v(r)",
    "quotes",
)
def chain_explode(spark, d):
    at = views.quotes(spark, d).where("year(timestamp) = 1995 and underlying_price > 0").select("timestamp", F.col("underlying_price").alias("s")).distinct()
    return synthetic.strikes_around(at, "s", steps=2, step=5)


# calendars, ingestion


@query(", x AS (SELECT unnest(generate_series(DATE '2023-02-01', DATE '2024-12-31', INTERVAL 1 DAY))::DATE AS date) SELECT date FROM x WHERE isodow(date) <= 5", "daily")
def business_calendar(spark, d):
    return dates.business_days(spark, dt.date(2023, 2, 1), dt.date(2024, 12, 31))


@query("SELECT date, CAST(date + CASE isodow(date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next FROM daily", "daily")
def next_business_day(spark, d):
    return views.daily(spark, d).select("date", dates.next_business_day(F.col("date")).alias("next"))


@query(
    ", m AS (SELECT unnest(generate_series(DATE '2023-02-01', DATE '2024-06-10', INTERVAL 1 MONTH))::DATE AS f) SELECT strftime(f, '%Y_%m') AS month, greatest(f, DATE '2023-02-15') AS start, least(last_day(f), DATE '2024-06-10') AS \"end\" FROM m", "daily"
)
def month_range(spark, d):
    return dates.months(spark, dt.date(2023, 2, 15), dt.date(2024, 6, 10))


@query('SELECT CAST("timestamp" AS DATE) AS session, count(*) AS n FROM ticks GROUP BY 1', "ticks")
def session_split_counts(spark, d):
    return store.split_sessions(views.ticks(spark, d)).groupBy("session").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, price, value FROM ticks WHERE day(\"timestamp\") IN (2, 3) UNION ALL SELECT event_id, price, NULL FROM ticks WHERE day(\"timestamp\") = 4", "ticks")
def union_days(spark, d):
    t = views.ticks(spark, d)
    day = lambda n: t.where(F.dayofmonth("timestamp") == n)
    return store.union_days([day(2).select("event_id", "price", "value"), day(3).select("price", "event_id", "value"), day(4).select("event_id", "price")])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM ticks UNION ALL SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1, event_type FROM ticks", "ticks")
def json_flatten(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    body = F.to_json(F.struct(F.struct("event_id", F.col("event_type").alias("kind")).alias("contract"), F.array(F.struct(k.alias("k")), F.struct((k + 1).alias("k"))).alias("data")))
    rows = views.ticks(spark, d).select(body.alias("body"))
    return store.flatten(rows, "body", "event_id bigint, kind string", "k bigint").select("event_id", "k", "kind")


@query("SELECT TRY_CAST(event_type AS DOUBLE) AS price, TRY_CAST(event_id AS INTEGER) AS event_id, CAST(NULL AS DATE) AS day FROM ticks", "ticks")
def coerced_cast(spark, d):
    rows = views.ticks(spark, d).select(F.col("event_type").alias("price"), "event_id")
    return store.coerced(rows, T.StructType([T.StructField("price", T.DoubleType()), T.StructField("event_id", T.IntegerType()), T.StructField("day", T.DateType())]))


@query("SELECT event_id, strftime(date_trunc('second', \"timestamp\"), '%Y-%m-%d %H:%M:%S') AS at FROM ticks", "ticks")
def timestamp_text(spark, d):
    return views.ticks(spark, d).select("event_id", dates.as_text(F.col("timestamp")).alias("at"))


# data checks


@query(", x AS (SELECT (ask-bid)/((bid+ask)/2)*100 AS s FROM quotes WHERE bid > 0 AND ask > 0) SELECT count(*) AS n, count(*) FILTER (WHERE s > 100) AS wide, round(quantile_cont(s, 0.5), 8) AS median, round(quantile_cont(s, 0.95), 8) AS p95, round(quantile_cont(s, 0.99), 8) AS p99 FROM x", "quotes")
def dq_spread_quantiles(spark, d):
    q = quality.spread_quantiles(views.quotes(spark, d))
    return q.select("n", "wide", *[F.round(c, 8).alias(c) for c in ("median", "p95", "p99")])


@query(', x AS (SELECT "timestamp", strike, "right", count(*) AS n FROM quotes GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n - 1) AS BIGINT) AS repeated FROM x', "quotes")
def dq_duplicates(spark, d):
    return quality.duplicates(views.quotes(spark, d).select("timestamp", "strike", "right"))


@query(", c AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 1 DAY))::DATE AS date) SELECT count(*) AS expected, count(h.date) AS present FROM c LEFT JOIN (SELECT DISTINCT CAST(\"timestamp\" AS DATE) AS date FROM ticks) h USING (date) WHERE isodow(c.date) <= 5", "ticks")
def dq_coverage(spark, d):
    return quality.coverage(views.ticks(spark, d), dates.business_days(spark, dt.date(2024, 1, 1), dt.date(2024, 2, 10)))


@query(
    ", a AS (SELECT time_bucket(INTERVAL '1 hour', \"timestamp\") AS t, min(value) AS v FROM ticks WHERE event_type = 'click' AND value > 0 GROUP BY 1), b AS (SELECT time_bucket(INTERVAL '1 hour', \"timestamp\") AS t, min(value) AS v FROM ticks WHERE event_type = 'view' AND value > 0 GROUP BY 1) SELECT count(*) AS points, round(max(abs(a.v - b.v)), 8) AS largest, round(avg(abs(a.v - b.v)), 6) AS mean FROM a JOIN b USING (t)",
    "ticks",
)
def dq_cross_consistency(spark, d):
    t = views.ticks(spark, d).withColumn("timestamp", bars.label("1h"))
    got = quality.cross_prices(t.where("event_type = 'click'"), t.where("event_type = 'view'"), "value", "value")
    return got.select("points", F.round("largest", 8).alias("largest"), F.round("mean", 6).alias("mean"))


def _check_sql(check: str, aggregates: dict[str, str], fail: str, warn: str, shown: list[str], of: str = "quotes") -> str:
    inner = ", ".join(f"{sql} AS {n}" for n, sql in aggregates.items())
    detail = " || ', ' || ".join(f"'{n}=' || coalesce(CAST({n} AS VARCHAR), '-')" for n in shown)
    return f"SELECT '{check}' AS \"check\", CASE WHEN {fail} THEN 'FAIL' WHEN {warn} THEN 'WARN' ELSE 'PASS' END AS status, {detail} AS detail FROM (SELECT {inner} FROM {of})"


_N = lambda w: f"count(*) FILTER (WHERE {w})"
_EXP = "TRY_CAST(expiration AS DATE)"
_CHECKS = {
    "prices": (
        _check_sql("prices", {"n": _N("bid > 0 AND ask > 0"), "negative": _N("bid < 0 OR ask < 0 OR price < 0"), "crossed": _N("bid > ask AND bid > 0 AND ask > 0"), "inverted": "0"}, "negative > 0 OR coalesce(crossed / nullif(n, 0), 0) > 0.01 OR inverted > 0", "crossed > 0", ["negative", "crossed", "inverted"]),
        lambda q: quality.prices(q, ["bid", "ask", "price"]),
    ),
    "strikes": (_check_sql("strikes", {"not_positive": _N("strike <= 0"), "odd": _N("strike < 950 OR strike > 15000"), "far": "0"}, "not_positive > 0", "odd + far > 0", ["not_positive", "odd", "far"]), lambda q: quality.strikes(q, low=950)),
    "greeks": (
        _check_sql("greeks", {"n": "count(*)", "delta_out": "0", "iv_negative": _N("implied_vol < 0"), "iv_high": _N("implied_vol > 5"), "vega_negative": "0"}, "false", "delta_out > 0 OR iv_negative > 0 OR iv_high / n > 0.2 OR vega_negative / n > 0.01", ["delta_out", "iv_negative", "iv_high", "vega_negative"]),
        quality.greeks,
    ),
    "timestamps": (
        _check_sql("timestamps", {"nulls": _N('"timestamp" IS NULL'), "future": _N("\"timestamp\" > TIMESTAMP '2030-01-01'"), "weekend": _N('isodow("timestamp") > 5'), "zero_open": _N('hour("timestamp") = 9 AND minute("timestamp") = 30 AND underlying_price = 0')}, "future > 0", "nulls + weekend + zero_open > 0", ["nulls", "future", "weekend", "zero_open"]),
        lambda q: quality.timestamps(q, F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"), "underlying_price"),
    ),
    "expirations": (_check_sql("expirations", {"weekend": f"count(DISTINCT expiration) FILTER (WHERE isodow({_EXP}) > 5 AND year({_EXP}) < 2040)"}, "weekend > 0", "false", ["weekend"]), quality.expirations),
    "spreads": (_check_sql("spreads", {"n": _N("bid > 0 AND ask > 0"), "wide": _N("bid > 0 AND ask > 0 AND ask-bid > (bid+ask)/2")}, "false", "n = 0 OR wide / n > 0.05", ["n", "wide"]), quality.spreads),
    "dte": (_check_sql("dte", {"n": "count(*)", "off": _N(f"{_EXP} <> CAST(\"timestamp\" AS DATE)")}, "false", "off > 0", ["n", "off"]), lambda q: quality.dte(q, 0)),
    "known_issues": (
        _check_sql("known_issues", {"bogus_expiry": _N(f"starts_with(expiration, '1882') OR year({_EXP}) > 2040"), "odd_symbols": _N("symbol NOT IN ('SYN')"), "calls": _N("\"right\" = 'CALL'"), "puts": _N("\"right\" = 'PUT'")}, "bogus_expiry > 0", "odd_symbols > 0 OR least(calls, puts) / greatest(calls, puts) < 0.3", ["bogus_expiry", "odd_symbols", "calls", "puts"]),
        lambda q: quality.known_issues(q, ["SYN"]),
    ),
    "open_interest": (_check_sql("open_interest", {"negative": _N("open_interest < 0"), "nulls": _N("open_interest IS NULL"), "largest": "max(open_interest)"}, "negative > 0", "nulls > 0", ["negative", "nulls", "largest"]), quality.open_interest),
}
for _name, (_sql, _check) in _CHECKS.items():
    _named(f"dq_{_name}", _sql, ["quotes"], lambda spark, d, c=_check: quality.run(q := views.quotes(spark, d), [c(q)]))
_ALL = " UNION ALL ".join(f"({sql})" for sql, _ in _CHECKS.values())


@query(_ALL.replace("(SELECT", ", all_checks AS ((SELECT", 1) + ") SELECT * FROM all_checks", "quotes")
def dq_report(spark, d):
    q = views.quotes(spark, d)
    return quality.run(q, [c(q) for _, c in _CHECKS.values()])


@query(_ALL.replace("(SELECT", ", all_checks AS ((SELECT", 1) + ") SELECT count(*) FILTER (WHERE status = 'PASS') AS \"pass\", count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'FAIL') AS fail, CASE WHEN bool_or(status = 'FAIL') THEN 'ISSUES FOUND' WHEN bool_or(status = 'WARN') THEN 'WARNINGS ONLY' ELSE 'CLEAN' END AS verdict FROM all_checks", "quotes")
def dq_summary(spark, d):
    return quality.summary(dq_report(spark, d))


_DECLARED = ("timestamp", "event_id", "event_type", "value", "price", "props", "volume")
_NAMES = "SELECT unnest(json_keys(to_json(t))) AS c FROM (SELECT * FROM ticks LIMIT 1) t"
_WANT = "SELECT unnest([" + ", ".join(f"'{c}'" for c in _DECLARED) + "]) AS c"


@query(
    f", have AS ({_NAMES}), want AS ({_WANT}), lost AS (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') AS m FROM (SELECT * FROM want EXCEPT SELECT * FROM have)), more AS (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') AS x FROM (SELECT * FROM have EXCEPT SELECT * FROM want)) "
    "SELECT 'schema' AS \"check\", CASE WHEN m <> '' THEN 'FAIL' WHEN x <> '' THEN 'WARN' ELSE 'PASS' END AS status, 'missing=' || m || ', extra=' || x AS detail FROM lost, more",
    "ticks",
)
def dq_schema(spark, d):
    declared = T.StructType([T.StructField(c, T.StringType()) for c in _DECLARED])
    return quality.check_schema(views.ticks(spark, d), declared)


@query(
    ", have AS (SELECT DISTINCT strftime(\"timestamp\", '%Y_%m') AS m FROM ticks), want AS (SELECT strftime(unnest(generate_series(DATE '2023-12-01', DATE '2024-02-28', INTERVAL 1 MONTH)), '%Y_%m') AS m), "
    "c AS (SELECT (SELECT count(*) FROM have) AS n, (SELECT count(*) FROM (SELECT * FROM want EXCEPT SELECT * FROM have)) AS missing) "
    "SELECT 'months' AS \"check\", CASE WHEN n = 0 THEN 'FAIL' WHEN missing > 0 THEN 'WARN' ELSE 'PASS' END AS status, 'n=' || n || ', missing=' || missing AS detail FROM c",
    "ticks",
)
def dq_months(spark, d):
    return quality.check_months(views.ticks(spark, d), dates.months(spark, dt.date(2023, 12, 1), dt.date(2024, 2, 28)))


# through the store and the loaders

_FROM, _TO = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
_DAYS = "\"timestamp\" >= TIMESTAMP '2024-01-05' AND \"timestamp\" < TIMESTAMP '2024-01-26'"
_F32 = "CAST(CAST({0} AS FLOAT) AS DOUBLE) AS {0}"


@query(f"SELECT event_id, \"timestamp\", {_F32.format('price')} FROM ticks WHERE {_DAYS} AND event_type IN ('click', 'view') AND CAST(price AS FLOAT) >= 5", "ticks")
def store_scan(spark, d):
    return lake.loader(spark, d).load("ticks", (_FROM, _TO), columns=["event_id", "timestamp", "price"], filters=[("event_type", "IN", ["click", "view"]), ("price", ">=", 5)], clean=False)


@query(f"SELECT event_id, user_id, {_F32.format('value')}, year(\"timestamp\")::INT AS year, month(\"timestamp\")::INT AS month FROM ticks WHERE {_DAYS} AND CAST(price AS FLOAT) > 0", "ticks")
def store_scan_by_alias(spark, d):
    return lake.loader(spark, d).load("old_ticks", (_FROM, _TO), columns=["event_id", "user_id", "value", "year", "month"])


@query(f"SELECT count(*) AS n, 0 AS inversions FROM ticks WHERE {_DAYS}", "ticks")
def store_order(spark, d):
    rows = lake.loader(spark, d).load("ticks", (_FROM, _TO), columns=["event_id", "timestamp"], clean=False).withColumn("i", F.monotonically_increasing_id())
    return inversions(rows.withColumn("block", F.floor(F.col("i") / 4096)))


def inversions(rows: DataFrame) -> DataFrame:
    """n, and how many rows have an earlier timestamp than the row before them in the same block, or blocks that begin before an earlier one ended. rows: timestamp, i (place), block."""
    inside = F.lag("timestamp").over(Window.partitionBy("block").orderBy("i"))
    turned = rows.withColumn("before", inside).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("timestamp")).alias("k"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    over = F.max("last").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    each = turned.withColumn("late", (F.coalesce(over, F.col("first")) > F.col("first")).cast("int"))
    return each.agg(F.sum("n").alias("n"), F.sum(F.col("k") + F.col("late")).cast("int").alias("inversions"))


@query('SELECT DISTINCT CAST("timestamp" AS DATE) AS date FROM ticks', "ticks")
def store_available(spark, d):
    return spark.createDataFrame([(x,) for x in lake.loader(spark, d).available_dates("ticks")], "date date")


@query(f"SELECT event_id, CAST(date_diff('day', CAST(\"timestamp\" AS DATE), CAST(expiration AS DATE)) AS INTEGER) AS dte FROM (SELECT *, CAST(\"timestamp\" AS DATE) + 2 AS expiration FROM ticks) WHERE {_DAYS}", "ticks")
def store_dte(spark, d):
    rows = lake.loader(spark, d).load("ticks", (_FROM, _TO), clean=False, sort=False)
    return scan.with_dte(rows.withColumn("expiration", F.date_add(F.to_date("timestamp"), 2))).select("event_id", "dte")


_SIDES = (_side_sql("click", "click"), _side_sql("view", "view"))
_LOADED = f", {_SIDES[0]}, {_SIDES[1]}, ab AS (SELECT * FROM click FULL JOIN view USING (\"timestamp\")), d AS (SELECT CAST(\"timestamp\" AS DATE) AS date, count(*) AS n, max(value) AS top FROM ticks GROUP BY 1), dl AS (SELECT lead(date) OVER (ORDER BY date) AS date, n, top FROM d), al AS (SELECT ab.*, n, top FROM ab LEFT JOIN dl ON CAST(ab.\"timestamp\" AS DATE) = dl.date) "


@query(_LOADED + f"SELECT * FROM al WHERE {_DAYS}", "ticks")
def loader_aligned(spark, d):
    return lake.loader(spark, d).load_aligned((_FROM, _TO), datasets=("click_ohlc", "view_ohlc", "day_regime"))


@query(_LOADED + "SELECT * FROM al WHERE \"timestamp\" >= TIMESTAMP '2024-01-05' AND \"timestamp\" < TIMESTAMP '2024-01-21'", "ticks")
def loader_point_in_time(spark, d):
    return PointInTimeLoader(lake.loader(spark, d), CUTOFF).load_aligned((_FROM, _TO), datasets=("click_ohlc", "view_ohlc", "day_regime"))


@query(f"SELECT event_id, \"timestamp\", {_F32.format('price')} FROM ticks WHERE \"timestamp\" >= TIMESTAMP '2024-01-05' AND \"timestamp\" < TIMESTAMP '2024-01-21' AND CAST(price AS FLOAT) > 0", "ticks")
def loader_cutoff(spark, d):
    return PointInTimeLoader(lake.loader(spark, d), CUTOFF).load("ticks", (_FROM, _TO), columns=["event_id", "timestamp", "price"])


@query('SELECT CAST("timestamp" AS DATE) AS session, count(*) AS rows FROM ticks GROUP BY 1', "ticks")
def store_file_sizes(spark, d):
    sizes = quality.file_sizes(spark, f"{lake.top(spark, d)}/store/ticks")
    return sizes.groupBy(F.to_date(F.regexp_extract("file", store.SESSION_OF, 1), "yyyyMMdd").alias("session")).agg(F.sum("rows").alias("rows"))


@query(
    ", f AS (SELECT 'ticks' AS dataset, count(*) AS n FROM ticks GROUP BY CAST(\"timestamp\" AS DATE) UNION ALL SELECT 'click_ohlc', count(DISTINCT time_bucket(INTERVAL '1 hour', \"timestamp\")) FROM ticks WHERE event_type = 'click' GROUP BY CAST(\"timestamp\" AS DATE)) "
    "SELECT coalesce(dataset, 'TOTAL') AS dataset, count(*) AS files, CAST(sum(n) AS BIGINT) AS rows, min(n) AS least, max(n) AS most, round(avg(n), 6) AS mean FROM f GROUP BY GROUPING SETS ((dataset), ())",
    "ticks",
)
def store_statistics(spark, d):
    where = lake.top(spark, d)
    return quality.statistics(spark, {n: f"{where}/store/{n}" for n in ("ticks", "click_ohlc")}).select("dataset", "files", "rows", "least", "most", F.round("mean", 6).alias("mean"))


@query(
    ", s AS (SELECT count(DISTINCT CAST(\"timestamp\" AS DATE)) AS k, count(DISTINCT time_bucket(INTERVAL '1 hour', \"timestamp\")) AS n FROM ticks WHERE event_type = 'view') "
    "SELECT 'migration view_ohlc' AS \"check\", 'PASS' AS status, 'sessions=' || k || ', missing=0, readable=true, rows=' || n AS detail FROM s UNION ALL SELECT 'store view_ohlc', 'PASS', 'files=' || k || ', rows=' || n FROM s",
    "ticks",
)
def store_validation(spark, d):
    where = lake.top(spark, d)
    own = store.Store(spark, f"{where}/raw", where, lake.CATALOG)
    files = own.stored_files("view_ohlc")
    return quality.report([quality.check_migration(spark, "view_ohlc", own.dates("view_ohlc"), own.available("view_ohlc"), files), quality.check_store(spark, "view_ohlc", files, {"timestamp", "close"})])


@query(
    ", x AS (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-03-05', INTERVAL 1 DAY))::DATE AS date) SELECT 'greeks/' || strftime(date, '%Y_%m') AS key, date AS start, date AS \"end\", CAST(date + CASE isodow(date) WHEN 5 THEN 3 ELSE 1 END AS DATE) AS expiration FROM x WHERE isodow(date) <= 5",
    "daily",
)
def fetch_schedule(spark, d):
    return fetching.schedule(spark, "greeks", dt.date(2024, 1, 10), dt.date(2024, 3, 5), dte=1)
