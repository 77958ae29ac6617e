"""Stand-ins for market data over the test tables, with planted defects, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_QUOTES = """
SELECT concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey) AS row_key, 'SYN' AS symbol,
  CASE WHEN l_orderkey%97=0 THEN '1882-01-01' WHEN l_orderkey%101=0 THEN '2089-06-30' ELSE {expiry} END AS expiration,
  p_retailprice AS strike, CASE WHEN l_linestatus='F' THEN 'PUT' ELSE 'CALL' END AS {q}right{q}, {ts} AS {q}timestamp{q},
  CASE WHEN l_orderkey%50=0 THEN 0.0e0 ELSE l_extendedprice*(1-l_discount)/100 END AS bid, l_extendedprice/100 AS ask,
  CASE WHEN l_partkey%390=0 THEN 21474.8e0 ELSE 0.1e0+l_tax*5 END AS implied_vol,
  CASE WHEN l_partkey%390=0 THEN 0.0e0 ELSE 900+l_quantity*2 END AS underlying_price,
  CAST(l_quantity AS INT)-1 AS open_interest, CASE WHEN l_quantity>45 THEN 0.0e0 ELSE l_extendedprice/100 END AS price
FROM {lineitem} JOIN {part} ON l_partkey=p_partkey
"""
_TICKS = """
SELECT event_id, ts AS {q}timestamp{q}, user_id, event_type, value, CASE WHEN event_id%37=0 THEN 0.0e0 ELSE value END AS price, props FROM {events}
"""
_DAILY = "SELECT CAST(o_orderdate AS DATE) AS date, {last}(o_totalprice, o_orderkey) AS vix, max(o_totalprice) AS vvix FROM {orders} GROUP BY 1"

SQL = {
    "quotes": _QUOTES.format(q='"', lineitem="lineitem", part="part", ts="(l_shipdate + to_minutes(570+(l_partkey%390)::INT))", expiry="CAST(CAST(l_shipdate AS DATE) + (l_linenumber%8)::INT AS VARCHAR)"),
    "ticks": _TICKS.format(q='"', events="events"),
    "daily": _DAILY.format(last="arg_max", orders="orders"),
}


def _table(d: str, name: str) -> str:
    return f"parquet.`{d}/{name}.parquet`"


def quotes(spark: SparkSession, d: str) -> DataFrame:
    sql = _QUOTES.format(
        q="`", lineitem=_table(d, "lineitem"), part=_table(d, "part"), ts="timestampadd(MINUTE, 570+CAST(l_partkey%390 AS INT), CAST(l_shipdate AS TIMESTAMP_NTZ))", expiry="CAST(date_add(CAST(l_shipdate AS DATE), l_linenumber%8) AS STRING)"
    )
    return spark.sql(sql)


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_TICKS.format(q="`", events=_table(d, "events")))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_DAILY.format(last="max_by", orders=_table(d, "orders")))
