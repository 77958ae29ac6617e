"""Cleaning rules: named DataFrame transformations with parameters, applied in order."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.catalog import CONTRACT_KEY, Rule
from tidemark.sources.scan import expiry_column, expiry_day

log = logging.getLogger(__name__)
HANDLERS: dict[str, Callable[..., DataFrame]] = {}


def rule(*names: str):
    """Register a function (df, **params) -> df under one or more names."""

    def put(f):
        HANDLERS.update(dict.fromkeys(names, f))
        return f

    return put


def apply_rules(df: DataFrame, rules, order: tuple[str, ...] = ()) -> DataFrame:
    """Rules in order. Unknown names are logged and skipped. order: unique columns that break ties of timestamp."""
    for r in rules:
        handler = HANDLERS.get(r.name)
        if handler is None:
            log.warning("unknown cleaning rule %s", r.name)
            continue
        params = dict(r.params)
        if getattr(handler, "ordered", False):
            params["order"] = order
        df = handler(df, **params)
    return df


def ordered_rule(f):
    f.ordered = True
    return f


def contract_key(df: DataFrame) -> list[str]:
    return [c for c in CONTRACT_KEY if c in df.columns]


def keep(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Rows on which all conditions hold; a null drops the row."""
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


@rule("drop_opening_bar")
def drop_opening_bar(df: DataFrame, time: str = "09:30:00", **_) -> DataFrame:
    """Drop rows of the given minute; seconds don't count."""
    h, m = (int(x) for x in time.split(":")[:2])
    return df.where(~((F.hour("timestamp") == h) & (F.minute("timestamp") == m)))


@rule("filter_illiquid", "filter_zero_bid")
def filter_illiquid(df: DataFrame, bid_gt=None, implied_vol_lte=None, underlying_price_gt=None, **_) -> DataFrame:
    conditions = []
    if bid_gt is not None:
        conditions.append(F.col("bid") > bid_gt)
    if implied_vol_lte is not None:
        name = next((c for c in ("implied_vol", "iv") if c in df.columns), None)
        if name is None:
            raise KeyError("no implied_vol or iv column")
        conditions.append(F.col(name) <= implied_vol_lte)
    if underlying_price_gt is not None:
        conditions.append(F.col("underlying_price") > underlying_price_gt)
    return keep(df, conditions)


@rule("ffill_zero_close")
@ordered_rule
def ffill_zero_close(df: DataFrame, enabled: bool = True, order=(), **_) -> DataFrame:
    """Zeros (and nulls) of open, high, low, close take the last earlier value of the contract; leading ones are null."""
    prices = [c for c in ("open", "high", "low", "close") if c in df.columns]
    return forward_fill(df, prices, contract_key(df), "timestamp", order) if enabled and prices else df


def forward_fill(df: DataFrame, columns: list[str], key: list[str], index: str, order=()) -> DataFrame:
    """Forward fill of zeros and nulls, in blocks of (key, day): a series of any length never meets in one task.

    Inside a block a window carries values on; what a block ends with is carried over the key's days, a row a day.
    """
    day = F.to_date(F.col(index))
    df = df.withColumn("_day", day)
    own = {c: F.when(F.col(c) != 0, F.col(c)) for c in columns}
    inside = Window.partitionBy(*key, "_day").orderBy(index, *order).rowsBetween(Window.unboundedPreceding, 0)
    at = F.struct(index, *order)
    ends = df.groupBy(*key, "_day").agg(*[F.max_by(own[c], F.when(own[c].isNotNull(), at)).alias(f"_end_{c}") for c in columns])
    before = Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*key, "_day", *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_past_{c}") for c in columns])
    filled = df.withColumns({f"_own_{c}": F.last(own[c], ignorenulls=True).over(inside) for c in columns})
    on = [F.col(f"f.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*key, "_day"]]
    joined = filled.alias("f").join(ends.alias("e"), on, "left")
    out = [F.coalesce(F.col(f"f._own_{c}"), F.col(f"e._past_{c}")).alias(c) if c in columns else F.col(f"f.{c}") for c in df.columns if c != "_day"]
    return joined.select(*out)


@rule("add_mid")
def add_mid(df: DataFrame, **_) -> DataFrame:
    if not {"bid", "ask"} <= set(df.columns):
        return df
    return df.withColumn("mid", ((F.col("bid") + F.col("ask")) / 2).cast("float"))


@rule("valid_from")
def valid_from(df: DataFrame, value="2023-04-13", **_) -> DataFrame:
    return df.where(F.col("date") >= F.lit(str(value)).cast("date")) if "date" in df.columns else df


@rule("filter_duplicate_timestamps")
@ordered_rule
def filter_duplicate_timestamps(df: DataFrame, keep: str = "last", order=(), **_) -> DataFrame:
    """One row for each timestamp of a contract: the first or last by the order columns, any, or none of several."""
    by = ["timestamp", *contract_key(df)]
    if keep == "any" or (keep in ("first", "last") and not order):
        return df.dropDuplicates(by)
    if keep == "none":
        alone = Window.partitionBy(*by)
        return df.withColumn("_n", F.count(F.lit(1)).over(alone)).where("_n = 1").drop("_n")
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first, last, any or none, not {keep!r}")
    way = F.desc if keep == "last" else F.asc
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*[way(c) for c in order])))
    return ranked.where("_rank = 1").drop("_rank")


def _middle() -> Column:
    return (F.col("bid") + F.col("ask")) / 2


def _spread(middle: Column) -> Column:
    return F.try_divide(F.col("ask") - F.col("bid"), middle) * 100


@rule("filter_outlier_spread")
def filter_outlier_spread(df: DataFrame, max_spread_pct: float = 5.0, **_) -> DataFrame:
    if not {"bid", "ask"} <= set(df.columns):
        return df
    middle = _middle()
    return df.where((middle > 0) & (_spread(middle) <= max_spread_pct))


@rule("filter_zero_oi")
def filter_zero_oi(df: DataFrame, open_interest_gt=None, oi_gt=None, **_) -> DataFrame:
    least = open_interest_gt if open_interest_gt is not None else oi_gt
    if least is None:
        return df
    return df.where(F.col("open_interest" if "open_interest" in df.columns else "oi") > least)


@rule("filter_zero_price")
def filter_zero_price(df: DataFrame, price_gt=None, **_) -> DataFrame:
    return df if price_gt is None else df.where(F.col("price") > price_gt)


@rule("filter_bogus_expirations")
def filter_bogus_expirations(df: DataFrame, min_year: int = 2000, max_year: int = 2040, **_) -> DataFrame:
    """Keep expiries of min_year to max_year; what is no date goes."""
    if not {"expiration", "expiry"} & set(df.columns):
        return df
    name = expiry_column(df)
    return df.where(F.year(expiry_day(F.col(name), df.schema[name].dataType)).between(min_year, max_year))


@rule("add_spread_pct")
def add_spread_pct(df: DataFrame, **_) -> DataFrame:
    if not {"bid", "ask"} <= set(df.columns):
        return df
    return df.withColumn("spread_pct", F.when(_middle() > 0, _spread(_middle())).cast("float"))


def rules_of(*items) -> tuple[Rule, ...]:
    from tidemark.sources.catalog import parse_rules

    return parse_rules(list(items))
