"""A synthetic raw feed with planted defects, for demonstrations and tests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, pricing
from tidemark.operators.bars import bars_from_path, daily_last
from tidemark.plans import regime


@dataclass(frozen=True)
class Spec:
    start: dt.date = dt.date(2024, 1, 2)
    end: dt.date = dt.date(2024, 1, 5)
    spot: float = 4750.0
    vix: float = 14.0
    steps: int = 5
    step: float = 5.0
    dtes: tuple[int, ...] = (0, 1)
    seed: int = 7


# The volatility index's mean, pull and shock a minute, and the range it is held to; minutes of a session, days of a year
VIX_MEAN, VIX_PULL, VIX_SHOCK = 15.0, 0.002, 0.08
VIX_RANGE = (9.0, 60.0)
MINUTES, YEAR_DAYS = 390, 365.0


def noise(seed: int, *keys: str) -> Column:
    """A standard normal value fixed by the keys, by Box and Muller from two hashes."""
    u = lambda n: (F.pmod(F.xxhash64(F.lit(seed), F.lit(n), *keys), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return F.sqrt(-2 * F.log(u(1))) * F.cos(2 * 3.141592653589793 * u(2))


def carried(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """rows beside their session's row of ends (a row a session)."""
    return rows.join(ends, "date")


def mean_reverting(grid: DataFrame, start: float, mean: float, pull: float, shock: float, seed: int, held: tuple[float, float]) -> DataFrame:
    """An Ornstein-Uhlenbeck path over all sessions, held to a range: inside a session a weighted sum of past shocks, whose weights decay by
    (1 - pull) a minute; what a session ends with is handed on over the sessions, a row each."""
    keep, inside = 1 - pull, Window.partitionBy("date").orderBy("timestamp")
    rows = grid.withColumn("i", F.row_number().over(inside) - 1)
    own = F.when(F.col("i") > 0, noise(seed, "timestamp") * shock).otherwise(0.0)  # the first minute is where the session before ended
    rows = rows.withColumn("sum", F.sum(own * F.pow(F.lit(1 / keep), F.col("i"))).over(inside.rowsBetween(Window.unboundedPreceding, 0)) * F.pow(F.lit(keep), F.col("i")))
    ends = rows.groupBy("date").agg(F.max_by("sum", "i").alias("end"), (F.max("i")).alias("last"))
    past = F.collect_list(F.struct("end", F.pow(F.lit(keep), F.col("last")).alias("left"))).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    first = F.aggregate(past, F.lit(start - mean), lambda x, day: x * day["left"] + day["end"])
    ends = ends.select("date", first.alias("first"))
    value = F.lit(mean) + F.col("first") * F.pow(F.lit(keep), F.col("i")) + F.col("sum")
    return carried(rows, ends).select("date", "timestamp", F.greatest(F.lit(held[0]), F.least(F.lit(held[1]), value)).alias("value"))


def gbm(vols: DataFrame, start: float, seed: int) -> DataFrame:
    """Geometric Brownian motion over all sessions at the volatility of each minute: a cumulative sum of log steps. vols: date, timestamp, vol."""
    year, inside = 252 * MINUTES, Window.partitionBy("date").orderBy("timestamp")
    step = noise(seed, "timestamp") * F.col("vol") / year**0.5 - F.col("vol") * F.col("vol") / 2 / year
    rows = vols.withColumn("step", F.when(F.row_number().over(inside) > 1, step).otherwise(0.0))
    rows = rows.withColumn("sum", F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy("date").agg(F.sum("step").alias("day"))
    before = F.coalesce(F.sum("day").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return carried(rows, ends.select("date", before.alias("before"))).select("date", "timestamp", (F.lit(start) * F.exp(F.col("before") + F.col("sum"))).alias("value"))


def paths(spark: SparkSession, spec: Spec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Minutes (date, timestamp, value) of the index, its volatility, which drives it, and the volatility of that."""
    grid = dates.minute_grid(dates.business_days(spark, spec.start, spec.end))
    vix = mean_reverting(grid, spec.vix, VIX_MEAN, VIX_PULL, VIX_SHOCK, spec.seed + 1, VIX_RANGE)
    spot = gbm(vix.select("date", "timestamp", (F.col("value") / 100).alias("vol")), spec.spot, spec.seed)
    vvix = vix.select("date", "timestamp", (85 + 3 * (F.col("value") - VIX_MEAN) + 0.6 * noise(spec.seed + 2, "timestamp")).alias("value"))
    return spot, vix, vvix


def index_bars(path: DataFrame) -> DataFrame:
    bars = bars_from_path(path, "value", by=("date",))
    return bars.select("date", "timestamp", *[F.col(c).cast("float").alias(c) for c in ("open", "high", "low", "close")])


def strikes_around(at: DataFrame, price: str, steps: int, step: float) -> DataFrame:
    """at with strike and right: a row for each of `steps` strikes on either side of the price's nearest, and each right."""
    strikes = at.withColumn("_i", F.explode(F.sequence(F.lit(-steps), F.lit(steps)))).withColumn("strike", F.round(F.col(price) / step) * step + step * F.col("_i")).drop("_i")
    return strikes.withColumn("right", F.explode(F.array(F.lit("CALL"), F.lit("PUT"))))


def chain(spot: DataFrame, vix: DataFrame, spec: Spec, dte: int) -> DataFrame:
    """Option chain that expires `dte` business days on, with Greeks; the opening minute has no underlying and an overflowing volatility, and a
    minute of the first session an expiry of 1882."""
    expiry = F.col("date")
    for _ in range(dte):
        expiry = dates.next_business_day(expiry)
    minutes = spot.join(vix.select("timestamp", (F.col("value") / 100).alias("base")), "timestamp")
    centre = spot.groupBy("date").agg(F.min_by("value", "timestamp").alias("first")).select("date", (F.round(F.col("first") / spec.step) * spec.step).alias("centre"))
    rows = strikes_around(carried(minutes, centre), "centre", spec.steps, spec.step)
    minute = (F.hour("timestamp") * 60 + F.minute("timestamp")) - 570
    years = (F.datediff(expiry, F.col("date")) * 1440 + MINUTES - minute) / F.lit(YEAR_DAYS * 1440)
    rows = rows.withColumn("implied_vol", pricing.smile(F.col("value"), F.col("strike"), years, F.col("base")))
    priced = pricing.black_scholes(rows, F.col("value"), F.col("strike"), years, F.col("implied_vol"), F.col("right") == "CALL")
    opening = minute == 0
    bogus = (minute == MINUTES // 2) & (F.col("date") == F.lit(spec.start))
    price = F.greatest(F.col("price"), F.lit(0.05))
    half = F.greatest(F.lit(0.05), 0.03 * price) / 2
    bid = F.greatest(price - half + 0.01 * noise(spec.seed + 3 + dte, "timestamp", "strike", "right"), F.lit(0.0))
    held = {c: F.col(c) for c in ("delta", "theta", "vega", "rho", "lambda")}
    return priced.select(
        "date",
        F.lit("SPXW").alias("symbol"),
        F.when(bogus, "1882-01-01").otherwise(expiry.cast("string")).alias("expiration"),
        F.col("strike").cast("float"),
        "right",
        "timestamp",
        F.when(opening, 0.0).otherwise(bid).cast("float").alias("bid"),
        (price + half).cast("float").alias("ask"),
        *[F.coalesce(c, F.lit(0.0)).cast("float").alias(n) for n, c in held.items()],
        F.lit(0.0).cast("float").alias("epsilon"),
        F.when(opening, 21474.8).otherwise(F.col("implied_vol")).cast("float").alias("implied_vol"),
        F.when(opening, -0.99999).otherwise(0.0).cast("float").alias("iv_error"),
        dates.as_text(F.col("timestamp")).alias("underlying_timestamp"),
        F.when(opening, 0.0).otherwise(F.col("value")).cast("float").alias("underlying_price"),
    )


def demo_regime(daily: DataFrame) -> DataFrame:
    """A regime for demonstrations, over the whole series instead of rolling windows; its cut-offs and buckets differ from regime.build().

    daily: date, vix, vvix, a row a date, so windows over all rows are small.
    """
    df = daily.withColumn("vov_ratio", F.try_divide(F.col("vvix"), F.col("vix")))
    short = {"vix": "vix", "vvix": "vvix", "vov_ratio": "vov"}
    shares = {c: F.col(f"{c}_pct_252") for c in short}
    df = df.withColumns({f"{c}_pct_252": regime.rank_average(F.col(c)) for c in short} | {f"{n}_z_20": regime.z_all(F.col(c)) for c, n in short.items()})
    bands = lambda p: F.when(p < 0.25, "low").when(p < 0.75, "mid").when(p < 0.95, "high").otherwise("extreme")
    points = F.floor(shares["vix"] * 3) + F.floor(shares["vvix"] * 3)
    side = lambda c: F.concat(F.when(shares[c] >= 0.5, "hi").otherwise("lo"), F.lit(c.upper()))
    return df.withColumns(
        {f"{n}_regime": bands(shares[c]) for c, n in short.items()}
        | {"regime_score": points.cast("tinyint"), "regime_2x2": F.concat_ws("/", side("vix"), side("vvix")), "desk_bucket": F.when(points >= 4, "defensive").when(points >= 2, "neutral").otherwise("carry")}
    )


def write_feed(spark: SparkSession, raw: str, spec: Spec = Spec()) -> int:
    """Raw files of three indices and the chains, one a session, and the daily regime as CSV. Sessions written."""
    days = [r[0] for r in dates.business_days(spark, spec.start, spec.end).collect()]
    spot, vix, vvix = paths(spark, spec)
    frames = {"index/spx": index_bars(spot), "index/vix": stale(index_bars(vix)), "index/vvix": index_bars(vvix)}
    frames |= {f"options/greeks/{n}dte": chain(spot, vix, spec, n) for n in spec.dtes}
    for folder, df in frames.items():
        for day in days:
            df.where(F.col("date") == F.lit(day)).drop("date").coalesce(1).write.mode("overwrite").parquet(f"{raw}/{folder}/{day:%Y%m%d}.parquet")
    last = lambda path, name: daily_last(path, "value").withColumnRenamed("value", name)
    demo_regime(last(vix, "vix").join(last(vvix, "vvix"), "date")).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{raw}/vol_regime_daily.csv")
    return len(days)


def stale(bars: DataFrame) -> DataFrame:
    """Zero prints in every 97th minute."""
    zero = F.pmod(F.minute("timestamp") + 60 * F.hour("timestamp"), F.lit(97)) == 0
    return bars.withColumns({c: F.when(zero, F.lit(0.0).cast("float")).otherwise(F.col(c)) for c in ("open", "high", "low", "close")})
