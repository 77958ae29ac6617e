"""Daily volatility regime: rolling ranks and z-scores of two closes and their ratio, labels, score, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_ROWS, SCORE_ROWS = 252, 20


def rolling_rank(value: Column, rows: int = RANK_ROWS, order: str = "date", by: tuple[str, ...] = ()) -> Column:
    """Share of the last `rows` values (this one included, nulls left out) that are at most this one.

    Null before row `rows`, for a null value, and with fewer than rows // 2 values.
    """
    w = Window.partitionBy(*by).orderBy(order)
    held = F.collect_list(value).over(w.rowsBetween(-(rows - 1), 0))
    share = F.size(F.filter(held, lambda x: x <= value)) / F.size(held)
    ready = (F.row_number().over(w) >= rows) & value.isNotNull() & (F.size(held) >= rows // 2)
    return F.when(ready, share).cast("float")


def rolling_z(value: Column, rows: int = SCORE_ROWS, order: str = "date", by: tuple[str, ...] = ()) -> Column:
    """(value - mean) / sample deviation over the last `rows` rows; null until there are that many and where they don't vary."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)
    z = F.try_divide(value - F.avg(value).over(w), F.nullif(F.stddev_samp(value).over(w), F.lit(0.0)))
    return F.when(F.count(value).over(w) == rows, z)


def label(share: Column) -> Column:
    return F.when(share < 0.25, "low").when(share < 0.5, "mid").when(share < 0.75, "high").otherwise("extreme")


def score(labels: list[Column]) -> Column:
    return sum((x.isin("high", "extreme").cast("int") for x in labels), F.lit(0)).cast("tinyint")


def two_by_two(share: Column, z: Column) -> Column:
    side = lambda high: F.when(z >= 0, f"{high}_rising").when(z < 0, f"{high}_falling")
    return F.coalesce(F.when(share >= 0.5, side("high")).when(share < 0.5, side("low")), F.lit("low_falling"))


def bucket(points: Column) -> Column:
    return F.when(points >= 3, "crisis").when(points >= 2, "elevated").when(points >= 1, "normal").otherwise("calm")


def build(daily: DataFrame, x: str = "vix", y: str = "vvix", ratio: str = "vov") -> DataFrame:
    """date, x, y -> the regime of every date that has a rank of x. One row a date, so windows over all dates are small."""
    df = daily.withColumn(f"{ratio}_ratio", F.try_divide(F.col(y), F.col(x)).cast("float"))
    signals = {x: x, y: y, f"{ratio}_ratio": ratio}
    ranks = {f"{s}_pct_{RANK_ROWS}": rolling_rank(F.col(s).cast("double")) for s in signals}
    zs = {f"{short}_z_{SCORE_ROWS}": rolling_z(F.col(s).cast("double")) for s, short in signals.items()}
    df = df.withColumns(ranks | zs)
    df = df.withColumns({f"{short}_regime": label(F.col(f"{s}_pct_{RANK_ROWS}")) for s, short in signals.items()})
    df = df.withColumn("regime_score", score([F.col(f"{s}_regime") for s in signals.values()]))
    df = df.withColumn("regime_2x2", two_by_two(F.col(f"{x}_pct_{RANK_ROWS}"), F.col(f"{x}_z_{SCORE_ROWS}")))
    df = df.withColumn("desk_bucket", bucket(F.col("regime_score")))
    floats = [x, y, *[f"{short}_z_{SCORE_ROWS}" for short in signals.values()]]
    return df.withColumns({c: F.col(c).cast("float") for c in floats}).where(F.col(f"{x}_pct_{RANK_ROWS}").isNotNull())


def rank_average(value: Column) -> Column:
    """Average rank over all rows, divided by their number. For daily series only: all rows (one a date) meet in one task."""
    w = Window.orderBy(value)
    peers = F.count(F.lit(1)).over(Window.partitionBy(value))
    return (F.rank().over(w) + (peers - 1) / 2) / F.count(F.lit(1)).over(Window.partitionBy())


def z_all(value: Column) -> Column:
    """z-score over all rows by the sample deviation; 0 where they don't vary. For daily series only: all rows (one a date) meet in one task."""
    w = Window.partitionBy()
    return F.coalesce(F.try_divide(value - F.avg(value).over(w), F.nullif(F.stddev_samp(value).over(w), F.lit(0.0))), F.lit(0.0))
