"""Data checks. Each gives rows (check, status, detail); together they are a report.

Checks of single columns are a Check: named aggregates, and the verdict and detail that follow from them. Any
number of them over the same rows is one aggregation over one scan, turned into a row a check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import next_business_day
from tidemark.sources.scan import expiry_column, expiry_day

REPORT = "check string, status string, detail string"


@dataclass(frozen=True)
class Check:
    """name, aggregates by name, and fail, warn: from the aggregates' columns by name to a condition. shown: aggregates that the detail holds."""

    name: str
    aggregates: dict[str, Column]
    fail: Callable
    warn: Callable
    shown: tuple[str, ...]


def run(df: DataFrame, checks: list[Check]) -> DataFrame:
    """A row a check, from one pass over df."""
    wide = df.agg(*[c.alias(f"{i}_{n}") for i, check in enumerate(checks) for n, c in check.aggregates.items()])
    rows = []
    for i, check in enumerate(checks):
        of = lambda n, i=i: F.col(f"{i}_{n}")
        status = F.when(check.fail(of), "FAIL").when(check.warn(of), "WARN").otherwise("PASS")
        detail = F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.coalesce(of(n).cast("string"), F.lit("-"))) for n in check.shown])
        rows.append(F.struct(F.lit(check.name).alias("check"), status.alias("status"), detail.alias("detail")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def never(_) -> Column:
    return F.lit(False)


def count_if(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def share(n: Column, of: Column) -> Column:
    return F.coalesce(F.try_divide(n, of), F.lit(0.0))


def verdict(check: str, fail: Column, warn: Column, detail: Column, of: DataFrame) -> DataFrame:
    status = F.when(fail, "FAIL").when(warn, "WARN").otherwise("PASS")
    return of.select(F.lit(check).alias("check"), status.alias("status"), detail.alias("detail"))


def counts_text(*names: str) -> Column:
    return F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("-"))) for n in names])


def check_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    have, want = set(df.columns), set(declared.names)
    missing, extra = sorted(want - have), sorted(have - want)
    status = "FAIL" if missing else "WARN" if extra else "PASS"
    return df.sparkSession.createDataFrame([("schema", status, f"missing={','.join(missing)}, extra={','.join(extra)}")], REPORT)


def check_months(df: DataFrame, months: DataFrame, index: str = "timestamp") -> DataFrame:
    """months: month (YYYY_MM) expected."""
    have = df.select(F.date_format(index, "yyyy_MM").alias("month")).distinct()
    missing = months.join(have, "month", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    n = have.agg(F.count("month").alias("n"))
    both = missing.withColumn("_", F.lit(0)).join(n.withColumn("_", F.lit(0)), "_")
    return verdict("months", F.col("n") == 0, F.col("missing") > 0, counts_text("n", "missing"), both)


def expirations(df: DataFrame) -> Check:
    """Different expiries on weekends; those of 2040 and later are known to be wrong."""
    name = expiry_column(df)
    day = expiry_day(F.col(name), df.schema[name].dataType)
    odd = F.collect_set(F.when((F.weekday(day) >= 5) & (F.year(day) < 2040), day))  # no more of them than days
    return Check("expirations", {"weekend": F.size(odd)}, lambda of: of("weekend") > 0, never, ("weekend",))


def timestamps(df: DataFrame, now: Column, price: str | None = None, index: str = "timestamp") -> Check:
    t = F.col(index)
    zero = (F.col(price) == 0) if price else F.lit(False)
    aggregates = {
        "nulls": count_if(t.isNull()),
        "future": count_if(t > now),
        "weekend": count_if(F.weekday(t) >= 5),
        "zero_open": count_if((F.hour(t) == 9) & (F.minute(t) == 30) & zero),
    }
    return Check("timestamps", aggregates, lambda of: of("future") > 0, lambda of: of("nulls") + of("weekend") + of("zero_open") > 0, tuple(aggregates))


def both_sides() -> Column:
    return (F.col("bid") > 0) & (F.col("ask") > 0)


def prices(df: DataFrame, columns: list[str]) -> Check:
    """Negative prices, bid above ask in more than 1 % of the rows that have both, high below low."""
    names = [p for p in columns if p in df.columns]
    negative = reduce(lambda a, b: a | b, [F.col(p) < 0 for p in names], F.lit(False))
    quoted = both_sides() if {"bid", "ask"} <= set(df.columns) else F.lit(False)
    crossed = quoted & (F.col("bid") > F.col("ask")) if {"bid", "ask"} <= set(df.columns) else F.lit(False)
    bars = {"open", "high", "low", "close"} <= set(df.columns)
    upside = (F.col("high") < F.col("low")) & (F.least("open", "high", "low", "close") > 0) if bars else F.lit(False)
    aggregates = {"quoted": count_if(quoted), "negative": count_if(negative), "crossed": count_if(crossed), "inverted": count_if(upside)}
    fail = lambda of: (of("negative") > 0) | (share(of("crossed"), of("quoted")) > 0.01) | (of("inverted") > 0)
    return Check("prices", aggregates, fail, lambda of: of("crossed") > 0, ("negative", "crossed", "inverted"))


def strikes(df: DataFrame, low: float = 50, high: float = 15_000, underlying: str | None = None, far: float = 0.5) -> Check:
    """underlying: also warn of strikes further than `far` of that price away."""
    off = F.abs(F.col("strike") / F.nullif(F.col(underlying).cast("double"), F.lit(0.0)) - 1) > far if underlying else F.lit(False)
    aggregates = {"not_positive": count_if(F.col("strike") <= 0), "odd": count_if((F.col("strike") < low) | (F.col("strike") > high)), "far": count_if(off)}
    return Check("strikes", aggregates, lambda of: of("not_positive") > 0, lambda of: of("odd") + of("far") > 0, tuple(aggregates))


def greeks(df: DataFrame, delta: str = "delta", iv: str = "implied_vol", vega: str = "vega") -> Check:
    has = lambda c, x: x(F.col(c)) if c in df.columns else F.lit(False)
    aggregates = {
        "n": F.count(F.lit(1)),
        "delta_out": count_if(has(delta, lambda c: F.abs(c) > 1.01)),
        "iv_negative": count_if(has(iv, lambda c: c < 0)),
        "iv_high": count_if(has(iv, lambda c: c > 5)),
        "vega_negative": count_if(has(vega, lambda c: c < -0.001)),
    }
    warn = lambda of: (of("delta_out") > 0) | (of("iv_negative") > 0) | (share(of("iv_high"), of("n")) > 0.2) | (share(of("vega_negative"), of("n")) > 0.01)
    return Check("greeks", aggregates, never, warn, tuple(aggregates)[1:])


#: Spreads of rows with both prices above zero lie within 200 % either way; a bucket of them is a hundredth of 1 %.
BUCKETS_A_POINT = 100


def spread_quantiles(df: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """n, wide (spread above 100 %), and the exact, interpolated median, 95th and 99th percentile of the spread in per cent, of rows with bid and ask above 0.

    A histogram of at most 400 * BUCKETS_A_POINT buckets tells where the quantiles lie; only the values of those buckets
    are counted one by one, so that no task holds all the values.
    """
    spread = F.try_divide(F.col("ask") - F.col("bid"), (F.col("bid") + F.col("ask")) / 2) * 100
    rows = df.where(both_sides()).select(spread.cast("double").alias("s")).withColumn("b", F.floor(F.col("s") * BUCKETS_A_POINT))
    place = lambda q: F.lit(q) * (F.col("n") - 1)
    ranks = F.array_distinct(F.array(*[f(place(q)).cast("long") for q in quantiles for f in (F.floor, F.ceil)]))
    every, upto = Window.partitionBy(), Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)  # over the buckets
    buckets = rows.groupBy("b").agg(F.count(F.lit(1)).alias("c"), count_if(F.col("s") > 100).alias("w"))
    buckets = buckets.select("b", "c", (F.sum("c").over(upto) - F.col("c")).alias("before"), F.sum("c").over(every).alias("n"), F.sum("w").over(every).alias("wide"))
    buckets = buckets.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("c")))).where(F.size("ranks") > 0)
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    values = rows.join(F.broadcast(buckets.drop("c")), "b").groupBy("b", "before", "n", "wide", "ranks", "s").agg(F.count(F.lit(1)).alias("k"))
    values = values.withColumn("low", F.col("before") + F.sum("k").over(inside) - F.col("k"))
    at = values.select("n", "wide", "s", F.explode(F.filter("ranks", lambda r: (r >= F.col("low")) & (r < F.col("low") + F.col("k")))).alias("rank"))
    whole = at.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.max("wide"), F.lit(0)).alias("wide"), F.map_from_entries(F.collect_list(F.struct("rank", "s"))).alias("at"))

    def value(q: float) -> Column:
        low, high = (F.try_element_at("at", f(place(q)).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (place(q) - F.floor(place(q)))

    return whole.select("n", "wide", *[value(q).alias(name) for q, name in zip(quantiles, ("median", "p95", "p99"))])


def spreads(df: DataFrame) -> Check:
    """Spreads above 100 % in more than 5 % of the rows that have both prices, or no such row."""
    wide = (F.col("ask") - F.col("bid")) > (F.col("bid") + F.col("ask")) / 2
    aggregates = {"n": count_if(both_sides()), "wide": count_if(both_sides() & wide)}
    return Check("spreads", aggregates, never, lambda of: (of("n") == 0) | (share(of("wide"), of("n")) > 0.05), tuple(aggregates))


def duplicates(df: DataFrame) -> DataFrame:
    """total, and how many rows repeat an earlier one."""
    each = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return each.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"))


def check_duplicates(df: DataFrame) -> DataFrame:
    return verdict("duplicates", share(F.col("repeated"), F.col("total")) > 0.01, F.col("repeated") > 0, counts_text("total", "repeated"), duplicates(df))


def dte(df: DataFrame, days: int, index: str = "timestamp") -> Check:
    """0: expiry is the day itself, 1: the next business day; more days aren't checked."""
    name = expiry_column(df)
    day, end = F.to_date(index), expiry_day(F.col(name), df.schema[name].dataType)
    off = end != day if days == 0 else end != next_business_day(day) if days == 1 else F.lit(False)
    aggregates = {"n": F.count(F.lit(1)), "off": count_if(off)}
    return Check("dte", aggregates, never, lambda of: of("off") > 0 if days == 0 else share(of("off"), of("n")) > 0.05, tuple(aggregates))


def cross_prices(a: DataFrame, b: DataFrame, a_price: str, b_price: str, index: str = "timestamp", order: tuple[str, ...] = ()) -> DataFrame:
    """Points that two sources share (first positive price each), and the largest and mean difference."""
    first = lambda df, p, n: df.where(F.col(p) > 0).groupBy(index).agg(F.min_by(p, F.struct(*order, p) if order else F.col(p)).alias(n))
    d = F.abs(F.col("pa") - F.col("pb"))
    return first(a, a_price, "pa").join(first(b, b_price, "pb"), index).agg(F.count(F.lit(1)).alias("points"), F.max(d).alias("largest"), F.avg(d).alias("mean"))


def check_cross_prices(*args, **kwargs) -> DataFrame:
    return verdict("cross_prices", F.lit(False), (F.col("points") < 10) | (F.col("largest") > 5), counts_text("points"), cross_prices(*args, **kwargs))


def known_issues(df: DataFrame, symbols: list[str], side: str = "right") -> Check:
    name = expiry_column(df)
    text = F.col(name).cast("string")
    year = F.year(expiry_day(F.col(name), df.schema[name].dataType))
    aggregates = {
        "bogus_expiry": count_if(text.startswith("1882") | (year > 2040)),
        "odd_symbols": count_if(~F.col("symbol").isin(symbols)),
        "calls": count_if(F.upper(F.substring(side, 1, 1)) == "C"),
        "puts": count_if(F.upper(F.substring(side, 1, 1)) == "P"),
    }
    one_sided = lambda of: share(F.least(of("calls"), of("puts")), F.greatest(of("calls"), of("puts"))) < 0.3
    return Check("known_issues", aggregates, lambda of: of("bogus_expiry") > 0, lambda of: (of("odd_symbols") > 0) | one_sided(of), tuple(aggregates))


def open_interest(df: DataFrame, name: str = "open_interest") -> Check:
    aggregates = {"negative": count_if(F.col(name) < 0), "nulls": count_if(F.col(name).isNull()), "largest": F.max(name)}
    return Check("open_interest", aggregates, lambda of: of("negative") > 0, lambda of: of("nulls") > 0, tuple(aggregates))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """file, rows of every readable Parquet file."""
    df = spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).schema("_ int").parquet(path)
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def check_files(spark: SparkSession, path: str) -> DataFrame:
    """Every listed file against what can be read of it: a corrupt file fails, an empty or small one warns."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("file"), F.col("length"))
    both = listed.join(file_sizes(spark, path), "file", "left")
    got = both.agg(F.count(F.lit(1)).alias("files"), count_if(F.col("rows").isNull()).alias("empty_or_corrupt"), count_if(F.col("rows") < 10).alias("small"))
    return verdict("files", F.col("files") == 0, (F.col("empty_or_corrupt") + F.col("small")) > 0, counts_text("files", "empty_or_corrupt", "small"), got)


def statistics(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """dataset, files, rows and bytes of each dataset's folder, the smallest, largest and mean file in rows, and of all as "TOTAL"; files that can't be read count no rows."""
    each = []
    for name, path in paths.items():
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
        each.append(listed.join(file_sizes(spark, path), "file", "left").select(F.lit(name).alias("dataset"), "bytes", F.coalesce("rows", F.lit(0)).alias("rows")))
    rows = reduce(lambda a, b: a.unionByName(b), each)
    twice = rows.select(F.explode(F.array("dataset", F.lit("TOTAL"))).alias("dataset"), "rows", "bytes")
    each = [F.min("rows").alias("least"), F.max("rows").alias("most"), F.avg("rows").alias("mean")]
    return twice.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), *each)


def most_recent(files: list[str]) -> str | None:
    """The last file by name, that is of the latest session."""
    return max(files, default=None)


def check_store(spark: SparkSession, name: str, files: list[str], required: set[str], least: int = 0) -> DataFrame:
    """A dataset of the store: files there, none unreadable or empty, and the most recent one with all required columns. files: the paths of its sessions."""
    problems = []
    if len(files) < max(1, least):
        problems.append(f"{len(files)} files, at least {max(1, least)} expected")
    rows = {}
    if files:
        read = spark.read.option("ignoreCorruptFiles", True).schema("_ int").parquet(*files)
        rows = {r["file"]: r["n"] for r in read.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a file
        held = [f for f in files if any(f.rpartition("/")[2] in x for x in rows)]
        if len(held) < len(files):
            problems.append(f"{len(files) - len(held)} empty or unreadable files")
        latest = most_recent(files)
        try:
            if missing := sorted(required - set(spark.read.parquet(latest).columns)):
                problems.append(f"missing columns {missing} in {latest.rpartition('/')[2]}")
        except Exception as e:  # noqa: BLE001
            problems.append(f"{latest.rpartition('/')[2]} can't be read: {type(e).__name__}")
    detail = "; ".join(problems) or f"files={len(files)}, rows={sum(rows.values())}"
    return spark.createDataFrame([(f"store {name}", "FAIL" if problems else "PASS", detail)], REPORT)


def check_migration(spark: SparkSession, name: str, source: list, stored: list, files: list[str]) -> DataFrame:
    """Every session of the source is stored, and the stored files can be read through; their rows are counted."""
    missing = len(set(source) - set(stored))
    try:
        n, fine = (spark.read.parquet(*files).count() if files else 0), True
    except Exception:  # noqa: BLE001
        n, fine = 0, False
    status = "FAIL" if missing or not fine else "WARN" if not source else "PASS"
    return spark.createDataFrame([(f"migration {name}", status, f"sessions={len(source)}, missing={missing}, readable={str(fine).lower()}, rows={n}")], REPORT)


def coverage(df: DataFrame, calendar: DataFrame, index: str = "timestamp") -> DataFrame:
    """expected, present: business days of the calendar (date) and those with rows."""
    have = df.select(F.to_date(index).alias("date"), F.lit(1).alias("here")).distinct()
    return calendar.join(have, "date", "left").agg(F.count(F.lit(1)).alias("expected"), F.count("here").alias("present"))


def check_coverage(df: DataFrame, calendar: DataFrame, index: str = "timestamp") -> DataFrame:
    return verdict("coverage", F.lit(False), share(F.col("present"), F.col("expected")) < 0.7, counts_text("expected", "present"), coverage(df, calendar, index))


def check_sessions(spark: SparkSession, source: list, stored: list, least: int = 0) -> DataFrame:
    """Sessions of the source that the store lacks (FAIL), and fewer stored than `least` (WARN)."""
    missing = sorted(set(source) - set(stored))
    status = "FAIL" if missing else "WARN" if len(stored) < least else "PASS"
    return spark.createDataFrame([("sessions", status, f"stored={len(stored)}, missing={len(missing)}")], REPORT)


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def summary(rows: DataFrame) -> DataFrame:
    """Counts by status and the verdict over all checks."""
    n = rows.agg(*[count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL")])
    return n.withColumn("verdict", F.when(F.col("fail") > 0, "ISSUES FOUND").when(F.col("warn") > 0, "WARNINGS ONLY").otherwise("CLEAN"))
