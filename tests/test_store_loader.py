import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.functions import pricing
from tidemark.plans import quality, synthetic
from tidemark.plans.loader import Loader, PointInTimeLoader
from tidemark.sources import store as stores
from tidemark.sources.cache import ResultCache
from tidemark.sources.catalog import DEFAULT
from tidemark.streaming.bars import distinct_ticks, stream_bars

D2, D3, D4 = (dt.date(2024, 1, d) for d in (2, 3, 4))


@pytest.fixture(scope="module")
def top(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("lake"))
    assert synthetic.write_feed(spark, f"{top}/raw", synthetic.Spec(D2, D4)) == 3
    s = stores.Store(spark, f"{top}/raw", top, DEFAULT)
    for n in ("spx_ohlc", "vix_ohlc", "greeks_0dte"):
        got = s.ingest(n)
        assert got["ingested"] == 3 and got["errors"] == 0 and got["bytes_written"] > 0
    return top


@pytest.fixture(scope="module")
def loader(spark, top):
    return Loader(spark, top)


def test_ingest_again_skips(spark, top):
    s = stores.Store(spark, f"{top}/raw", top, DEFAULT)
    assert s.ingest("td_spx_ohlc")["skipped"] == 3
    assert s.ingest("spx_ohlc", [dt.date(2030, 1, 1)])["skipped"] == 1
    assert stores.Store(spark, f"{top}/none", top, DEFAULT).ingest("vol_regime")["errors"] == 1
    assert s.ingest("vol_regime")["ingested"] == s.ingest("vol_regime")["ingested"] == 1
    assert s.dates("spx_ohlc") == s.available("spx_ohlc") == [D2, D3, D4]


def test_load_cleans_and_prunes(spark, loader):
    raw, clean = loader.load("greeks_0dte", (D2, D3), clean=False), loader.load("greeks_0dte", (D2, D3))
    assert raw.count() == 2 * 390 * 22 and raw.where("year(to_date(expiration)) = 1882").count() == 22
    assert clean.where("underlying_price <= 0 or implied_vol > 100 or bid <= 0 or year(to_date(expiration)) < 2000").isEmpty()
    assert "mid" in clean.columns and dict(clean.dtypes)["bid"] == "double"
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    plan = loader.load("greeks_0dte", D2, filters=[("strike", ">=", 4705)], clean=False)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(strike,4705.0)" in plan
    assert loader.load("greeks_0dte", dt.date(2024, 6, 1)).count() == 0


def test_stale_prints_are_filled(loader):
    bars = loader.load("vix_ohlc", (D2, D4))
    assert bars.where("close = 0").isEmpty() and bars.count() == 3 * 389
    assert loader.load("vix_ohlc", (D2, D4), resample="1h").count() == 3 * 7


def test_projection_comes_last(loader):
    assert loader.load("spx_ohlc", D2, columns=["close"]).columns == ["close"]


def test_cutoff(loader):
    with pytest.raises(ValueError):
        PointInTimeLoader(loader, D3, regime_lag=0)
    pit = PointInTimeLoader(loader, D3, feature_lag_bars=1)
    assert pit.load("spx_ohlc", (D2, D4)).agg(F.max(F.to_date("timestamp"))).first()[0] == D3
    late = pit.load("spx_ohlc", (D4, D4))
    assert late.count() == 0 and "close" in late.columns
    both = pit.load_aligned((D2, D4), datasets=("spx_ohlc", "vix_ohlc"))
    assert both.columns == ["timestamp", *[f"{s}_{c}" for s in ("spx", "vix") for c in ("open", "high", "low", "close")]]
    assert both.agg(F.max(F.to_date("timestamp"))).first()[0] == D3
    assert "spx_close_lag1" in pit.with_feature_lag(both, ["spx_close"], by=[]).columns


def test_aligned_with_lagged_regime(spark, loader, top):
    d = DEFAULT.get("vol_regime")
    rows = [(x, *[0.5] * 9, "low", "mid", "high", 1, "low_rising", "normal") for x in (D2, D3, D4)]
    df = spark.createDataFrame([(r[0], *map(float, r[1:10]), *r[10:]) for r in rows], ", ".join(f"`{n}` {'date' if n == 'date' else 'string' if t == 'utf8' else 'int' if t == 'int8' else 'double'}" for n, t in d.columns.items()))
    df = df.withColumn("vix", F.dayofmonth("date").cast("double"))
    df.select(*[F.col(f.name).cast(f.dataType) for f in d.schema.fields]).write.mode("overwrite").parquet(f"{top}/{d.store_path}")
    got = loader.load_aligned((D3, D4), datasets=("spx_ohlc", "vol_regime"))
    assert {(r.d.day, r.vix) for r in got.select(F.to_date("timestamp").alias("d"), "vix").distinct().collect()} == {(3, 2.0), (4, 3.0)}


def test_cache(spark, top, tmp_path):
    cached = Loader(spark, top, cache=ResultCache(spark, str(tmp_path / "c"), max_mb=2000))
    first = cached.load("spx_ohlc", D2)
    assert sorted(first.collect()) == sorted(cached.load("spx_ohlc", D2).collect()) and len(cached.cache.entries()) == 1
    cached.load("spx_ohlc", D3)
    assert cached.invalidate_cache("vix_ohlc") == 0 and cached.invalidate_cache() == 2
    small = ResultCache(spark, str(tmp_path / "s"), max_mb=0.000001)
    small.put("a", "x", spark.range(10).toDF("i"))
    small.put("b", "x", spark.range(10).toDF("i"))
    assert list(small.entries()) == ["b"] and small.get("a") is None and small.get("b").count() == 10


def test_conform_and_bad_files(spark, tmp_path):
    d = DEFAULT.get("greeks_tick")
    df = spark.createDataFrame([(1704187800_000_000_000, "S", 1.0, "CALL", dt.date(2024, 1, 2)) + (1.0,) * 8], "timestamp long, symbol string, strike double, right string, expiration date, bid double, ask double, delta double, gamma double, vega double, theta double, implied_vol double, underlying_price double")
    got = stores.conform(df, d)
    assert got.columns == list(d.columns) and got.first().timestamp == dt.datetime(2024, 1, 2, 9, 30) and got.first().expiry == D2
    with pytest.raises(ValueError, match="missing"):
        stores.conform(df.drop("bid"), d)
    raw = tmp_path / "raw/index/spx"
    raw.mkdir(parents=True)
    (raw / "20240102.parquet").write_text("not parquet")
    store = stores.Store(spark, str(tmp_path / "raw"), str(tmp_path), DEFAULT)
    stats = store.ingest("spx_ohlc")
    assert stats["errors"] == 1 and stats["ingested"] == 0 and store.available("spx_ohlc") == []


def bars_file(spark, path, day, kind="float"):
    rows = [(dt.datetime(2024, 1, day, 9, 30 + m), 1.0, 2.0, 0.5, 1.5) for m in (2, 0, 1)]
    names = ("open", "high", "low", "close")
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, " + ", ".join(f"{n} double" for n in names))
    df.select("timestamp", *[F.col(n).cast(kind) for n in names]).coalesce(1).write.mode("overwrite").parquet(path)


def test_a_failed_write_is_tried_again_and_spares_others(spark, tmp_path):
    raw = f"{tmp_path}/raw/index/spx"
    store = stores.Store(spark, f"{tmp_path}/raw", str(tmp_path), DEFAULT)
    for day in (2, 4):
        bars_file(spark, f"{raw}/2024010{day}.parquet", day)
    spark.createDataFrame([(dt.datetime(2024, 1, 3), "no number", "x", "y", "z")], "timestamp timestamp_ntz, open string, high string, low string, close string").write.parquet(f"{raw}/20240103.parquet")
    first = store.ingest("spx_ohlc")
    assert (first["ingested"], first["errors"]) == (2, 1) and store.available("spx_ohlc") == [D2, D4]
    again = store.ingest("spx_ohlc")
    assert (again["ingested"], again["skipped"], again["errors"]) == (0, 2, 1)
    bars_file(spark, f"{raw}/20240103.parquet", 3)
    assert store.ingest("spx_ohlc")["ingested"] == 1 and store.available("spx_ohlc") == [D2, D3, D4]
    assert Loader(spark, str(tmp_path)).load("spx_ohlc", (D2, D4), clean=False).count() == 9
    # a stored session stays when its replacement fails
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(f"{raw}/20240102.parquet")
    assert store.ingest("spx_ohlc", [D2])["errors"] == 1 and store.available("spx_ohlc") == [D2, D3, D4]
    assert Loader(spark, str(tmp_path)).load("spx_ohlc", D2, clean=False).count() == 3


def test_sessions_without_rows_are_stored_empty(spark, tmp_path):
    for day in (2, 3):
        bars_file(spark, f"{tmp_path}/raw/index/spx/2024010{day}.parquet", day)
    spark.read.parquet(f"{tmp_path}/raw/index/spx/20240102.parquet").where("false").write.parquet(f"{tmp_path}/raw/index/spx/20240104.parquet")
    store = stores.Store(spark, f"{tmp_path}/raw", str(tmp_path), DEFAULT)
    assert store.ingest("spx_ohlc", delete_source=True)["ingested"] == 3 and store.dates("spx_ohlc") == []
    loader = Loader(spark, str(tmp_path))
    assert loader.load("spx_ohlc", D4, clean=False).count() == 0 and loader.load("spx_ohlc", D3, clean=False, sort=False).count() == 3
    rows = [r.timestamp for r in spark.read.parquet(store.stored_files("spx_ohlc")[0]).collect()]
    assert rows == sorted(rows)


def test_splitting_months_in_turn_feeds_the_loader(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path), str(tmp_path), DEFAULT)

    def month(m, n):
        rows = [(dt.datetime(2024, m, d, 9, 31 + i), 1.0, 1.0, 1.0, 1.0) for d in (2, 3) for i in range(n)]
        return spark.createDataFrame(rows, "timestamp timestamp_ntz, open double, high double, low double, close double")

    assert store.split("spx_ohlc", month(1, 2), dry_run=True) == {"2024-01-02": 2, "2024-01-03": 2} and store.available("spx_ohlc") == []
    assert store.split("spx_ohlc", month(1, 2)) == {"2024-01-02": 2, "2024-01-03": 2}
    assert store.split("spx_ohlc", month(2, 3)) == {"2024-02-02": 3, "2024-02-03": 3}
    assert store.split("spx_ohlc", month(1, 2)) == {} and store.split("spx_ohlc", month(1, 5)) == {"2024-01-02": 5, "2024-01-03": 5}
    assert store.available("spx_ohlc") == [D2, D3, dt.date(2024, 2, 2), dt.date(2024, 2, 3)]
    loader = Loader(spark, str(tmp_path))
    assert loader.load("spx_ohlc", (D2, dt.date(2024, 2, 28)), clean=False).count() == 16


def test_store_and_migration_checks(spark, tmp_path):
    for day in (2, 3):
        bars_file(spark, f"{tmp_path}/raw/index/spx/2024010{day}.parquet", day)
    store = stores.Store(spark, f"{tmp_path}/raw", str(tmp_path), DEFAULT)
    store.ingest("spx_ohlc", [D2])
    files = lambda: store.stored_files("spx_ohlc")
    need = {"timestamp", "close"}
    assert quality.check_store(spark, "spx", files(), need).first().status == "PASS"
    assert quality.check_store(spark, "spx", files(), need, least=5).first().status == "FAIL"
    assert "volume" in quality.check_store(spark, "spx", files(), {"volume"}).first().detail
    assert quality.check_store(spark, "spx", [], need).first().status == "FAIL"
    assert quality.check_migration(spark, "spx", store.dates("spx_ohlc"), store.available("spx_ohlc"), files()).first().status == "FAIL"
    store.ingest("spx_ohlc")
    got = quality.check_migration(spark, "spx", store.dates("spx_ohlc"), store.available("spx_ohlc"), files()).first()
    assert got.status == "PASS" and got.detail == "sessions=2, missing=0, readable=true, rows=6"
    assert quality.most_recent(files()).endswith("20240103.parquet")
    bad = tmp_path / "store/spx_ohlc/year=2024/month=01/20240104.parquet"
    bad.write_text("no")
    assert "unreadable" in quality.check_store(spark, "spx", files(), need).first().detail
    bad.unlink()
    got = {r.dataset: r for r in quality.statistics(spark, {"spx": f"{tmp_path}/store/spx_ohlc"}).collect()}
    assert got["TOTAL"].files == got["spx"].files == 2 and got["spx"].rows == 6 and got["spx"].bytes > 0


def test_sessions_and_union(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23, 59), 1), (dt.datetime(2024, 1, 3), 2), (None, 3)], "created timestamp_ntz, x int")
    assert stores.write_sessions(df, str(tmp_path / "a"), dry_run=True) == {"2024-01-02": 1, "2024-01-03": 1}
    stores.write_sessions(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    assert stores.union_days([df, df.drop("x")]).where("x is null").count() == 3


def test_checks(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6), "A", "1882-01-01", -1.0, "CALL", 2.0, 1.0, 7.0, -1)] * 2, "timestamp timestamp_ntz, symbol string, expiration string, strike double, right string, bid double, ask double, implied_vol double, open_interest int")
    checks = [quality.prices(df, ["bid", "ask"]), quality.strikes(df), quality.greeks(df), quality.known_issues(df, ["B"]), quality.open_interest(df), quality.dte(df, 0), quality.spreads(df), quality.expirations(df), quality.timestamps(df, F.current_timestamp().cast("timestamp_ntz"))]
    rows = quality.report([quality.run(df, checks), quality.check_duplicates(df)])
    got = {r.check: r.status for r in rows.collect()}
    assert got == {"prices": "FAIL", "strikes": "FAIL", "greeks": "WARN", "duplicates": "FAIL", "known_issues": "FAIL", "open_interest": "FAIL", "dte": "WARN", "spreads": "PASS", "expirations": "FAIL", "timestamps": "WARN"}
    assert quality.summary(rows).first().verdict == "ISSUES FOUND"
    none = df.where("false")
    assert {r.status for r in quality.report([quality.run(none, [quality.prices(none, ["bid"])]), quality.check_duplicates(none)]).collect()} == {"PASS"}
    assert [r.status for r in quality.run(none, [quality.spreads(none)]).collect()] == ["WARN"]
    assert quality.spread_quantiles(none).collect() == [(0, 0, None, None, None)]


def test_spread_quantiles_are_exact(spark):
    import numpy as np

    r = np.random.default_rng(1)
    rows = [(float(b), float(b + a)) for b, a in zip(r.integers(0, 40, 3000) / 8, r.integers(-8, 300, 3000) / 16)]
    df = spark.createDataFrame(rows, "bid double, ask double")
    s = np.array([(a - b) / ((a + b) / 2) * 100 for b, a in rows if a > 0 and b > 0])
    got = quality.spread_quantiles(df).first()
    assert got.n == len(s) and got.wide == (s > 100).sum()
    assert np.allclose([got.median, got.p95, got.p99], np.quantile(s, [0.5, 0.95, 0.99]))


def test_journal_schedule_and_empty_files(spark, tmp_path):
    from tidemark.plans import fetching

    monthly = fetching.schedule(spark, "eod", dt.date(2024, 1, 15), dt.date(2024, 3, 10))
    assert [tuple(r) for r in monthly.orderBy("key").collect()] == [
        ("eod/2024_01", dt.date(2024, 1, 15), dt.date(2024, 1, 31), None), ("eod/2024_02", dt.date(2024, 2, 1), dt.date(2024, 2, 29), None), ("eod/2024_03", dt.date(2024, 3, 1), dt.date(2024, 3, 10), None)
    ]
    journal = fetching.Journal(spark, f"{tmp_path}/journal")
    assert journal.completed() == set() and journal.left(monthly).count() == 3
    journal.mark("eod/2024_02", 12, 0.5)
    journal.mark("eod/2024_02", 12, 0.5)
    assert journal.completed() == {"eod/2024_02"} and [r.key for r in journal.left(monthly).orderBy("key").collect()] == ["eod/2024_01", "eod/2024_03"]
    schema = DEFAULT.get("oi").schema
    fetching.save(spark.createDataFrame([], "symbol string"), f"{tmp_path}/empty.parquet", schema)
    got = spark.read.parquet(f"{tmp_path}/empty.parquet")
    assert got.count() == 0 and got.columns == schema.names


def test_feed_is_driven_by_its_volatility(spark):
    spec = synthetic.Spec(D2, D4)
    spot, vix, _ = synthetic.paths(spark, spec)
    got = vix.orderBy("timestamp").collect()
    assert all(9 <= r.value <= 60 for r in got) and got[0].value == 14.0 and got[390].value == pytest.approx(got[389].value, abs=1e-9)
    first = spot.orderBy("timestamp").first()
    assert first.value == 4750.0
    for n, expiry in ((0, "2024-01-04"), (1, "2024-01-05")):
        rows = synthetic.chain(spot, vix, spec, n).where(F.col("date") == F.lit(D4))
        assert {r[0] for r in rows.select("expiration").distinct().collect()} == {expiry}
        assert rows.where("ask < bid or bid < 0").isEmpty() and rows.where("underlying_price = 0").count() == 22


def test_file_check(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "ok"))
    (tmp_path / "ok/bad.parquet").write_text("no")
    assert quality.check_files(spark, str(tmp_path)).first().status == "WARN"
    assert quality.check_sessions(spark, [D2, D3], [D2]).first().status == "FAIL"


def test_black_scholes(spark):
    df = spark.createDataFrame([(100.0, 100.0, 0.5, 0.2, c) for c in (True, False)], "s double, k double, t double, v double, c boolean")
    got = pricing.black_scholes(df, *[F.col(x) for x in "sktvc"]).collect()
    call, put = got
    assert abs(call.price - 6.8887) < 1e-3 and abs(call.delta - 0.5977) < 1e-3
    assert abs(call.price - put.price - (100 - 100 * 2.718281828459045 ** (-0.025))) < 1e-6


def test_streaming(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 2, 9, m), k, float(m)) for m in range(12) for k in "ab"] * 2
    spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("timestamp timestamp_ntz, k string, v double").parquet(str(tmp_path / "in"))
    for name, df, mode in (("ticks", distinct_ticks(stream(), ["k"]), "append"), ("bars", stream_bars(stream(), "5 minutes", "v", ["k"]), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(120)
    assert spark.table("ticks").count() == 24
    assert spark.table("bars").where("k = 'a'").count() == 3


def test_cli(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        assert cli.main(["datasets"]) == 0
    assert "greeks_0dte" in out.getvalue()
    with pytest.raises(SystemExit):
        cli.main([])
