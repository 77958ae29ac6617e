import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, lag
from tidemark.operators.align import attach_daily, outer, prefixed
from tidemark.operators.rules import HANDLERS, apply_rules, forward_fill, rule, rules_of
from tidemark.plans import regime
from tidemark.sources import scan
from tidemark.sources.catalog import DEFAULT, Catalog, Dataset, parse_rules

T0 = dt.datetime(2024, 1, 2, 9, 30)


def minute(n):
    return T0 + dt.timedelta(minutes=n)


def chain(spark, rows, columns="timestamp timestamp_ntz, bid double, ask double"):
    return spark.createDataFrame(rows, columns)


def test_opening_bar_and_illiquid(spark):
    df = chain(spark, [(minute(i), 0.0 if i == 0 else 1.0, 1.5) for i in range(5)] + [(None, 1.0, 1.5)])
    kept = apply_rules(df, rules_of({"drop_opening_bar": {"time": "09:30:00"}})).collect()
    assert sorted(r.timestamp.minute for r in kept) == [31, 32, 33, 34]
    assert apply_rules(df, rules_of({"filter_zero_bid": {"bid_gt": 0.0}})).where("timestamp is not null").count() == 4
    assert apply_rules(df, rules_of("filter_zero_bid")).count() == 6
    with pytest.raises(KeyError):
        apply_rules(df, rules_of({"filter_illiquid": {"implied_vol_lte": 1}}))
    iv = spark.createDataFrame([(1.0, 0.2), (1.0, 250.0)], "bid double, iv double")
    assert [r.iv for r in apply_rules(iv, rules_of({"filter_illiquid": {"implied_vol_lte": 100.0}})).collect()] == [0.2]


def test_mid_spread_and_outliers(spark):
    df = chain(spark, [(minute(1), 0.0, 1.0), (minute(2), 1.0, 1.02), (minute(3), 1.0, 1.5), (minute(4), 0.0, 0.0)])
    got = apply_rules(df, rules_of("add_mid", "add_spread_pct")).orderBy("timestamp").collect()
    assert [round(r.mid, 3) for r in got] == [0.5, 1.01, 1.25, 0.0]
    assert got[3].spread_pct is None and round(got[2].spread_pct, 3) == 40.0
    assert [r.ask for r in apply_rules(df, rules_of({"filter_outlier_spread": {"max_spread_pct": 5.0}})).collect()] == [1.02]


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz"])
def test_bogus_expirations(spark, kind):
    df = spark.createDataFrame([("2024-01-02",), ("1882-01-01",), ("2089-06-30",)] + ([("20240102",), ("x",)] if kind == "string" else []), "expiration string").select(F.col("expiration").cast(kind))
    assert apply_rules(df, rules_of("filter_bogus_expirations")).count() == 1
    assert apply_rules(df.withColumnRenamed("expiration", "expiry"), rules_of("filter_bogus_expirations")).count() == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(minute(1), 1.0, 0), (minute(1), 1.5, 1), (minute(2), 2.0, 2)], "timestamp timestamp_ntz, bid double, n int")
    pick = lambda k: sorted(r.bid for r in apply_rules(df, rules_of({"filter_duplicate_timestamps": {"keep": k}}), ("n",)).collect())
    assert pick("last") == [1.5, 2.0] and pick("first") == [1.0, 2.0] and pick("none") == [2.0] and len(pick("any")) == 2
    with pytest.raises(ValueError):
        pick("odd")


def test_thresholds_and_unknown_rules(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "open_interest int, price double")
    assert apply_rules(df, rules_of({"filter_zero_oi": {"open_interest_gt": 0}})).count() == 3
    assert apply_rules(df, rules_of({"filter_zero_price": {"price_gt": 1.0}}, "no_such_rule")).count() == 2
    assert apply_rules(df, rules_of("filter_zero_price", "filter_zero_oi")).count() == 4


def fill(rows, keys):
    last, out = {}, {}
    for k, t, n, v in sorted(rows, key=lambda r: (r[1], r[2])):
        last[k] = v if v else last.get(k)
        out[n] = last[k]
    return out


def test_forward_fill_over_days_whatever_the_order(spark):
    r = random.Random(3)
    rows = [(r.choice("ab") if i % 9 else None, minute(r.randrange(5000)), i, r.choice([0.0, 0.0, None, float(i)])) for i in range(400)]
    for _ in range(2):
        r.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, n int, close double")
        got = {x.n: x.close for x in forward_fill(df, ["close"], ["k"], "timestamp", ("n",)).collect()}
        assert got == fill(rows, ["k"])
    one = spark.createDataFrame([(minute(i), v) for i, v in enumerate([0.0, 13.0, 13.5, 0.0])], "timestamp timestamp_ntz, close double")
    rule_of = lambda **p: [x.close for x in apply_rules(one, rules_of({"ffill_zero_close": p or True})).orderBy("timestamp").collect()]
    assert rule_of() == [None, 13.0, 13.5, 13.5] and rule_of(enabled=False) == [0.0, 13.0, 13.5, 0.0]


def test_the_future_never_changes_the_past(spark):
    rows = [(k, minute(37 * i), float(i % 5)) for i in range(120) for k in "ab"]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    cut = minute(37 * 70)

    def run(x):
        return lag.feature_lag(apply_rules(x, rules_of("ffill_zero_close")), ["close"], 2)

    early = lambda x: sorted(run(x).where(F.col("timestamp") <= F.lit(cut).cast("timestamp_ntz")).collect(), key=str)
    assert early(df) == early(df.where(F.col("timestamp") <= F.lit(cut).cast("timestamp_ntz")))


def test_feature_lag(spark):
    rows = [(minute(i), s, x, f"{s}{x}{i}") for i in range(4) for s in (1, 2) for x in "CP"]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, strike int, right string, v string")
    got = {(r.timestamp, r.strike, r.right): r.v_lag1 for r in lag.feature_lag(df, ["v", "none"], 1).collect()}
    assert all(v == (None if t == T0 else f"{s}{x}{(t - T0).seconds // 60 - 1}") for (t, s, x), v in got.items())
    assert lag.feature_lag(df, ["v"], 0) is df
    with pytest.raises(ValueError):
        lag.feature_lag(df, ["v"], -1)


def test_session_lag_and_daily(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (2, 3, 5, 8)], "date date, x int")
    assert sorted((r.date.day, r.x) for r in lag.session_lag(days, 1).collect()) == [(3, 2), (5, 3), (8, 5)]
    bars_ = spark.createDataFrame([(dt.datetime(2024, 1, 3, 10), 1), (dt.datetime(2024, 1, 4, 10), 2)], "timestamp timestamp_ntz, a int")
    assert sorted((r.a, r.x) for r in attach_daily(bars_, lag.session_lag(days, 1)).collect()) == [(1, 2), (2, None)]
    with pytest.raises(ValueError):
        lag.session_lag(days, -1)


def test_resample(spark):
    df = spark.createDataFrame([(minute(i), 1.0 + i, 2.0 + i, 0.5 + i, 1.5 + i, 10) for i in range(10)], "timestamp timestamp_ntz, open double, high double, low double, close double, volume int")
    got = bars.resample_ohlc(df, "5m").orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == [(T0, 1.0, 6.0, 0.5, 5.5, 50), (minute(5), 6.0, 11.0, 5.5, 10.5, 50)]
    assert bars.resample_ohlc(df.where("false"), "1h").count() == 0
    week = bars.resample_ohlc(df, "1w").first().timestamp
    assert week == dt.datetime(2024, 1, 1)
    for bad in ("5x", "0m", "2mo"):
        with pytest.raises(ValueError):
            bars.label(bad)


def test_outer_and_prefix(spark):
    a = spark.createDataFrame([(minute(1), 1)], "timestamp timestamp_ntz, close int")
    b = spark.createDataFrame([(minute(2), 2)], "timestamp timestamp_ntz, close int")
    got = outer([prefixed(a, "vix_ohlc"), prefixed(b, "greeks_0dte")]).orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == [(minute(1), 1, None), (minute(2), None, 2)]


def test_regime_gates_and_constant_series(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), 10.0, 80.0 + i % 7) for i in range(300)]
    got = regime.build(spark.createDataFrame(rows, "date date, vix double, vvix double")).orderBy("date").collect()
    assert len(got) == 300 - 251 and got[0].vix_pct_252 == 1.0 and got[0].vix_z_20 is None and got[0].regime_2x2 == "low_falling"
    assert got[0].vix_regime == "extreme"


def test_filters(spark):
    df = spark.createDataFrame([("a_b", 1.5, 1), ("axb", 2.5, 2), ("a\\b", 3.5, None)], "s string, f float, n int")
    n = lambda *f: scan.where_all(df, [f]).count()
    assert n("f", "=", 1.5) == 1 and n("f", ">=", 2) == 2 and n("s", "LIKE", "a\\_b") == 0 and n("s", "like", "a_b") == 3
    assert n("n", "IN", []) == 0 and n("n", "NOT IN", []) == 3 and n("n", "IN", 1) == 1 and n("n", "NOT IN", [1, None]) == 0
    with pytest.raises(ValueError, match="Disallowed"):
        n("f", "; drop", 1)
    with pytest.raises(ValueError, match="unknown column"):
        n("f` OR 1=1 --", "=", 1)


def test_dte(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 15, 59, 58, 700_000), "2024-01-02"), (dt.datetime(2024, 1, 2, 16), "2024-01-05")], "timestamp timestamp_ntz, expiration string")
    got = scan.with_dte(df).orderBy("expiration").collect()
    assert [r.dte for r in got] == [0, 3] and [round(r.dte_fractional * 86400) for r in got] == [2, 3 * 86400]
    with pytest.raises(ValueError):
        scan.with_dte(df.drop("expiration"))


def test_requests_and_dates():
    assert scan.date_range("2024-01-02") == (dt.date(2024, 1, 2),) * 2 and scan.as_date("20240102") == dt.date(2024, 1, 2)
    a = scan.Request("x", dt.date(2024, 1, 1), dt.date(2024, 1, 2), filters=(("d", "=", dt.date(2024, 1, 1)),))
    assert a.fingerprint() == a.fingerprint() != a.fingerprint("snapshot")
    assert a.fingerprint() != scan.Request("x", dt.date(2024, 1, 1), dt.date(2024, 1, 2), filters=(("d", "=", "2024-01-01"),)).fingerprint()


def test_catalog():
    assert len(DEFAULT.names()) == 20 and len(DEFAULT.aliases()) == 21
    assert DEFAULT.resolve("spx_quote") == "quotes_0dte" and "td_eod" in DEFAULT
    assert DEFAULT.get("greeks_tick").bulk and DEFAULT.get("vol_regime").single_file and DEFAULT.get("oi").root == "store/oi"
    with pytest.raises(KeyError, match="spx_ohlc"):
        DEFAULT.get("nothing")
    for aliases in ({"a": "none"}, {"spx_ohlc": "oi"}):
        with pytest.raises(ValueError):
            Catalog([DEFAULT.get("spx_ohlc"), DEFAULT.get("oi")], aliases)
    assert [r.params for r in parse_rules(["a", {"b": True}, {"c": 3}, {"d": None}, {"e": {"x": 1}}])] == [{}, {"enabled": True}, {"value": 3}, {}, {"x": 1}]
    for bad in (3, {"a": 1, "b": 2}):
        with pytest.raises(ValueError):
            parse_rules([bad])
    with pytest.raises(ValueError):
        Dataset("x", {"a": "decimal"})
    with pytest.raises(ValueError):
        Dataset("x", {"strike": "float32", "timestamp": "utf8"})
    made = Catalog.from_dict({"datasets": {"x-t": {}, "d": {"columns": {"a": "int8"}, "rules": ["add_mid"], "index": "a"}}, "aliases": {"old": "d"}})
    assert made.get("old").rules[0].name == "add_mid"


def test_own_rules(spark):
    @rule("double_bid")
    def double_bid(df, **_):
        return df.withColumn("bid", F.col("bid") * 2)

    assert apply_rules(spark.createDataFrame([(1.0,)], "bid double"), rules_of("double_bid")).first().bid == 2.0
    del HANDLERS["double_bid"]
