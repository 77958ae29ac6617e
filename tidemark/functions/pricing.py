"""Black-Scholes as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Abramowitz and Stegun 7.1.26
ERF = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
ERF_P = 0.3275911
FLOOR = 1e-6


def erf(x: Column) -> Column:
    t = 1 / (1 + ERF_P * F.abs(x))
    poly = F.lit(0.0)
    for a in reversed(ERF):
        poly = (poly + a) * t
    return F.signum(x) * (1 - poly * F.exp(-x * x))


def cdf(x: Column) -> Column:
    return 0.5 * (1 + erf(x / math.sqrt(2)))


def pdf(x: Column) -> Column:
    return F.exp(-0.5 * x * x) / math.sqrt(2 * math.pi)


def black_scholes(df: DataFrame, spot: Column, strike: Column, years: Column, vol: Column, call: Column, rate: float = 0.05) -> DataFrame:
    """df with price, delta, gamma, theta (a day), vega and rho (a point) and lambda.

    Shared terms are columns of their own for a while, so that each is computed once and the generated code stays small.
    """
    df = df.withColumns({"_s": spot, "_k": strike, "_t": F.greatest(years, F.lit(FLOOR)), "_v": vol, "_c": call})
    s, k, t, v, c = (F.col(f"_{x}") for x in "sktvc")
    df = df.withColumns({"_d1": (F.log(s / k) + (rate + v * v / 2) * t) / (v * F.sqrt(t)), "_b": k * F.exp(-rate * t)})
    d1 = F.col("_d1")
    df = df.withColumns({"_d2": d1 - v * F.sqrt(t), "_n": pdf(d1), "_c1": cdf(d1), "_m1": cdf(-d1)})
    df = df.withColumns({"_c2": cdf(F.col("_d2")), "_m2": cdf(-F.col("_d2"))})
    b, n, c1, m1, c2, m2 = (F.col(f"_{x}") for x in ("b", "n", "c1", "m1", "c2", "m2"))
    df = df.withColumns({"price": F.when(c, s * c1 - b * c2).otherwise(b * m2 - s * m1), "delta": F.when(c, c1).otherwise(c1 - 1)})
    return df.withColumns(
        {
            "gamma": n / (s * v * F.sqrt(t)),
            "theta": (-s * n * v / (2 * F.sqrt(t)) + F.when(c, -rate * b * c2).otherwise(rate * b * m2)) / 365,
            "vega": s * n * F.sqrt(t) / 100,
            "rho": F.when(c, b * t * c2).otherwise(-b * t * m2) / 100,
            "lambda": F.when(F.col("price") > 0, F.col("delta") * s / F.col("price")),
        }
    ).drop(*TERMS)


TERMS = ("_s", "_k", "_t", "_v", "_c", "_d1", "_b", "_d2", "_n", "_c1", "_m1", "_c2", "_m2")


# Slope and curvature of the smile a unit of scaled log-moneyness, and its least time (a minute of trading)
SKEW, CURVATURE = -0.018, 0.015
MINUTE = 1 / (252 * 390)


def smile(spot: Column, strike: Column, years: Column, base: Column) -> Column:
    """The volatility at the money, scaled by a skew and a curve in log-moneyness over the root of time; held to 0.05 to 3."""
    x = F.log(strike / spot) / F.sqrt(F.greatest(years, F.lit(MINUTE)))
    return F.greatest(F.lit(0.05), F.least(F.lit(3.0), base * (1 + SKEW * x + CURVATURE * x * x)))
