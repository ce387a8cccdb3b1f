"""Rolling totals and implausible values: small cases, brute force and odd input."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayline.operators.rolling import rolling_findings, rolling_totals
from quayline.operators.spikes import flag_series, implausible, posteriors

PRICES = "date date, ticker string, open double, high double, low double, close double, volume bigint, updated_at timestamp"
FEATURES = "date date, ticker string, volume_change_5d double, volatility_5d double"
BARS = "ts timestamp, ticker string, interval string, high double, low double, close double, volume bigint, created_at timestamp"
DAY = dt.date(2025, 1, 1)


def price(k, ticker="A", close=10.0, volume=100, stamp=0, low=None, high=None):
    low = close if low is None and close is not None else low
    high = close if high is None and close is not None else high
    return (DAY + dt.timedelta(days=k), ticker, close, high, low, close, volume, dt.datetime(2025, 1, 1) + dt.timedelta(minutes=stamp))


def found(df):
    return {tuple(r) for r in df.collect()}


def test_totals_count_missing_null_and_negative_days_as_zero(spark):
    rows = spark.createDataFrame([("A", DAY, 5), ("A", DAY + dt.timedelta(days=3), None), ("A", DAY + dt.timedelta(days=8), 7), ("A", DAY + dt.timedelta(days=9), -4), (None, DAY, 9), ("B", None, 9)], "e string, d date, v bigint")
    got = {r.d: (r.total_7, r.total_30, round(r.mean_7, 6)) for r in rolling_totals(rows, "e", "d", "v").where("e = 'A'").collect()}
    assert len(got) == 10
    assert got[DAY] == (5, 5, round(5 / 7, 6))
    assert got[DAY + dt.timedelta(days=6)][0] == 5
    assert got[DAY + dt.timedelta(days=7)][:2] == (0, 5)
    assert got[DAY + dt.timedelta(days=9)][:2] == (7, 12)


def test_totals_like_brute_force(spark):
    rng = random.Random(5)
    rows = {(t, k): rng.choice([0, 1, 5, 100]) for t in "AB" for k in range(120) if rng.random() < 0.4}
    df = spark.createDataFrame([(t, DAY + dt.timedelta(days=k), v) for (t, k), v in rows.items()], "e string, d date, v bigint")
    for r in rolling_totals(df, "e", "d", "v", (3, 10)).collect():
        k = (r.d - DAY).days
        assert r.total_3 == sum(rows.get((r.e, j), 0) for j in range(k - 2, k + 1))
        assert r.total_10 == sum(rows.get((r.e, j), 0) for j in range(k - 9, k + 1))


def test_findings(spark):
    days = [price(k, volume=0 if k > 31 else 10) for k in range(45)] + [price(45, volume=500), price(45, volume=1, stamp=-9)]
    features = [(DAY + dt.timedelta(days=4), "A", 1.0, 0.0), (DAY + dt.timedelta(days=5), "A", 1.5, None), (DAY + dt.timedelta(days=5), "A", 1.5, None), (DAY + dt.timedelta(days=6), "A", None, 0.4)]
    got = found(rolling_findings(spark.createDataFrame(days, PRICES), spark.createDataFrame(features, FEATURES)))
    day = lambda k: str(DAY + dt.timedelta(days=k))
    assert ("A", day(38), "idle") in got and ("A", day(44), "idle") in got and ("A", day(37), "idle") not in got
    assert ("A", day(45), "surge") in got
    assert ("A", day(5), "volume_change_5d") in got and ("A", day(6), "volatility_5d") in got
    assert not any(d == day(4) for _, d, _ in got)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None, None, None)], [price(0, close=None, volume=None)] * 3])
def test_odd_tables(spark, rows):
    prices = spark.createDataFrame(rows, PRICES)
    assert rolling_findings(prices, spark.createDataFrame([], FEATURES)).count() == 0
    assert implausible(prices, spark.createDataFrame([], BARS)).count() == 0


def test_clashing_columns(spark):
    rows = [(*price(k, close=10.0 + k % 3), "x", "y") for k in range(40)]
    df = spark.createDataFrame(rows, PRICES + ", TICKER string, block string")
    features = spark.createDataFrame([(DAY, "A", 9.0, None, "z")], FEATURES + ", Date string")
    assert found(rolling_findings(df, features)) == {("A", "2025-01-01", "volume_change_5d")}
    assert implausible(df, spark.createDataFrame([], BARS + ", TS string")).count() == 0


def walk(rng, n, start=100.0, step=0.01):
    return list(np.round(start * np.exp(np.cumsum(rng.normal(0, step, n))), 4))


def test_kinds_of_implausible_values(spark):
    rng = np.random.default_rng(1)
    close = walk(rng, 200)
    volume = [int(v) for v in rng.integers(900, 1100, 200)]
    close[50] *= 1.5
    close[90:99] = [close[90]] * 9
    close[120:] = [c * 2 for c in close[120:]]
    volume[30], volume[60] = 50_000, -5
    volume[70:76] = [volume[70]] * 6
    rows = [price(k, close=float(c), volume=v) for k, (c, v) in enumerate(zip(close, volume))]
    rows[10] = price(10, close=0.0, volume=volume[10])
    rows[20] = price(20, close=float(close[20]), low=float(close[20] * 1.1), high=float(close[20] * 1.2), volume=volume[20])
    day = lambda k: str(DAY + dt.timedelta(days=k))
    got = found(implausible(spark.createDataFrame(rows, PRICES), spark.createDataFrame([], BARS)))
    want = {("market_prices.close", "A", "1d", day(k)) for k in (10, 20, 50, *range(91, 99))}
    want |= {("market_prices.volume", "A", "1d", day(k)) for k in (30, 60, *range(71, 76))}
    assert got == want


def test_rarely_moving_series_is_calm(spark):
    rng = np.random.default_rng(2)
    level, rows = 50.0, []
    for k in range(400):
        level *= float(np.exp(rng.normal(0, 0.01))) if rng.random() < 0.3 else 1.0
        rows.append(price(k, close=round(level, 4), volume=int(rng.integers(0, 50))))
    got = found(implausible(spark.createDataFrame(rows, PRICES), spark.createDataFrame([], BARS)))
    assert not [g for g in got if g[0].endswith("close")]


def test_blocks_do_not_matter(spark):
    """The same flags whether a series is one block or many."""
    rng = np.random.default_rng(3)
    close = walk(rng, 600, step=0.002)
    for k in (49, 50, 100, 301):
        close[k] = close[k - 1]
    close[140:165] = [close[140]] * 25
    close[299] *= 1.2
    rows = spark.createDataFrame([("A", "1m", k * 60_000_000, float(c), None, None, None, 0) for k, c in enumerate(close)], "ticker string, bar_interval string, ts bigint, close double, volume bigint, low double, high double, stamp int")
    flags = lambda n: found(flag_series(rows, "stamp", "intraday_prices.close", None, F.lit(n * 60_000_000)))
    assert flags(10_000) == flags(50) == flags(7)
    assert len(flags(50)) == 25


def test_posteriors_add_up():
    post = posteriors(np.array([[False, True, True, False]]), np.array([[-28.0, -28.0, -28.0, 9.0]]), np.zeros((1, 4), bool), np.array([0.01]), np.array([4]))
    assert np.allclose(post.sum(axis=2), 1) and post[0, 3, 1] > 0.99


def test_out_of_range_is_a_state(spark):
    """Such a value is told by its own state, and a stuck run goes on after it."""
    repeat = np.array([[False] + [True] * 6 + [False] + [True] * 3 + [False] * 3])
    out = np.zeros_like(repeat)
    out[0, 7] = True
    post = posteriors(repeat, np.full(repeat.shape, -5.0), out, np.array([0.01]), np.array([repeat.shape[1]]))
    assert post[0, 7, 3] > 0.999 and (post[0, 1:7, 2] > 0.9).all() and (post[0, 8:11, 2] > 0.9).all()
    assert (post[0, [0, 11, 12, 13], 0] > 0.9).all() and post[0, :7, 3].max() < 1e-6


def test_medians_are_exact(spark, monkeypatch):
    from quayline.operators import spikes

    monkeypatch.setattr(spikes, "GATHERED", 3)
    rng = np.random.default_rng(6)
    series = {"a": rng.normal(size=30_001), "b": np.round(rng.normal(size=20_000), 1), "c": rng.normal(size=4), "d": np.array([2.0]), "e": np.repeat([1.0, 2.0], 500)}
    rows = spark.createDataFrame([(k, float(x)) for k, v in series.items() for x in v] + [("a", None), ("f", None)], "k string, x double")
    got = {r.k: (r.n, r.median) for r in spikes.medians(rows, ["k"], "x").collect()}
    assert got == {k: (len(v), float(np.median(v))) for k, v in series.items()} | {"f": (0, None)}
