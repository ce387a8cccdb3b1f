"""Implausible values in series of measurements, flagged per source by a hidden Markov model.

Each series (a ticker's closes, its volumes, the closes of one bar interval) has its usual move or
value (an exact median), the spread about it and its share of repeats taken from all its rows. A model
with the states normal, spike, stuck and out of range then runs forward and backward over the series,
its emissions scaled by what the series itself is like; hard bounds (the ratio that makes a spike, the
length that makes a run, the row's own range) and the posterior of a state together assign the flag.
A value out of range is a state of its own, entered from a moving or from a stuck series, and leaves
the state before it as it was.

A series is cut into blocks of time; each block gets the last and first valid values of its
neighbours, as many as the longest required run. What is decided about a row therefore does not
depend on where blocks end, and no task holds a whole series. The rows are shuffled once, by block;
statistics and blocks are both made from that one exchange.

Rows with a null key are dropped, null values have no flag and are passed over, of repeated keys the
latest row counts. Series too short to have a usual move have only out-of-range values; no rows give
no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import columns, written
from .rolling import latest, present


@dataclass(frozen=True)
class Limits:
    """Bounds of one measure: a value is a spike above ``spike``, runs of ``run`` or more are stuck."""

    spike: float
    run: int


LIMITS = {"market_prices.close": Limits(7.0, 8), "market_prices.volume": Limits(float(np.log(20.0)), 6), "intraday_prices.close": Limits(7.0, 12)}
#: Rows of a series up to which its median is taken from all values at once; of longer ones only those
#: between two quantiles about the middle are gathered, so far apart in ranks as the sketch may err and more.
GATHERED, SKETCH, MARGIN = 5000, 10_000, 4e-4
#: Values of neighbouring blocks that a block gets to see on either side.
HALO = 12
#: Share of repeats from which a series counts as rarely moving.
QUIET = 0.4
#: Share of a bound by which a close must leave the row's range.
CLEAR = 0.001
BARS_PER_BLOCK = 1024
#: Log probabilities of entering and leaving the stuck state; of a repeat in a moving series, at most.
ENTER, LEAVE, REPEAT = np.log(0.01), np.log(0.05), 0.15
#: How fast the density of spikes falls off, as a share of how fast that of ordinary values does.
SLOWER = 0.1


def posteriors(repeat: np.ndarray, excess: np.ndarray, out: np.ndarray, p0: np.ndarray, length: np.ndarray) -> np.ndarray:
    """State posteriors of many sequences at once, (sequences, time, 4): normal, spike, stuck, out of range.

    repeat: equals the valid value before; excess: log odds of a spike against a normal value; out: cannot
    be; p0: each sequence's share of repeats; length: how much of each row is used. Out of range is two
    states inside, one for moving and one for stuck series.
    """
    n, t = repeat.shape
    quiet = p0 >= QUIET
    p = np.where(quiet, np.minimum(p0, 0.99), np.clip(p0, 1e-3, REPEAT))[:, None]
    never = -1e9
    emit = np.full((n, t, 5), never)
    usual = np.where(repeat, np.log(p), np.log1p(-p))
    emit[..., 0] = usual - np.logaddexp(0, excess)
    emit[..., 1] = usual - np.logaddexp(0, -excess)
    emit[..., 2] = np.where(repeat & ~quiet[:, None], np.log(0.999), never)
    emit[out] = [never, never, never, 0.0, 0.0]
    emit[np.arange(t)[None, :] >= length[:, None]] = 0.0
    stay = np.log1p(-np.exp(LEAVE))
    move = np.array([
        [0, 0, ENTER, 0, never],
        [0, 0, ENTER, 0, never],
        [LEAVE, LEAVE, stay, never, 0],
        [0, 0, ENTER, 0, never],
        [LEAVE, LEAVE, stay, never, 0],
    ])
    step = np.exp(move)
    ahead, back = np.empty((n, t, 5)), np.ones((n, 5))
    like = np.exp(emit - emit.max(axis=2, keepdims=True))
    state = np.full((n, 5), 1.0) * np.array([1.0, 1.0, np.exp(ENTER), 1.0, np.exp(ENTER)])
    for k in range(t):
        state = (state @ step if k else state) * like[:, k]
        state /= state.sum(axis=1, keepdims=True)
        ahead[:, k] = state
    for k in range(t - 1, -1, -1):
        ahead[:, k] *= back
        ahead[:, k] /= ahead[:, k].sum(axis=1, keepdims=True)
        back = (like[:, k] * back) @ step.T
        back /= back.sum(axis=1, keepdims=True)
    ahead[..., 3] += ahead[..., 4]
    return ahead[..., :4]


def _runs(same: np.ndarray) -> np.ndarray:
    """Length of the run of equal values that each place is in; ``same``: equals the place before."""
    ids = np.cumsum(~same)
    return np.bincount(ids)[ids] if len(same) else np.empty(0, int)


class Sequence:
    """One measure of one block with its halos, nulls left out.

    Repeats, runs and moves are those of the valid values; what is out of range keeps its place.
    """

    def __init__(self, measure: str, value: np.ndarray, out: np.ndarray, before: np.ndarray, after: np.ndarray, usual: float, spread: float, p0: float) -> None:
        self.limits = LIMITS[measure]
        self.at, self.p0, self.start = np.flatnonzero(~np.isnan(value)), p0, len(before)
        self.out = np.concatenate([np.zeros(len(before), bool), out[self.at], np.zeros(len(after), bool)])
        own = np.concatenate([before, value[self.at], after])
        valid, volume = ~self.out, measure.endswith("volume")
        x = own[valid]
        same = np.concatenate([[False], x[1:] == x[:-1]]) if len(x) else np.empty(0, bool)
        if volume:
            same &= x > 0
        ratio = np.zeros(len(x))
        if usual and usual > 0 and volume:
            ratio = np.log(np.maximum(x, 1e-12) / usual)
        elif usual and usual > 0 and len(x) > 2:
            level = np.log(x)
            left, right = level[1:-1] - level[:-2], level[1:-1] - level[2:]
            ratio[1:-1] = np.where(left * right > 0, np.minimum(np.abs(left), np.abs(right)), 0.0) / usual
        self.same, self.run, self.ratio = np.zeros(len(own), bool), np.zeros(len(own), int), np.zeros(len(own))
        self.same[valid], self.run[valid], self.ratio[valid] = same, _runs(same), ratio
        # ordinary values fall off as fast as this series' own do, spikes a good deal slower; even at the bound
        slope = 1 / max(spread, 1e-3) if spread and spread > 0 else 1.0
        self.excess = np.clip(slope * (1 - SLOWER) * (self.ratio - self.limits.spike), -600, 600)

    def flags(self, post: np.ndarray) -> np.ndarray:
        """Places in the block that are flagged."""
        stuck = (post[:, 2] >= 0.5) & self.same & (self.run >= self.limits.run)
        spike = (post[:, 1] >= 0.5) & (self.ratio > self.limits.spike)
        bad = stuck | spike | ((post[:, 3] >= 0.5) & self.out)
        return self.at[bad[self.start : self.start + len(self.at)]]


def _flag(it: Iterator[pa.RecordBatch], close: str, volume: str | None) -> Iterator[pa.RecordBatch]:
    def arrays(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
        col = batch.column(batch.schema.get_field_index(name))
        flat = col.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum([x.as_py() or 0 for x in pa.compute.list_value_length(col)])
        return np.split(flat, ends[:-1]) if len(ends) else []

    for whole in it:
        for k in range(0, whole.num_rows, 256):
            batch = whole.slice(k, 256)
            cols = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("ticker", "bar_interval", "usual", "spread", "repeats", "typical", "spread_v", "repeats_v")}
            lists = {n: arrays(batch, n) for n in ("ts", "close", "volume", "low", "high", "close_before", "close_after", "volume_before", "volume_after")}
            found: list[tuple[int, str, Sequence]] = []
            for row in range(batch.num_rows):
                c, low, high = (lists[n][row].astype(float) for n in ("close", "low", "high"))
                own = ~np.isnan(c)
                out = own & ((c <= 0) | (c > high + CLEAR * np.abs(high)) | (c < low - CLEAR * np.abs(low)))
                found.append((row, close, Sequence(close, c, out, lists["close_before"][row].astype(float), lists["close_after"][row].astype(float), cols["usual"][row], cols["spread"][row], cols["repeats"][row] or 0.0)))
                if volume:
                    v = lists["volume"][row].astype(float)
                    found.append((row, volume, Sequence(volume, v, v < 0, lists["volume_before"][row].astype(float), lists["volume_after"][row].astype(float), cols["typical"][row], cols["spread_v"][row], cols["repeats_v"][row] or 0.0)))
            found.sort(key=lambda x: len(x[2].same))
            tickers, intervals, times, measures = [], [], [], []
            for k2 in range(0, len(found), 64):
                part = found[k2 : k2 + 64]
                t = max(1, max(len(s.same) for _, _, s in part))
                repeat, excess, out = np.zeros((len(part), t), bool), np.zeros((len(part), t)), np.zeros((len(part), t), bool)
                for r, (_, _, s) in enumerate(part):
                    repeat[r, : len(s.same)] = s.same
                    excess[r, : len(s.same)] = s.excess
                    out[r, : len(s.same)] = s.out
                post = posteriors(repeat, excess, out, np.array([s.p0 for _, _, s in part]), np.array([len(s.same) for _, _, s in part]))
                for r, (row, measure, s) in enumerate(part):
                    for place in s.flags(post[r, : len(s.same)]):
                        tickers.append(cols["ticker"][row])
                        intervals.append(cols["bar_interval"][row])
                        times.append(int(lists["ts"][row][place]))
                        measures.append(measure)
            yield pa.RecordBatch.from_arrays([pa.array(measures, pa.string()), pa.array(tickers, pa.string()), pa.array(intervals, pa.string()), pa.array(times, pa.int64())], ["measure", "ticker", "bar_interval", "ts"])


def _middle(inside: Column, below: Column, n: Column) -> Column:
    """The exact median, from the sorted values between the ends and the number of those below."""
    at = lambda k: F.get(inside, (k - below).cast("int"))
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def medians(values: DataFrame, series: list[str], name: str, **besides: Column) -> DataFrame:
    """(series, n, median) of a column, exact, without gathering a long series; and other aggregates of all rows.

    A sketch gives two values between which the middle surely lies; those between are sorted, those
    below only counted. Nulls do not count; a series without values has a null median.
    """
    x = F.col(name)
    ends = values.groupBy(*series).agg(F.count(name).alias("n"), F.percentile_approx(name, F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN)), SKETCH).alias("ends"), *[c.alias(k) for k, c in besides.items()])
    ends = ends.select(*series, "n", *besides, *[F.when(F.col("n") > GATHERED, F.col("ends")[k]).alias(end) for k, end in enumerate(("low", "high"))])
    low, high = F.coalesce(x < F.col("low"), F.lit(False)), F.coalesce(x > F.col("high"), F.lit(False))
    parts = values.where(x.isNotNull()).join(ends.select(*series, "low", "high"), series).groupBy(*series).agg(F.count_if(low).alias("below"), F.array_sort(F.collect_list(F.when(~low & ~high, x))).alias("inside"))
    return ends.join(parts, series, "left").select(*series, "n", _middle(F.col("inside"), F.col("below"), F.col("n")).alias("median"), *besides)


def statistics(blocks: DataFrame, series: list[str], volumes: bool) -> DataFrame:
    """Per series the median move and volume, the spread about them and the shares of repeats.

    A block brings its own values and the last one before it, so that every move of the series counts.
    """
    def pairs(m: str, valid: str) -> DataFrame:
        x = F.concat(F.slice(F.reverse(f"{m}_before"), 1, 1), valid)
        steps = F.zip_with(x, F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return blocks.select(*series, F.explode(F.filter(steps, lambda s: s.b.isNotNull())).alias("s")).select(*series, "s.a", "s.b")

    same = F.col("a") == F.col("b")
    close = pairs("close", "valid_c").select(*series, F.when(same, 1.0).otherwise(0.0).alias("same"), F.when(~same, F.abs(F.ln(F.col("b") / F.col("a")))).alias("move"))
    usual = medians(close, series, "move", repeats=F.avg("same"), mean=F.avg("move"))
    out = usual.select(*series, (F.col("median") * 1.4826).alias("usual"), "repeats", F.try_divide("mean", F.col("median") * 1.4826).alias("spread"))
    nothing = [F.lit(None).cast("double").alias(n) for n in ("typical", "spread_v", "repeats_v")]
    if not volumes:
        return out.select("*", *nothing)
    volume = blocks.select(*series, F.explode("volume").alias("volume")).select(*series, F.col("volume").cast("double").alias("volume"))
    typical = medians(volume, series, "volume", spread_v=F.stddev_pop(F.when(F.col("volume") > 0, F.ln("volume"))))
    repeats_v = pairs("volume", "valid_v").groupBy(*series).agg(F.avg((same & (F.col("b") > 0)).cast("double")).alias("repeats_v"))
    typical = typical.select(*series, F.col("median").alias("typical"), "spread_v").join(repeats_v, series, "left")
    return out.join(typical, series, "full")


def flag_series(rows: DataFrame, updated: str, close: str, volume: str | None, block_us: Column, interval: str | None = None) -> DataFrame:
    """(measure, ticker, bar_interval, ts) of flagged values.

    rows: ticker, bar_interval, ts (microseconds), close, volume, low, high and the column ``updated``;
    ``block_us`` is the length of a block. Where all bars are of one ``interval``, rows have no
    bar_interval: a constant among the keys would hide from the planner how rows are laid out.
    """
    series = ["ticker"] if interval else ["ticker", "bar_interval"]
    # the joins below ask for keys that are not null; asked for here, all branches read one exchange
    blocks = rows.withColumn("block", F.floor(F.col("ts") / block_us).cast("int"))
    blocks = blocks.where(present(*series, "block")).repartition(*series, "block")
    kept = latest(blocks, [*series, "block", "ts"], updated, ["close", "volume", "low", "high"])
    fits = (F.col("close") > 0) & F.coalesce(F.col("close") <= F.col("high") + CLEAR * F.abs("high"), F.lit(True)) & F.coalesce(F.col("close") >= F.col("low") - CLEAR * F.abs("low"), F.lit(True))
    kept = kept.withColumn("c", F.when(fits, F.col("close"))).withColumn("v", F.when(F.col("volume") >= 0, F.col("volume").cast("double")))
    whole = kept.groupBy(*series, "block").agg(F.array_sort(F.collect_list(F.struct("ts", "close", "volume", "low", "high", "c", "v"))).alias("r"))
    names = ["ts", "close", "volume", "low", "high"]
    valid = [F.filter(F.col(f"r.{n}"), lambda x: x.isNotNull()).alias(f"valid_{n}") for n in ("c", "v")]
    whole = whole.select(*series, "block", *[F.col(f"r.{n}").alias(n) for n in names], *valid)
    near = whole.select(*series, "block", *[F.slice(f"valid_{n}", 1, HALO).alias(f"head_{n}") for n in "cv"], *[F.reverse(F.slice(F.reverse(f"valid_{n}"), 1, HALO)).alias(f"tail_{n}") for n in "cv"])
    order = Window.partitionBy(*series).orderBy("block")
    before, after = order.rowsBetween(-HALO, -1), order.rowsBetween(1, HALO)
    ends = near.select(
        *series,
        "block",
        *[F.reverse(F.slice(F.reverse(F.flatten(F.collect_list(f"tail_{n}").over(before))), 1, HALO)).alias(f"{m}_before") for n, m in (("c", "close"), ("v", "volume"))],
        *[F.slice(F.flatten(F.collect_list(f"head_{n}").over(after)), 1, HALO).alias(f"{m}_after") for n, m in (("c", "close"), ("v", "volume"))],
    )
    # sizes of rows with arrays are guessed too low to leave the choice of the join to the planner
    ready = written(whole.select(*series, "block", *names, "valid_c", "valid_v").join(ends.hint("merge"), [*series, "block"]))
    ready = ready.drop("valid_c", "valid_v").join(statistics(ready, series, volume is not None), series, "left")
    ready = ready.withColumn("bar_interval", F.lit(interval)) if interval else ready
    return ready.mapInArrow(functools.partial(_flag, close=close, volume=volume), "measure string, ticker string, bar_interval string, ts bigint").distinct()


def implausible(prices: DataFrame, intraday: DataFrame) -> DataFrame:
    """(measure, ticker, bar_interval, at_time) over daily and intraday prices."""
    day = 86_400_000_000
    prices = columns(prices, "ticker", "date", "close", "volume", "low", "high", "updated_at")
    intraday = columns(intraday, "ticker", "ts", "interval", "close", "low", "high", "created_at")
    daily = prices.dropna(subset=["ticker", "date"]).select("ticker", (F.unix_date("date").cast("long") * day).alias("ts"), "close", "volume", "low", "high", "updated_at")
    bars = intraday.dropna(subset=["ticker", "ts", "interval"]).select("ticker", F.col("interval").alias("bar_interval"), F.unix_micros("ts").alias("ts"), "close", F.lit(None).cast("bigint").alias("volume"), "low", "high", F.col("created_at").alias("updated_at"))
    minutes = F.when(F.lower("bar_interval").endswith("h"), F.regexp_extract("bar_interval", r"(\d+)", 1).try_cast("long") * 60).otherwise(F.regexp_extract("bar_interval", r"(\d+)", 1).try_cast("long"))
    length = F.coalesce(minutes, F.lit(1)) * (BARS_PER_BLOCK * 60_000_000)
    a = flag_series(daily, "updated_at", "market_prices.close", "market_prices.volume", F.lit(BARS_PER_BLOCK * day), "1d")
    b = flag_series(bars, "updated_at", "intraday_prices.close", None, length)
    stamp = F.timestamp_micros("ts")
    out = lambda df, fmt: df.select("measure", "ticker", "bar_interval", F.date_format(stamp, fmt).alias("at_time"))
    return out(a, "yyyy-MM-dd").unionByName(out(b, "yyyy-MM-dd HH:mm:ss"))
