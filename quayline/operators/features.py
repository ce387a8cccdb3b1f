"""Price features by ticker, in one sort per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def by_day():
    """The rows of a ticker in the order of their days."""
    return Window.partitionBy("ticker").orderBy("date")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null for a zero divisor."""
    return F.try_divide(a, b)


def guarded_log(x: str, w=None) -> Column:
    """ln of the change to the row before; null unless both are above 0."""
    now, before = F.col(x), F.lag(x).over(w or by_day())
    return F.when((now > 0) & (before > 0), F.ln(now / before))


def price_features(prices: DataFrame, variant: str = "log") -> DataFrame:
    """Trailing and forward returns, volume change, volatility, growth and close location.

    ``variant="log"``: volume change is the ratio to the five-row mean, volatility that of log
    returns. ``variant="simple"``: the ratio less one, from two rows on, and that of simple returns.
    A zero close or mean gives null, never an infinite value.
    """
    w = by_day()
    five = w.rowsBetween(-4, 0)
    close = F.col("close")
    step = {f"return_{n}d": ratio(close, F.lag("close", n).over(w)) - 1 for n in (1, 3, 5)}
    ahead = {f"forward_return_{n}d": ratio(F.lead("close", n).over(w), close) - 1 for n in (1, 3, 5)}
    out = prices.select("*", *[v.alias(k) for k, v in (step | ahead).items()], guarded_log("close").alias("log_return"), guarded_log("volume").alias("volume_growth"))
    change = ratio(F.col("volume").cast("double"), F.avg("volume").over(five))
    if variant == "simple":
        change = F.when(F.count("volume").over(five) >= 2, change - 1)
    spread = F.stddev_samp("return_1d" if variant == "simple" else "log_return").over(five)
    clv = F.when(F.col("high") > F.col("low"), (2 * close - F.col("low") - F.col("high")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    return out.select("*", change.alias("volume_change_5d"), spread.alias("volatility_5d"), clv.alias("clv"))


def label(score: Column, threshold: float = 0.25, names: tuple[str, str, str] = ("positive", "negative", "neutral")) -> Column:
    """Three-way label by strict thresholds; a null score is neutral."""
    return F.when(score > threshold, names[0]).when(score < -threshold, names[1]).otherwise(names[2])


def weighted_score(score: str = "sentiment_score", confidence: str = "confidence") -> Column:
    """Mean of the scores times their confidence, which is 1 where it is null."""
    return F.avg(F.col(score) * F.coalesce(F.col(confidence), F.lit(1.0)))
