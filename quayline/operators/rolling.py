"""Rolling totals over trailing calendar periods, and checks of stored rolling features.

Each daily total is exploded onto every output date it influences and summed by entity and date;
calendar rows then supply the days without activity. Rows are first laid out by (entity, block of
days), so that nearly all exploded rows of a day meet before the shuffle and an entity that holds a
third of all rows is spread over its blocks. After the latest row per (entity, day) is chosen, an
entity has at most one row per calendar day, which bounds what a window by entity ever sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import columns

BLOCK_DAYS = 256


def present(*names: str) -> str:
    """Condition that none is null, worded as the planner words its own, so that equal ones are seen to be equal."""
    return " and ".join(f"`{n}` is not null" for n in names)


def latest(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """The row with the latest ``order`` per key; of equally late ones the largest by values.

    Rows with a null key are dropped, a null ``order`` is the earliest. Works after any partitioning
    by a subset of the keys without a further shuffle.
    """
    kept = df.where(present(*keys)).groupBy(*keys).agg(F.max(F.struct(order, *values)).alias("_row"))
    return kept.select(*keys, *[F.col("_row")[v].alias(v) for v in values])


def daily(prices: DataFrame, *values: str) -> DataFrame:
    """Kept rows of a price table: ticker, block, date and the values."""
    rows = columns(prices, "ticker", "date", "updated_at", *values)
    rows = rows.withColumn("block", F.floor(F.unix_date("date") / BLOCK_DAYS).cast("int"))
    # joins and windows ask for keys that are not null; asked for here, all branches read one exchange
    rows = rows.where(present("ticker", "block", "date")).repartition("ticker", "block")
    return latest(rows, ["ticker", "block", "date"], "updated_at", list(values))


def rolling_totals(rows: DataFrame, entity: str, day: str, value: str, periods: tuple[int, ...] = (7, 30)) -> DataFrame:
    """(entity, day, total_N, mean_N for each period) of every day from an entity's first to its last row.

    ``rows`` has one row per entity and day. Null and negative values count as 0, days without row
    too; means are over the N calendar days, also where the history is shorter. Rows with a null
    entity or day are dropped; no rows give no rows.
    """
    longest = max(periods)
    base = rows.select(F.col(entity).alias("entity"), F.col(day).alias("day"), F.greatest(F.coalesce(F.col(value), F.lit(0)), F.lit(0)).alias("v")).where(present("entity", "day"))
    spread = base.where("v > 0").select("entity", "day", "v", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("ahead"))
    totals = spread.groupBy("entity", F.date_add("day", F.col("ahead")).alias("day")).agg(*[F.sum(F.when(F.col("ahead") < n, F.col("v")).otherwise(0)).alias(f"total_{n}") for n in periods])
    spans = base.groupBy("entity").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = spans.select("entity", F.explode(F.sequence("first", "last")).alias("day"), "first")
    # the planner takes the exploded calendar to be as small as the spans and would broadcast it
    full = calendar.hint("merge").join(totals, ["entity", "day"], "left")
    out = [F.coalesce(f"total_{n}", F.lit(0)).alias(f"total_{n}") for n in periods]
    full = full.select("entity", "day", "first", *out)
    return full.select(F.col("entity").alias(entity), F.col("day").alias(day), "first", *[f"total_{n}" for n in periods], *[(F.col(f"total_{n}") / n).alias(f"mean_{n}") for n in periods])


def right_features(kept: DataFrame) -> DataFrame:
    """volume_change_5d and volatility_5d of each kept row, from the ticker's last five rows."""
    w = Window.partitionBy("ticker").orderBy("date")
    five = w.rowsBetween(-4, 0)
    before = F.lag("close").over(w)
    step = kept.withColumn("step", F.when((F.col("close") > 0) & (before > 0), F.ln(F.col("close") / before)))
    mean = F.avg("volume").over(five)
    return step.select("ticker", "date", F.when(mean != 0, F.col("volume") / mean).alias("volume_change_5d"), F.stddev_samp("step").over(five).alias("volatility_5d"))


def rolling_findings(prices: DataFrame, features: DataFrame, share: float = 0.02, least: float = 0.0003) -> DataFrame:
    """(ticker, day, kind): idle and surging days, and stored features that do not follow from the prices.

    Null stored or right values are no finding; repeated feature rows give one. Other columns of the
    tables do not matter, whatever their names.
    """
    kept = daily(prices, "close", "volume")
    totals = rolling_totals(kept, "ticker", "date", "volume")
    full = totals.where(F.col("date") >= F.date_add("first", 29))
    kind = F.when((F.col("total_7") == 0) & (F.col("total_30") > 0), "idle").when(2 * F.col("total_7") > F.col("total_30"), "surge")
    days = full.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("day"), kind.alias("kind")).where("kind is not null")
    names = ["volume_change_5d", "volatility_5d"]
    stored = columns(features, "ticker", "date", *names).select("ticker", "date", *[F.col(n).alias(f"stored_{n}") for n in names])
    both = stored.join(right_features(kept), ["ticker", "date"])
    wrong = both.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("day"), F.explode(F.array(*[F.when(_differs(n, share, least), F.lit(n)) for n in names])).alias("kind"))
    return days.unionByName(wrong.where("kind is not null").distinct())


def _differs(name: str, share: float, least: float):
    gap = F.abs(F.col(f"stored_{name}") - F.col(name))
    return (gap > share * F.abs(name)) & (gap > least)
