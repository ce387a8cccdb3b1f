"""Articles against intraday bars: publication timing, the next bar, and what the bars after it did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import t_statistic
from ..operators.asof import forward
from ..operators.features import guarded_log
from . import base
from .base import r6, sql_r6
from .panel import dated_scores

INTERVAL, AHEAD = "15m", 8
DAY_US = 86_400_000_000
# Minutes of the local day at which trading opens and closes.
OPEN, CLOSE = 540, 885


def timing(stamp: str) -> Column:
    """Publication bucket by local time; exactly midnight means that only the date is known."""
    local = F.from_utc_timestamp(stamp, base.LOCAL)
    minute = F.hour(local) * 60 + F.minute(local)
    exact = (minute == 0) & (F.second(local) == 0)
    return F.when(exact, "midnight_only").when(minute < OPEN, "pre_open").when(minute < CLOSE, "intraday").otherwise("post_close")


def timed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = F.from_utc_timestamp("published_at", base.LOCAL)
    return dated_scores(spark, sf_dir).select("article_id", "ticker", "sentiment_score", "final_sentiment", F.unix_micros("published_at").alias("published_us"), timing("published_at").alias("timing"), F.hour(local).alias("pub_hour"), "article_date")


def bar_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one interval with the log return to the bar before and those of the next bars."""
    rows = base.bars(spark, sf_dir, INTERVAL).select("ticker", "ts", F.unix_micros("ts").alias("bar_us"), "close")
    order = Window.partitionBy("ticker").orderBy("ts")
    rows = rows.withColumn("bar_return", guarded_log("close", order))
    ahead = [F.lead("bar_return", k).over(order).alias(f"fwd_bar_{k}") for k in range(1, AHEAD + 1)]
    return rows.select("ticker", "bar_us", "close", "bar_return", *ahead, F.sum("bar_return").over(order.rowsBetween(1, AHEAD)).alias("fwd_cum"))


def article_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the first bar at or after publication; scores without one are left out."""
    values = ["bar_return", *[f"fwd_bar_{k}" for k in range(1, AHEAD + 1)], "fwd_cum"]
    found = forward(timed_scores(spark, sf_dir), bar_returns(spark, sf_dir), "ticker", "published_us", "bar_us", DAY_US, values)
    return found.where("bar_us is not null").withColumn("lag_minutes", (F.col("bar_us") - F.col("published_us")) / 60_000_000)


def src_18_article_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_scores(spark, sf_dir)


def prj_06_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_scores(spark, sf_dir).select("article_id", "ticker", "timing")


def win_09_bar_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_returns(spark, sf_dir).select("ticker", "bar_us", r6("bar_return").alias("bar_return"))


def win_10_forward_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_returns(spark, sf_dir).select("ticker", "bar_us", *[r6(f"fwd_bar_{k}").alias(f"fwd_bar_{k}") for k in range(1, AHEAD + 1)], r6("fwd_cum").alias("fwd_cum"))


def jon_10_next_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_bars(spark, sf_dir).select("article_id", "ticker", "bar_us", r6("lag_minutes").alias("lag_minutes"), r6("fwd_cum").alias("fwd_cum"))


def agg_25_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_scores(spark, sf_dir).groupBy("pub_hour").agg(F.countDistinct("article_id").alias("articles"), F.count("*").alias("n"))


def agg_26_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles, mean score, label shares and share of all rows by timing, in the order of the day."""
    share = lambda x: r6(F.avg(F.when(F.col("final_sentiment") == x, 1.0).otherwise(0.0))).alias(f"share_{x}")
    rows = timed_scores(spark, sf_dir).groupBy("timing").agg(F.countDistinct("article_id").alias("articles"), F.count("*").alias("n"), r6(F.avg("sentiment_score")).alias("mean_score"), share("positive"), share("neutral"), share("negative"))
    total = rows.agg(F.sum("n").alias("total"))
    order = F.array_position(F.array(*[F.lit(x) for x in ("midnight_only", "pre_open", "intraday", "post_close")]), F.col("timing"))
    return rows.withColumn("share_of_all", r6(F.col("n") / total.scalar())).orderBy(order)


def agg_27_ticker_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_scores(spark, sf_dir).groupBy("ticker", "timing").agg(F.count("*").alias("n"), r6(F.avg("sentiment_score")).alias("mean_score"))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = [f"fwd_bar_{k}" for k in range(1, AHEAD + 1)]
    return article_bars(spark, sf_dir).unpivot(["timing", "final_sentiment"], bars, "bar", "value").where("value is not null")


def agg_33_reaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar returns by label and bar; t only from ten values on."""
    return _long(spark, sf_dir).groupBy("final_sentiment", "bar").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"), r6(F.median("value")).alias("median"), F.round(t_statistic("value", 10), 3).alias("t_stat"))


def agg_34_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by timing too, and over all timings; from five values on."""
    rows = _long(spark, sf_dir).groupingSets([["timing", "final_sentiment", "bar"], ["final_sentiment", "bar"]], "timing", "final_sentiment", "bar")
    out = rows.agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"), F.round(t_statistic("value", 5), 3).alias("t_stat"))
    return out.where("n >= 5").withColumn("timing", F.coalesce("timing", F.lit("ALL")))


def sta_05_cutoff_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction of the first bar against the label by timing; an unknown bar counts as down."""
    rows = article_bars(spark, sf_dir).where("final_sentiment <> 'neutral'").select("timing", (F.col("final_sentiment") == "positive").alias("p"), F.coalesce(F.col("fwd_bar_1") > 0, F.lit(False)).alias("y"))
    cell = lambda p, y: F.sum(F.when((F.col("p") == p) & (F.col("y") == y), 1).otherwise(0))
    return rows.groupBy("timing").agg(cell(True, True).alias("tp"), cell(True, False).alias("fp"), cell(False, True).alias("fn"), cell(False, False).alias("tn"))


def dat_05_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local hour, minute, weekday (1 is Sunday), year and date of each publication."""
    t = F.from_utc_timestamp("published_at", base.LOCAL)
    return base.articles(spark, sf_dir, "published_at").where("published_at is not null").select("article_id", F.hour(t).alias("hour"), F.minute(t).alias("minute"), F.dayofweek(t).alias("weekday"), F.year(t).alias("year"), F.to_date(t).alias("day"))


_TIMED = f"""{base.ARTICLES}, {base.SCORES}, local as (select s.article_id, s.ticker, s.sentiment_score, s.final_sentiment, epoch_us(a.published_at) as published_us, make_timestamp(epoch_us(a.published_at) + 25200000000) as t from scores s join arts a using (article_id) where a.published_at is not null),
timed as (select article_id, ticker, sentiment_score, final_sentiment, published_us, case when hour(t) = 0 and minute(t) = 0 and floor(second(t)) = 0 then 'midnight_only' when hour(t) * 60 + minute(t) < {OPEN} then 'pre_open' when hour(t) * 60 + minute(t) < {CLOSE} then 'intraday' else 'post_close' end as timing, hour(t)::int as pub_hour, cast(t as date) as article_date from local)"""
_BARS = f"""{base.BARS}, one as (select ticker, us as bar_us, close from bars where "interval" = '{INTERVAL}'), r as (select *, case when close > 0 and lag(close) over w > 0 then ln(close / lag(close) over w) end as bar_return from one window w as (partition by ticker order by bar_us)),
br as (select *, {", ".join(f"lead(bar_return, {k}) over w as fwd_bar_{k}" for k in range(1, AHEAD + 1))}, sum(bar_return) over (partition by ticker order by bar_us rows between 1 following and {AHEAD} following) as fwd_cum from r window w as (partition by ticker order by bar_us))"""
_JOINED = f"{_TIMED}, {_BARS}, ab as (select q.*, b.* exclude (ticker, close) from timed q asof join br b on q.ticker = b.ticker and q.published_us <= b.bar_us)"
_NAMES = [f"fwd_bar_{k}" for k in range(1, AHEAD + 1)]
_LONG = f"{_JOINED}, long as (select * from (select timing, final_sentiment, unnest({_NAMES}) as bar, unnest([{', '.join(_NAMES)}]) as value from ab) where value is not null)"
_TS = "case when count(value) >= {0} and min(value) < max(value) then round(avg(value) / (stddev_samp(value) / sqrt(count(value))), 3) end"
_SHARES = ", ".join(f"{sql_r6(f'avg(case when final_sentiment = {chr(39)}{x}{chr(39)} then 1.0 else 0.0 end)')} as share_{x}" for x in ("positive", "neutral", "negative"))

SQL = {
    "src_18_article_sentiment": f"with {_TIMED} select * from timed",
    "prj_06_timing": f"with {_TIMED} select article_id, ticker, timing from timed",
    "win_09_bar_return": f"with {_BARS} select ticker, bar_us, {sql_r6('bar_return')} as bar_return from br",
    "win_10_forward_bars": f"with {_BARS} select ticker, bar_us, " + ", ".join(f"{sql_r6(n)} as {n}" for n in [*_NAMES, "fwd_cum"]) + " from br",
    "jon_10_next_bar": f"with {_JOINED} select article_id, ticker, bar_us, {sql_r6('(bar_us - published_us) / 60000000')} as lag_minutes, {sql_r6('fwd_cum')} as fwd_cum from ab",
    "agg_25_hours": f"with {_TIMED} select pub_hour, count(distinct article_id) as articles, count(*) as n from timed group by pub_hour",
    "agg_26_buckets": f"with {_TIMED} select timing, count(distinct article_id) as articles, count(*) as n, {sql_r6('avg(sentiment_score)')} as mean_score, {_SHARES}, {sql_r6('count(*) / sum(count(*)) over ()')} as share_of_all from timed group by timing",
    "agg_27_ticker_buckets": f"with {_TIMED} select ticker, timing, count(*) as n, {sql_r6('avg(sentiment_score)')} as mean_score from timed group by all",
    "agg_33_reaction": f"with {_LONG} select final_sentiment, bar, count(*) as n, {sql_r6('avg(value)')} as mean, {sql_r6('median(value)')} as median, {_TS.format(10)} as t_stat from long group by all",
    "agg_34_cutoff": f"with {_LONG} select coalesce(timing, 'ALL') as timing, final_sentiment, bar, count(*) as n, {sql_r6('avg(value)')} as mean, {_TS.format(5)} as t_stat from long group by grouping sets ((timing, final_sentiment, bar), (final_sentiment, bar)) having count(*) >= 5",
    "sta_05_cutoff_metrics": f"with {_JOINED}, m as (select timing, final_sentiment = 'positive' as p, coalesce(fwd_bar_1 > 0, false) as y from ab where final_sentiment <> 'neutral') select timing, (count(*) filter (p and y)) as tp, (count(*) filter (p and not y)) as fp, (count(*) filter (not p and y)) as fn, (count(*) filter (not p and not y)) as tn from m group by timing",
    "dat_05_parts": f"with {base.ARTICLES}, l as (select article_id, make_timestamp(epoch_us(published_at) + 25200000000) as t from arts where published_at is not null) select article_id, hour(t)::int as hour, minute(t)::int as minute, (dayofweek(t) + 1)::int as weekday, year(t)::int as year, cast(t as date) as day from l",
}
QUERIES = {name: f for name, f in list(globals().items()) if name in SQL}
