"""The daily panel: article scores, trading days, sentiment index, price features, and their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import forward
from ..operators.features import label, price_features, weighted_score
from ..session import table
from . import base
from .base import r6

DAYS_PER_BUCKET = 128


def article_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aspect-level rows reduced to one row per (article, ticker); each stored row is one prediction."""
    raw = table(spark, sf_dir, "article_ticker_sentiment").select("article_id", "ticker", "sentiment_score", "confidence", "final_sentiment")
    known = table(spark, sf_dir, "articles").select("article_id").distinct()
    is_ = lambda x: F.sum(F.when(F.col("final_sentiment") == x, 1).otherwise(0))
    return raw.join(known, "article_id", "left_semi").groupBy("article_id", "ticker").agg(weighted_score().alias("sentiment_score"), F.avg("confidence").alias("confidence"), F.count("*").alias("aspect_count"), *[is_(x).alias(f"{x}_count") for x in ("positive", "neutral", "negative")])


def agg_01_article_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = article_scores(spark, sf_dir)
    return s.select("article_id", "ticker", r6("sentiment_score").alias("sentiment_score"), label(r6("sentiment_score")).alias("final_sentiment"), r6("confidence").alias("confidence"), "aspect_count", "positive_count", "neutral_count", "negative_count")


def dated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the local date of their article; articles without publication time are left out."""
    times = base.articles(spark, sf_dir, "published_at").where("published_at is not null")
    return base.scores(spark, sf_dir).join(times, "article_id").withColumn("article_date", base.local_date("published_at"))


def mapped_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the first trading day of their ticker at or after the article's date."""
    asked = dated_scores(spark, sf_dir).withColumn("_day", F.unix_date("article_date"))
    days = base.prices(spark, sf_dir).select("ticker", F.unix_date("date").alias("_trading"))
    mapped = forward(asked, days, "ticker", "_day", "_trading", DAYS_PER_BUCKET)
    return mapped.withColumn("trading_date", F.date_from_unix_date("_trading")).drop("_day", "_trading")


def jon_09_next_trading_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_scores(spark, sf_dir).select("article_id", "ticker", "article_date", "trading_date")


def daily_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence-weighted index per trading day and ticker, with its sector."""
    sectors = base.master(spark, sf_dir).select("ticker", "sector")
    rows = mapped_scores(spark, sf_dir).where("trading_date is not null").join(sectors, "ticker", "left")
    sums = [F.sum(f"{x}_count").alias(f"{x}_count") for x in ("positive", "neutral", "negative")]
    return rows.groupBy(F.col("trading_date").alias("date"), "ticker", "sector").agg(weighted_score().alias("sentiment_index"), F.count("*").alias("article_count"), *sums, F.avg("confidence").alias("avg_confidence")).withColumn("final_sentiment", label(r6("sentiment_index")))


def agg_02_daily_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).select("date", "ticker", "sector", r6("sentiment_index").alias("sentiment_index"), "final_sentiment", "article_count", "positive_count", "neutral_count", "negative_count", r6("avg_confidence").alias("avg_confidence"))


def jon_03_sector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.scores(spark, sf_dir).select("article_id", "ticker").join(base.master(spark, sf_dir), "ticker", "left").select("article_id", "ticker", "sector")


FEATURES = ["return_1d", "return_3d", "return_5d", "forward_return_1d", "forward_return_3d", "forward_return_5d", "volume_change_5d", "volatility_5d", "log_return", "volume_growth", "clv"]


def _features(names: list[str], variant: str = "log"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = price_features(base.prices(spark, sf_dir), variant)
        return rows.select("ticker", "date", *[r6(n).alias(n) for n in names])

    return query


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows with the features of their day; ``target_up`` is 0 where the forward return is null."""
    rows = price_features(base.prices(spark, sf_dir))
    both = daily_index(spark, sf_dir).join(rows, ["date", "ticker"])
    up = F.coalesce((F.col("forward_return_1d") > 0).cast("int"), F.lit(0))
    return both.withColumn("target_up", up).withColumnsRenamed({"sentiment_index": "sentiment_score", "article_count": "news_count"}).withColumn("trust_level", F.lit(None).cast("string"))


def prj_01_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select("date", "ticker", "sector", r6("sentiment_score").alias("sentiment_score"), "news_count", "positive_count", "neutral_count", "negative_count", "final_sentiment", r6("close").alias("close"), "volume", *[r6(n).alias(n) for n in FEATURES], "target_up")


def jon_01_index_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "market_features").select("date", "ticker", "created_at", "forward_return_1d")
    from ..operators.rolling import latest

    kept = latest(stored, ["date", "ticker"], "created_at", ["forward_return_1d"])
    return daily_index(spark, sf_dir).select("date", "ticker", "article_count").join(kept, ["date", "ticker"]).select("date", "ticker", "article_count", r6("forward_return_1d").alias("forward_return_1d"))


def aspect_daily(spark: SparkSession, sf_dir: str, mapped: bool) -> DataFrame:
    """Scores per day, ticker and aspect (the article's category), by trading or by calendar day."""
    rows = mapped_scores(spark, sf_dir) if mapped else dated_scores(spark, sf_dir).withColumn("trading_date", F.col("article_date"))
    rows = rows.join(base.articles(spark, sf_dir, "category").withColumn("aspect", F.coalesce("category", F.lit("unknown"))), "article_id").where("trading_date is not null")
    is_ = lambda x: F.sum(F.when(F.col("final_sentiment") == x, 1).otherwise(0)).alias(f"{x}_count")
    return rows.groupBy(F.col("trading_date").alias("date"), "ticker", "aspect").agg(r6(weighted_score()).alias("aspect_sentiment_score"), r6(F.avg("confidence")).alias("avg_confidence"), F.count("*").alias("sample_count"), is_("positive"), is_("neutral"), is_("negative"))


def agg_03_aspect_trading_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aspect_daily(spark, sf_dir, True)


def agg_04_aspect_calendar_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aspect_daily(spark, sf_dir, False)


def jon_02_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored mentions with their article and company."""
    arts = base.articles(spark, sf_dir, "title", "url", "category", "published_at")
    rows = base.scores(spark, sf_dir).join(arts, "article_id").join(base.master(spark, sf_dir), "ticker", "left")
    return rows.select("article_id", "ticker", "title", "url", "category", "company_name", "sector", F.date_format(F.from_utc_timestamp("published_at", base.LOCAL), "yyyy-MM-dd HH:mm:ss").alias("published_at_vn"), "final_sentiment", r6("sentiment_score").alias("sentiment_score"))


def win_13_leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean log return of all other tickers of the day; null where the own one is null or alone."""
    rows = price_features(base.prices(spark, sf_dir)).select("ticker", "date", "log_return")
    day = rows.groupBy("date").agg(F.sum("log_return").alias("_sum"), F.count("log_return").alias("_n"))
    others = F.when(F.col("_n") > 1, (F.col("_sum") - F.col("log_return")) / (F.col("_n") - 1))
    return rows.join(day, "date").select("ticker", "date", r6(others).alias("market_log_return"))


_INDEX = f"""{base.PRICES}, {base.ARTICLES}, {base.SCORES},
dated as (select s.*, {base.sql_local_date("a.published_at")} as article_date from scores s join arts a using (article_id) where a.published_at is not null),
mapped as (select d.*, (select min(p.date) from prices p where p.ticker = d.ticker and p.date >= d.article_date) as trading_date from dated d),
idx as (select trading_date as date, m.ticker, t.sector, avg(sentiment_score * coalesce(confidence, 1.0)) as sentiment_index, count(*) as article_count,
  sum(positive_count)::bigint as positive_count, sum(neutral_count)::bigint as neutral_count, sum(negative_count)::bigint as negative_count, avg(confidence) as avg_confidence
  from mapped m left join ticker_master t on t.ticker = m.ticker where trading_date is not null group by all)"""
_LABEL = f"case when {base.sql_r6('{0}')} > 0.25 then 'positive' when {base.sql_r6('{0}')} < -0.25 then 'negative' else 'neutral' end"
_STEPS = """steps as (select *, case when close > 0 and lag(close) over w > 0 then ln(close / lag(close) over w) end as log_return,
  case when volume > 0 and lag(volume) over w > 0 then ln(volume / lag(volume) over w) end as volume_growth,
  close / nullif(lag(close, 1) over w, 0) - 1 as return_1d, close / nullif(lag(close, 3) over w, 0) - 1 as return_3d, close / nullif(lag(close, 5) over w, 0) - 1 as return_5d,
  lead(close, 1) over w / nullif(close, 0) - 1 as forward_return_1d, lead(close, 3) over w / nullif(close, 0) - 1 as forward_return_3d, lead(close, 5) over w / nullif(close, 0) - 1 as forward_return_5d
  from prices window w as (partition by ticker order by date)),
feats as (select *, volume / nullif(avg(volume) over f, 0) as volume_change_5d, stddev_samp(log_return) over f as volatility_5d,
  case when count(volume) over f >= 2 then volume / nullif(avg(volume) over f, 0) - 1 end as volume_change_simple, stddev_samp(return_1d) over f as volatility_simple,
  case when high > low then (2 * close - low - high) / (high - low) else 0.0 end as clv
  from steps window f as (partition by ticker order by date rows between 4 preceding and current row))"""
_FEATS = f"with {base.PRICES}, {_STEPS}"
PANEL_SQL = f"""{_INDEX}, {_STEPS}, panel as (select i.date, i.ticker, i.sector, i.sentiment_index as sentiment_score, i.article_count as news_count, i.positive_count, i.neutral_count, i.negative_count, i.avg_confidence,
  {_LABEL.format("i.sentiment_index")} as final_sentiment, f.close, f.volume, f.log_return, f.volume_growth, f.clv, f.return_1d, f.return_3d, f.return_5d, f.forward_return_1d, f.forward_return_3d, f.forward_return_5d, f.volume_change_5d, f.volatility_5d,
  cast(coalesce(f.forward_return_1d > 0, false) as int) as target_up from idx i join feats f on f.ticker = i.ticker and f.date = i.date)"""


def _sql_features(names: dict[str, str]) -> str:
    return f"{_FEATS} select ticker, date, " + ", ".join(f"{base.sql_r6(v)} as {k}" for k, v in names.items()) + " from feats"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


_ASPECT = """, rows as (select m.*, coalesce(a.category, 'unknown') as aspect from {0} m join arts a using (article_id))
select {1} as date, ticker, aspect, {2} as aspect_sentiment_score, {3} as avg_confidence, count(*) as sample_count,
  sum(case when final_sentiment = 'positive' then 1 else 0 end)::bigint as positive_count, sum(case when final_sentiment = 'neutral' then 1 else 0 end)::bigint as neutral_count, sum(case when final_sentiment = 'negative' then 1 else 0 end)::bigint as negative_count
from rows where {1} is not null group by all"""



def _aspect(rows: str, day: str) -> str:
    return _ASPECT.format(rows, day, base.sql_r6("avg(sentiment_score * coalesce(confidence, 1.0))"), base.sql_r6("avg(confidence)"))


SQL = {
    "agg_01_article_ticker": f"""with s as (select article_id, ticker, avg(sentiment_score * coalesce(confidence, 1.0)) as score, avg(confidence) as confidence, count(*) as aspect_count,
  sum(case when final_sentiment = 'positive' then 1 else 0 end)::bigint as positive_count, sum(case when final_sentiment = 'neutral' then 1 else 0 end)::bigint as neutral_count, sum(case when final_sentiment = 'negative' then 1 else 0 end)::bigint as negative_count
  from article_ticker_sentiment where article_id in (select article_id from articles) group by all)
select article_id, ticker, {base.sql_r6("score")} as sentiment_score, {_LABEL.format("score")} as final_sentiment, {base.sql_r6("confidence")} as confidence, aspect_count, positive_count, neutral_count, negative_count from s""",
    "jon_09_next_trading_day": f"with {_INDEX} select article_id, ticker, article_date, trading_date from mapped",
    "agg_02_daily_index": f"with {_INDEX} select date, ticker, sector, {base.sql_r6('sentiment_index')} as sentiment_index, {_LABEL.format('sentiment_index')} as final_sentiment, article_count, positive_count, neutral_count, negative_count, {base.sql_r6('avg_confidence')} as avg_confidence from idx",
    "jon_03_sector_join": f"with {base.SCORES} select s.article_id, s.ticker, t.sector from scores s left join ticker_master t on t.ticker = s.ticker",
    "win_01_trailing_returns": _sql_features(_same("return_1d", "return_3d", "return_5d")),
    "win_02_forward_returns": _sql_features(_same("forward_return_1d", "forward_return_3d", "forward_return_5d")),
    "win_03_volume_ratio": _sql_features(_same("volume_change_5d")),
    "win_04_volume_change_simple": _sql_features({"volume_change_5d": "volume_change_simple"}),
    "win_05_volatility": _sql_features(_same("volatility_5d")),
    "win_05_volatility_simple": _sql_features({"volatility_5d": "volatility_simple"}),
    "win_06_log_growth_clv": _sql_features(_same("log_return", "volume_growth", "clv")),
    "prj_01_panel": f"with {PANEL_SQL} select date, ticker, sector, {base.sql_r6('sentiment_score')} as sentiment_score, news_count, positive_count, neutral_count, negative_count, final_sentiment, {base.sql_r6('close')} as close, volume, " + ", ".join(f"{base.sql_r6(n)} as {n}" for n in FEATURES) + ", target_up from panel",
    "jon_01_index_features": f"with {_INDEX}, kept as (select date, ticker, forward_return_1d from (select *, row_number() over (partition by date, ticker order by created_at desc nulls last, forward_return_1d desc nulls last) as rn from market_features) where rn = 1) select i.date, i.ticker, i.article_count, {base.sql_r6('k.forward_return_1d')} as forward_return_1d from idx i join kept k on k.date = i.date and k.ticker = i.ticker",
    "agg_03_aspect_trading_day": f"with {_INDEX}" + _aspect("mapped", "trading_date"),
    "agg_04_aspect_calendar_day": f"with {_INDEX}" + _aspect("dated", "article_date"),
    "jon_02_evidence": f"with {base.ARTICLES}, {base.SCORES} select s.article_id, s.ticker, a.title, a.url, a.category, t.company_name, t.sector, strftime(make_timestamp(epoch_us(a.published_at) + 25200000000), '%Y-%m-%d %H:%M:%S') as published_at_vn, s.final_sentiment, {base.sql_r6('s.sentiment_score')} as sentiment_score from scores s join arts a using (article_id) left join ticker_master t on t.ticker = s.ticker",
    "win_13_leave_one_out": f"{_FEATS} select ticker, date, {base.sql_r6("case when count(log_return) over d > 1 then (sum(log_return) over d - log_return) / (count(log_return) over d - 1) end")} as market_log_return from feats window d as (partition by date)",
}
QUERIES = {
    "win_01_trailing_returns": _features(["return_1d", "return_3d", "return_5d"]),
    "win_02_forward_returns": _features(["forward_return_1d", "forward_return_3d", "forward_return_5d"]),
    "win_03_volume_ratio": _features(["volume_change_5d"]),
    "win_04_volume_change_simple": _features(["volume_change_5d"], "simple"),
    "win_05_volatility": _features(["volatility_5d"]),
    "win_05_volatility_simple": _features(["volatility_5d"], "simple"),
    "win_06_log_growth_clv": _features(["log_return", "volume_growth", "clv"]),
} | {f.__name__: f for f in (agg_01_article_ticker, jon_09_next_trading_day, agg_02_daily_index, jon_03_sector_join, prj_01_panel, jon_01_index_features, agg_03_aspect_trading_day, agg_04_aspect_calendar_day, jon_02_evidence, win_13_leave_one_out)}
