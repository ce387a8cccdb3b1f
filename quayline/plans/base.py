"""Cleaned views of the input tables, as DataFrames and as SQL.

Superseded and re-crawled rows are resolved the same way on both sides: the latest row by the stamp
named, then the largest by the columns that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rolling import latest
from ..session import table

LOCAL = "Asia/Ho_Chi_Minh"
OFF_TIE = 3.1e-10
PRICE = ["close", "volume", "open", "high", "low"]


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept daily rows with a close."""
    rows = table(spark, sf_dir, "market_prices").select("ticker", "date", "updated_at", *PRICE)
    return latest(rows, ["ticker", "date"], "updated_at", PRICE).where("close is not null")


def bars(spark: SparkSession, sf_dir: str, interval: str | None = None) -> DataFrame:
    """Kept intraday bars with a close, of one interval or all."""
    rows = table(spark, sf_dir, "intraday_prices").select("ticker", "interval", "ts", "created_at", *PRICE)
    if interval:
        rows = rows.where(F.col("interval") == interval)
    return latest(rows, ["ticker", "interval", "ts"], "created_at", PRICE).where("close is not null")


def articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The latest crawl of each article."""
    rows = table(spark, sf_dir, "articles")
    wanted = [c for c in columns if c != "crawl_at"]
    return latest(rows, ["article_id"], "crawl_at", ["updated_at", "status", *[c for c in wanted if c not in ("updated_at", "status")]]).select("article_id", *wanted) if "crawl_at" not in columns else _with_stamp(rows, wanted)


def _with_stamp(rows: DataFrame, wanted: list[str]) -> DataFrame:
    rest = [c for c in wanted if c not in ("updated_at", "status")]
    kept = rows.dropna(subset=["article_id"]).groupBy("article_id").agg(F.max(F.struct("crawl_at", "updated_at", "status", *rest)).alias("r"))
    return kept.select("article_id", "r.crawl_at", *[F.col("r")[c].alias(c) for c in wanted])


SCORE = ["sentiment_score", "final_sentiment", "confidence", "aspect_count", "positive_count", "neutral_count", "negative_count"]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest score of each (article, ticker)."""
    rows = table(spark, sf_dir, "article_ticker_sentiment")
    return latest(rows, ["article_id", "ticker"], "updated_at", SCORE)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ticker_master").select("ticker", "company_name", "sector", "is_active")


def local_date(stamp: str | Column) -> Column:
    return F.to_date(F.from_utc_timestamp(stamp, LOCAL))


def r6(value: str | Column) -> Column:
    """Six decimals, without negative zero; products of decimals that lie half-way are moved off the tie."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value + F.lit(OFF_TIE), 6) + F.lit(0.0)


# The same views in SQL. Local time is UTC+7 all year round.
PRICES = """prices as (select ticker, date, open, high, low, close, volume from (
  select *, row_number() over (partition by ticker, date order by updated_at desc nulls last, close desc nulls last, volume desc nulls last, open desc nulls last, high desc nulls last, low desc nulls last) as rn
  from market_prices where ticker is not null and date is not null) where rn = 1 and close is not null)"""
BARS = """bars as (select ticker, "interval", epoch_us(ts) as us, open, high, low, close, volume from (
  select *, row_number() over (partition by ticker, "interval", ts order by created_at desc nulls last, close desc nulls last, volume desc nulls last, open desc nulls last, high desc nulls last, low desc nulls last) as rn
  from intraday_prices where ticker is not null and "interval" is not null and ts is not null) where rn = 1 and close is not null)"""
ARTICLES = """arts as (select * from (
  select *, row_number() over (partition by article_id order by crawl_at desc nulls last, updated_at desc nulls last, status desc nulls last) as rn
  from articles where article_id is not null) where rn = 1)"""
SCORES = """scores as (select * from (
  select *, row_number() over (partition by article_id, ticker order by updated_at desc nulls last, sentiment_score desc nulls last, final_sentiment desc nulls last, confidence desc nulls last) as rn
  from article_ticker_sentiment where article_id is not null and ticker is not null) where rn = 1)"""


def sql_local_date(stamp: str) -> str:
    return f"cast(make_timestamp(epoch_us({stamp}) + 25200000000) as date)"


def sql_r6(value: str) -> str:
    return f"round({value} + {OFF_TIE:.11f}, 6) + 0.0"
