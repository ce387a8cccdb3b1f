"""Queries of sources, sinks and incremental rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import last_per_key, pending, raw_only, rebuild, upsert, without_nan
from ..session import table
from ..sources.files import build_master, normalize_prices
from ..sources.pages import parse_articles, parse_links
from ..streaming.live import live_counts, run_to_memory
from . import base
from .base import r6, sql_r6
from .panel import _INDEX, daily_index

ARTICLE = ["article_id", "url", "title", "category", "status"]


def snk_01_upsert_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First crawls, updated by the last ones; a status is taken over only while it is raw."""
    rows = table(spark, sf_dir, "articles").dropna(subset=["article_id"]).withColumn("_us", F.unix_micros("crawl_at"))
    stamps = ["_us", "status"]
    first = last_per_key(rows, ["article_id"], F.asc_nulls_first("_us"), F.asc("status")).select(*ARTICLE)
    last = last_per_key(rows, ["article_id"], *[F.desc_nulls_last(s) for s in stamps]).select(*ARTICLE)
    return upsert(first, last, ["article_id"], {"status": raw_only}).select("article_id", "status", "category")


def snk_03_last_statement_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ticker_aliases").dropna(subset=["ticker", "alias_type"])
    return last_per_key(rows, ["ticker", "alias_type"], F.asc(F.length("alias")), F.desc("id")).select("ticker", "alias_type", "alias", "id")


def snk_06_upsert_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of feed_a, updated by those of the other feeds."""
    rows = table(spark, sf_dir, "market_prices").dropna(subset=["ticker", "date"])
    key, order = ["ticker", "date"], [F.desc_nulls_last("updated_at"), F.desc_nulls_last("close"), F.desc_nulls_last("volume")]
    cols = ["ticker", "date", "close", "volume", "source"]
    old = last_per_key(rows.where("source = 'feed_a'"), key, *order).select(*cols)
    new = last_per_key(rows.where("source <> 'feed_a'"), key, *order).select(*cols)
    return upsert(old, new, key)


def snk_11_rebuild_range(spark: SparkSession, sf_dir: str, start: str = "2025-10-01") -> DataFrame:
    """The index with the days from ``start`` on made anew, the days before untouched."""
    idx = daily_index(spark, sf_dir).select("date", "ticker", "article_count")
    return rebuild(idx.withColumn("article_count", F.lit(-1).cast("bigint")), idx, "date", start)


def snk_12_update_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status by whether an article has scores; others keep theirs."""
    scored = table(spark, sf_dir, "article_ticker_sentiment").select("article_id").distinct().withColumn("new", F.lit("relevant"))
    return base.articles(spark, sf_dir, "status").join(scored, "article_id", "left").select("article_id", F.coalesce("new", "status").alias("status"))


def snk_18_nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("volume") == 0, F.lit(float("nan"))).when(F.col("volume") < 0, F.lit(float("inf"))).otherwise(F.col("close"))
    rows = base.prices(spark, sf_dir).select("ticker", "date", odd.alias("level"))
    return without_nan(rows)


def inc_01_buffered_articles(spark: SparkSession, sf_dir: str, start: str = "2025-10-01", days: int = 7) -> DataFrame:
    """Articles that may map to a trading day from ``start`` on."""
    rows = base.articles(spark, sf_dir, "published_at").withColumn("day", base.local_date("published_at"))
    return rows.where(F.col("day") >= F.date_sub(F.lit(start).cast("date"), days)).select("article_id", "day")


def inc_02_buffered_prices(spark: SparkSession, sf_dir: str, start: str = "2025-10-01") -> DataFrame:
    """Forward returns from ``start`` on and of the five rows before, whose outcome the new rows change."""
    from ..operators.features import price_features

    rows = price_features(base.prices(spark, sf_dir).where(F.col("date") >= F.date_sub(F.lit(start).cast("date"), 30)))
    marked = rows.withColumn("left", F.count(F.when(F.col("date") < start, 1)).over(_after()))
    return marked.where((F.col("date") >= start) | (F.col("left") <= 5)).select("ticker", "date", r6("forward_return_5d").alias("forward_return_5d"))


def _after():
    from pyspark.sql import Window

    return Window.partitionBy("ticker").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, 0)


def inc_03_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending(base.articles(spark, sf_dir, "status").where("status = 'raw'"), table(spark, sf_dir, "article_ticker_sentiment"), ["article_id"]).select("article_id")


def nrm_01_normalize_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows with other headers and text values, brought to plain ones."""
    rows = table(spark, sf_dir, "market_prices").select(F.date_format("date", "yyyy-MM-dd").alias("TradingDate"), F.concat(F.lit(" "), F.lower("ticker")).alias("Ticker"), *[F.coalesce(F.col(c).cast("string"), F.lit("n/a")).alias(c) for c in ("Open", "High", "Low", "Close")], F.col("volume").cast("string").alias("Vol"), "source", F.unix_micros("updated_at").alias("_seq"))
    return normalize_prices(rows).select("ticker", "date", "close", "volume")


def src_03_prices_since(spark: SparkSession, sf_dir: str, since: str = "2025-09-01") -> DataFrame:
    return table(spark, sf_dir, "market_prices").where(F.col("date") >= since).select("ticker", "date", "close", "updated_at").select("ticker", "date", "close", F.unix_micros("updated_at").alias("updated_us")).orderBy("ticker", "date")


def src_05_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ticker_aliases").select("ticker", "alias", "weight", "id").orderBy("ticker", F.desc("weight"), "id")


def src_06_relevant_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.articles(spark, sf_dir, "status", "published_at").where("status = 'relevant'").select("article_id", F.unix_micros("published_at").alias("published_us")).orderBy(F.desc_nulls_last("published_us"), "article_id").limit(500)


def src_12_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with alternative columns, some blank, as a ticker master."""
    rows = table(spark, sf_dir, "ticker_master").select(F.lower("ticker").alias("symbol"), F.when(F.col("is_active"), F.col("company_name")).otherwise("  ").alias("organ_name"), F.col("company_name").alias("name"), F.col("sector").alias("icb_name2"))
    return build_master(rows).select("ticker", "company_name", "sector")


def src_26_ticker_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers of the index, or of the master where there is no index."""
    idx = daily_index(spark, sf_dir).select("ticker").distinct()
    return idx if idx.take(1) else base.master(spark, sf_dir).select("ticker").distinct()


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base.articles(spark, sf_dir, "url", "title", "sapo", "content").where("url is not null")
    esc = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.regexp_replace(esc("content"), "\n", "</p><p>")
    html = F.concat(F.lit("<html><head><script>var a = '<h1>no</h1>';</script></head><body><div class='ads'><h1>Ad</h1></div><h1>"), esc("title"), F.lit("</h1><h2 class='sapo'>"), esc("sapo"), F.lit("</h2><div class='detail-content'><p>"), body, F.lit("</p><div class='share'>x</div></div><a href='/a-123.html#top' title='Another article of the day'>go</a></body></html>"))
    return rows.select("article_id", "url", html.alias("html"))


def src_17_article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_articles(_pages(spark, sf_dir)).select("url", "title", F.length("content").alias("n_chars"))


def src_16_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_links(_pages(spark, sf_dir))


def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, counted by a stream over the table's files."""
    kind = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(kind).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = run_to_memory(live_counts(rows), f"events_{uuid.uuid4().hex}")
    return out.select(F.unix_micros("start").alias("start_us"), "event_type", "n", r6("total").alias("total"))


SQL = {
    "snk_01_upsert_articles": "with f as (select *, row_number() over (partition by article_id order by crawl_at nulls first, status) as a, row_number() over (partition by article_id order by crawl_at desc nulls last, status desc) as b from articles where article_id is not null) select x.article_id, case when x.status = 'raw' then y.status else x.status end as status, y.category from f x join f y using (article_id) where x.a = 1 and y.b = 1",
    "snk_03_last_statement_wins": "select ticker, alias_type, alias, id from (select *, row_number() over (partition by ticker, alias_type order by length(alias), id desc) as k from ticker_aliases where ticker is not null and alias_type is not null) where k = 1",
    "snk_06_upsert_prices": "with r as (select *, source = 'feed_a' as a, row_number() over (partition by ticker, date, source = 'feed_a' order by updated_at desc nulls last, close desc nulls last, volume desc nulls last) as k from market_prices where ticker is not null and date is not null and source is not null), l as (select *, row_number() over (partition by ticker, date order by a) as p from r where k = 1) select ticker, date, close, volume, source from l where p = 1",
    "snk_11_rebuild_range": f"with {_INDEX} select date, ticker, case when date < date '2025-10-01' then -1 else article_count end as article_count from idx",
    "snk_12_update_status": f"with {base.ARTICLES} select article_id, case when article_id in (select article_id from article_ticker_sentiment) then 'relevant' else status end as status from arts",
    "snk_18_nan_to_null": f"with {base.PRICES} select ticker, date, case when volume <= 0 then null else close end as level from prices",
    "inc_01_buffered_articles": f"with {base.ARTICLES}, d as (select article_id, {base.sql_local_date('published_at')} as day from arts) select article_id, day from d where day >= date '2025-09-24'",
    "inc_02_buffered_prices": f"with {base.PRICES}, p as (select * from prices where date >= date '2025-09-01'), r as (select ticker, date, lead(close, 5) over w / nullif(close, 0) - 1 as f, count(*) filter (date < date '2025-10-01') over (partition by ticker order by date desc rows between unbounded preceding and current row) as k from p window w as (partition by ticker order by date)) select ticker, date, {sql_r6('f')} as forward_return_5d from r where date >= date '2025-10-01' or k <= 5",
    "inc_03_pending": f"with {base.ARTICLES} select article_id from arts where status = 'raw' and article_id not in (select article_id from article_ticker_sentiment)",
    "nrm_01_normalize_prices": "select upper(ticker) as ticker, date, close, volume from (select *, row_number() over (partition by ticker, date order by updated_at desc nulls last, close desc nulls last, volume desc nulls last) as k from market_prices where ticker is not null and date is not null and close is not null) where k = 1",
    "src_03_prices_since": "select ticker, date, close, epoch_us(updated_at) as updated_us from market_prices where date >= date '2025-09-01' order by ticker, date",
    "src_05_aliases": "select ticker, alias, weight, id from ticker_aliases order by ticker, weight desc, id",
    "src_06_relevant_articles": f"with {base.ARTICLES} select article_id, epoch_us(published_at) as published_us from arts where status = 'relevant' order by published_us desc nulls last, article_id limit 500",
    "src_12_master": "select ticker, company_name, sector from ticker_master",
    "src_26_ticker_list": f"with {_INDEX} select distinct ticker from idx",
    "stream_event_counts": f"select (epoch_us(ts) // 3600000000) * 3600000000 as start_us, event_type, count(*) as n, {sql_r6('sum(value)')} as total from events group by 1, 2",
}
QUERIES = {name: f for name, f in list(globals().items()) if name in SQL} | {"src_17_article_pages": src_17_article_pages, "src_16_page_links": src_16_page_links}
