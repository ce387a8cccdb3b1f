"""Reports over the panel and the tables: group statistics, correlations, coverage, quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import safe_corr
from ..operators.rolling import latest
from ..session import table
from . import base
from .base import r6, sql_r6
from .panel import _INDEX, PANEL_SQL, aspect_daily, daily_index, panel

TARGETS = ["forward_return_1d", "forward_return_3d", "forward_return_5d"]
_P = f"with {PANEL_SQL}"


def agg_05_group_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = [r6(F.avg(c)).alias(f"mean_{c}") for c in ("sentiment_score", "avg_confidence", *TARGETS)]
    medians = [r6(F.median(c)).alias(f"median_{c}") for c in TARGETS]
    return panel(spark, sf_dir).groupBy("final_sentiment").agg(F.count("*").alias("n"), *means, *medians)


def _unpivoted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.unpivot([*keys, "sentiment_score"], TARGETS, "target", "value").where("sentiment_score is not null and value is not null")


def _correlation(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    return _unpivoted(df, keys).groupBy(*keys, "target").agg(r6(safe_corr("sentiment_score", "value", least)).alias("correlation"), F.count("*").alias("n")).withColumn("note", F.when(F.col("correlation").isNull(), "insufficient_data").otherwise("ok"))


def agg_07_overall_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _correlation(panel(spark, sf_dir), [], 3)


def agg_08_sector_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _correlation(panel(spark, sf_dir).withColumn("sector", F.coalesce("sector", F.lit("UNKNOWN"))), ["sector"], 3)


def agg_09_ticker_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _correlation(panel(spark, sf_dir), ["ticker"], 5)


def agg_10_aspect_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.features import price_features

    rows = aspect_daily(spark, sf_dir, True).join(price_features(base.prices(spark, sf_dir)), ["date", "ticker"]).withColumnRenamed("aspect_sentiment_score", "sentiment_score")
    return _correlation(rows, ["aspect"], 3)


def agg_11_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of rows whose return has the sign of the label; neutral rows and null returns left out."""
    rows = panel(spark, sf_dir).unpivot(["final_sentiment"], TARGETS, "target", "value").where("final_sentiment <> 'neutral' and value is not null")
    hit = F.when((F.col("final_sentiment") == "positive") & (F.col("value") > 0), 1.0).when((F.col("final_sentiment") == "negative") & (F.col("value") < 0), 1.0).otherwise(0.0)
    return rows.groupBy("target").agg(r6(F.avg(hit)).alias("hit_rate"), F.count("*").alias("n")).withColumn("note", F.when(F.col("n") < 10, "small_sample").otherwise("ok"))


def agg_12_price_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.prices(spark, sf_dir).groupBy("ticker").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n"))


def agg_13_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily_index(spark, sf_dir).select("date", "ticker", "article_count").join(base.prices(spark, sf_dir).select("date", "ticker"), ["date", "ticker"])
    return rows.groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("article_count").alias("articles")).orderBy(F.desc("n"), "ticker")


def agg_14_sentiment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).groupBy("ticker").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("days"), r6(F.avg("sentiment_index")).alias("mean_index"), F.sum("article_count").alias("articles"))


def agg_15_sector_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).groupBy("sector", "date").agg(r6(F.avg("sentiment_index")).alias("mean_index"), F.sum("article_count").alias("articles"), F.countDistinct("ticker").alias("tickers"))


def agg_16_label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = "forward_return_3d"
    return panel(spark, sf_dir).groupBy("final_sentiment").agg(F.count(x).alias("n"), r6(F.avg(x)).alias("mean"), r6(F.median(x)).alias("median"), r6(F.stddev_samp(x)).alias("std"))


def agg_17_day_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).groupBy("date").agg(r6(F.avg("sentiment_index")).alias("mean_index"), F.sum("article_count").alias("articles"), F.countDistinct("ticker").alias("tickers"))


def agg_18_aspect_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.scores(spark, sf_dir).join(base.articles(spark, sf_dir, "category"), "article_id").groupBy("category", "final_sentiment").agg(F.count("*").alias("n"))


def agg_19_latest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = daily_index(spark, sf_dir)
    last = idx.agg(F.max("date").alias("date"))
    n = lambda x: F.sum(F.when(F.col("final_sentiment") == x, 1).otherwise(0)).alias(x)
    return idx.join(last, "date").groupBy("date").agg(F.countDistinct("ticker").alias("tickers"), n("positive"), n("neutral"), n("negative"), r6(F.avg("sentiment_index")).alias("mean_index"), F.sum("article_count").alias("articles"))


def agg_20_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "market_prices").agg(F.max("date").alias("last_date"), F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"))


def agg_21_distinct_over_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base.scores(spark, sf_dir).join(base.articles(spark, sf_dir, "category"), "article_id").join(base.master(spark, sf_dir).where("is_active"), "ticker")
    return rows.agg(F.countDistinct("article_id").alias("articles"), F.countDistinct("ticker").alias("tickers"), F.countDistinct("category", "ticker").alias("category_tickers"))


def agg_22_ticker_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.scores(spark, sf_dir).groupBy("article_id").agg(F.array_join(F.array_sort(F.collect_set("ticker")), ", ").alias("tickers"))


def agg_23_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "article_ticker_sentiment").select("ticker").distinct()


def agg_24_dominant_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most confident score of each article, unknown confidence first."""
    w = Window.partitionBy("article_id").orderBy(F.desc_nulls_first("confidence"), "ticker")
    return base.scores(spark, sf_dir).withColumn("rn", F.row_number().over(w)).where("rn = 1").select("article_id", "ticker", "final_sentiment", "confidence")


def agg_28_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["articles", "article_ticker_sentiment", "market_prices", "market_features", "intraday_prices", "ticker_aliases"]
    return reduce(DataFrame.unionByName, [table(spark, sf_dir, n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("object_name"), "row_count") for n in names])


def agg_29_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by category and status, short contents and repeated content hashes, in long form."""
    rows = table(spark, sf_dir, "articles").select("category", "status", "content", "content_hash")
    by = lambda c: rows.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(c).alias("check"), "value", "n")
    short = rows.where(F.length(F.coalesce("content", F.lit(""))) < 300).agg(F.count("*").alias("n"))
    repeated = rows.agg((F.count("content_hash") - F.countDistinct("content_hash")).alias("n"))
    single = lambda df, name: df.select(F.lit(name).alias("check"), F.lit(None).cast("string").alias("value"), "n")
    return by("category").unionByName(by("status")).unionByName(single(short, "short_content")).unionByName(single(repeated, "repeated_hash"))


def agg_30_top_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "articles").select(F.explode("detected_tickers").alias("ticker"))
    return rows.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(20)


def agg_31_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("content")
    return table(spark, sf_dir, "articles").agg(F.count("content").alias("count"), r6(F.avg(n)).alias("mean"), r6(F.stddev_samp(n)).alias("std"), F.min(n).cast("bigint").alias("min"), r6(F.percentile(n, 0.25)).alias("p25"), r6(F.percentile(n, 0.5)).alias("p50"), r6(F.percentile(n, 0.75)).alias("p75"), F.max(n).cast("bigint").alias("max"))


def agg_35_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel(spark, sf_dir).groupBy("ticker").pivot("final_sentiment", ["positive", "neutral", "negative"]).agg(F.avg("forward_return_1d"))
    return rows.select("ticker", *[r6(c).alias(c) for c in ("positive", "neutral", "negative")])


def agg_36_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).unpivot(["date", "ticker"], ["positive_count", "neutral_count", "negative_count"], "label", "n")


def agg_39_stratified_sample(spark: SparkSession, sf_dir: str, size: int = 3, seed: int = 7) -> DataFrame:
    """At most ``size`` scored articles a ticker, in an order fixed by the seed; a sampling operator."""
    w = Window.partitionBy("ticker").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("article_id"))), "article_id")
    return base.scores(spark, sf_dir).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= size).select("ticker", "article_id")


def prj_05_score_group(spark: SparkSession, sf_dir: str, threshold: float = 0.1) -> DataFrame:
    s = F.col("sentiment_score")
    group = F.when(s.isNull(), "NO_NEWS").when(s > threshold, "POS").when(s < -threshold, "NEG").otherwise("NEU")
    return base.scores(spark, sf_dir).select("article_id", "ticker", group.alias("score_group"))


def prj_07_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, f = F.col("final_sentiment"), F.col("forward_return_1d")
    out = F.when((label == "positive") & (f > 0), "hit_positive").when((label == "negative") & (f < 0), "hit_negative").when((label == "positive") & (f < 0), "miss_positive").when((label == "negative") & (f > 0), "miss_negative").otherwise("neutral_or_ignored")
    return panel(spark, sf_dir).select("date", "ticker", out.alias("direction_result"))


def prj_08_sentiment_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("sentiment_score")
    return base.scores(spark, sf_dir).select("article_id", "ticker", F.when(s.isNotNull(), (s > 0.1).cast("int")).alias("up_or_null"), F.coalesce((s > 0.1).cast("int"), F.lit(0)).alias("up_or_zero"))


def prj_11_normalised_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label counts as probabilities that add up to 1, and the label with the largest one."""
    n = ["negative_count", "neutral_count", "positive_count"]
    total = F.col(n[0]) + F.col(n[1]) + F.col(n[2])
    p = [F.round(F.coalesce(F.try_divide(F.col(c).cast("double"), total), F.lit(0.0)), 4) for c in n]
    top = F.greatest(*[F.col(c) for c in n])
    best = F.when(total == 0, "neutral").when(F.col(n[0]) == top, "negative").when(F.col(n[1]) == top, "neutral").otherwise("positive")
    return base.scores(spark, sf_dir).select("article_id", "ticker", *[x.alias(f"prob_{c[:-6]}") for x, c in zip(p, n)], best.alias("best_label"))


def flt_01_date_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "market_prices").where(F.col("date").between("2025-03-01", "2025-03-31") & F.col("ticker").isin("QVF1M", "AQF7", "SQU3")).select("date", "ticker", "close", "volume", "source")


def flt_04_future_dated(spark: SparkSession, sf_dir: str, as_of: str = "2025-10-01") -> DataFrame:
    """The 100 articles published furthest after a week from ``as_of``."""
    rows = base.articles(spark, sf_dir, "published_at").where(F.unix_micros("published_at") > F.unix_micros(F.lit(as_of).cast("timestamp")) + 7 * 86_400_000_000)
    return rows.select("article_id", F.unix_micros("published_at").alias("published_us")).orderBy(F.desc("published_us"), "article_id").limit(100)


def flt_05_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_index(spark, sf_dir).where(F.dayofweek("date").isin(1, 7)).select("date", "ticker")


def flt_06_news_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows with the article count of their day, days with news only."""
    rows = base.prices(spark, sf_dir).select("date", "ticker").join(daily_index(spark, sf_dir).select("date", "ticker", "article_count"), ["date", "ticker"], "left")
    return rows.where(F.coalesce("article_count", F.lit(0)) > 0)


def ddp_01_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "market_prices").select("ticker", "date", "updated_at", *base.PRICE)
    return latest(rows, ["ticker", "date"], "updated_at", base.PRICE).select("ticker", "date", "close", "volume")


def ddp_02_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("url").orderBy(F.asc_nulls_last("crawl_at"), "article_id")
    return table(spark, sf_dir, "articles").where("url is not null").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("url", "article_id")


def ddp_03_repeated_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "articles").agg((F.count("content_hash") - F.countDistinct("content_hash")).alias("repeated"))


def jon_04_unscored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.articles(spark, sf_dir, "status").join(table(spark, sf_dir, "article_ticker_sentiment").select("article_id"), "article_id", "left_anti").select("article_id", "status")


def jon_05_tickers_without_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.master(spark, sf_dir).join(base.prices(spark, sf_dir).select("ticker"), "ticker", "left_anti").select("ticker", "company_name")


def jon_06_work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores without a confident prediction yet, newest first; the filter on the other side comes before the join."""
    done = table(spark, sf_dir, "article_ticker_sentiment").where("confidence >= 0.7").select("article_id", "ticker")
    queue = base.scores(spark, sf_dir).join(done, ["article_id", "ticker"], "left_anti").join(base.articles(spark, sf_dir, "published_at"), "article_id")
    return queue.select("article_id", "ticker", F.unix_micros("published_at").alias("published_us")).orderBy(F.desc_nulls_last("published_us"), "article_id", "ticker").limit(200)


def jon_07_in_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = base.master(spark, sf_dir).where("is_active").select("ticker")
    return base.scores(spark, sf_dir).join(active, "ticker", "left_semi").select("article_id", "ticker")


def jon_08_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scores of the articles that mention one ticker."""
    s = base.scores(spark, sf_dir).select("article_id", "ticker", "final_sentiment")
    return s.join(s.where("ticker = 'QVF1M'").select("article_id").distinct(), "article_id")


def jon_11_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = base.prices(spark, sf_dir).where("ticker = 'QVF1M'").select("date", "close")
    mood = daily_index(spark, sf_dir).where("ticker = 'QVF1M'").select("date", r6("sentiment_index").alias("sentiment_index"), "article_count")
    return price.join(mood, "date")


def jon_12_metric_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean forward return of positive less that of negative days, by ticker, in one aggregation."""
    mean = lambda x: F.avg(F.when(F.col("final_sentiment") == x, F.col("forward_return_1d")))
    return panel(spark, sf_dir).groupBy("ticker").agg(r6(mean("positive")).alias("with_positive"), r6(mean("negative")).alias("with_negative"), r6(mean("positive") - mean("negative")).alias("delta"))


def jon_15_id_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels joined to their documents by id; labels of unknown ids are dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "reading_level", "rater", "lang", "n_chars")


def ord_01_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg_08_sector_correlation(spark, sf_dir).orderBy("target", F.desc_nulls_last("correlation"), "sector")


def ord_02_top_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = daily_index(spark, sf_dir)
    day = idx.join(idx.agg(F.max("date").alias("date")), "date").select("ticker", r6("sentiment_index").alias("sentiment_index"))
    pick = lambda side, order: day.orderBy(order, "ticker").limit(10).withColumn("side", F.lit(side))
    return pick("top", F.desc_nulls_last("sentiment_index")).unionByName(pick("bottom", F.asc_nulls_last("sentiment_index")))


def ord_05_page(spark: SparkSession, sf_dir: str, page: int = 2, size: int = 25) -> DataFrame:
    """One page of the newest articles, with the number of pages."""
    arts = base.articles(spark, sf_dir, "published_at", "category")
    pages = arts.agg(F.ceil(F.count("*") / size).alias("pages"))
    rows = arts.select("article_id", "category", F.unix_micros("published_at").alias("published_us")).orderBy(F.desc_nulls_last("published_us"), "article_id").offset((page - 1) * size).limit(size)
    return rows.withColumn("pages", pages.scalar())


def ord_09_top_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).where("final_sentiment <> 'neutral' and forward_return_5d is not null").select("date", "ticker", "final_sentiment", r6("forward_return_5d").alias("forward_return_5d")).orderBy(F.desc("forward_return_5d"), "ticker", "date").limit(100)


def set_01_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ticker_master").select("ticker").unionByName(table(spark, sf_dir, "market_prices").select("ticker"))


def set_03_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids expected but missing, and ids that nobody asked for."""
    want, have = table(spark, sf_dir, "articles").select("article_id"), table(spark, sf_dir, "article_ticker_sentiment").select("article_id")
    return want.subtract(have).withColumn("side", F.lit("missing")).unionByName(have.subtract(want).withColumn("side", F.lit("unexpected")))


def set_04_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.array(*[F.lit(x) for x in ("QVF1M", "AQF7", "SQU3", "BRB6")])
    return table(spark, sf_dir, "articles").where(F.arrays_overlap("detected_tickers", chosen)).select("article_id").distinct()


_TARGET_ROWS = "unnest(['forward_return_1d', 'forward_return_3d', 'forward_return_5d']) as target, unnest([forward_return_1d, forward_return_3d, forward_return_5d]) as value"


def _sql_corr(source: str, keys: str, least: int) -> str:
    k = f"{keys}, " if keys else ""
    corr = sql_r6(f"case when count(*) >= {least} and min(s) < max(s) and min(value) < max(value) then corr(s, value) end")
    return f"""select *, case when correlation is null then 'insufficient_data' else 'ok' end as note from (select {k}target, {corr} as correlation, count(*) as n
from (select {k}sentiment_score as s, {_TARGET_ROWS} from {source}) where s is not null and value is not null group by {k}target)"""


def _avg(x: str) -> str:
    return sql_r6(f"avg({x})")


_SECTOR = f"{_P}, named as (select * replace (coalesce(sector, 'UNKNOWN') as sector) from panel) {_sql_corr('named', 'sector', 3)}"
SQL = {
    "agg_05_group_returns": f"{_P} select final_sentiment, count(*) as n, " + ", ".join(f"{_avg(c)} as mean_{c}" for c in ("sentiment_score", "avg_confidence", *TARGETS)) + ", " + ", ".join(f"{sql_r6(f'median({c})')} as median_{c}" for c in TARGETS) + " from panel group by all",
    "agg_07_overall_correlation": f"{_P} {_sql_corr('panel', '', 3)}",
    "agg_08_sector_correlation": _SECTOR,
    "agg_09_ticker_correlation": f"{_P} {_sql_corr('panel', 'ticker', 5)}",
    "agg_10_aspect_correlation": f"{_P}, rows as (select m.*, coalesce(a.category, 'unknown') as aspect from mapped m join arts a using (article_id) where trading_date is not null), daily as (select trading_date as date, ticker, aspect, {sql_r6('avg(sentiment_score * coalesce(confidence, 1.0))')} as sentiment_score from rows group by all), joined as (select d.*, f.forward_return_1d, f.forward_return_3d, f.forward_return_5d from daily d join feats f on f.date = d.date and f.ticker = d.ticker) {_sql_corr('joined', 'aspect', 3)}",
    "agg_11_hit_rate": f"{_P} select *, case when n < 10 then 'small_sample' else 'ok' end as note from (select target, {_avg('case when (final_sentiment = ' + chr(39) + 'positive' + chr(39) + ' and value > 0) or (final_sentiment = ' + chr(39) + 'negative' + chr(39) + ' and value < 0) then 1.0 else 0.0 end')} as hit_rate, count(*) as n from (select final_sentiment, {_TARGET_ROWS} from panel where final_sentiment <> 'neutral') where value is not null group by target)",
    "agg_12_price_coverage": f"with {base.PRICES} select ticker, min(date) as first_date, max(date) as last_date, count(*) as n from prices group by ticker",
    "agg_13_overlap": f"with {_INDEX} select i.ticker, count(*) as n, min(i.date) as first_date, max(i.date) as last_date, sum(article_count)::bigint as articles from idx i join prices p on p.date = i.date and p.ticker = i.ticker group by i.ticker order by n desc, i.ticker",
    "agg_14_sentiment_coverage": f"with {_INDEX} select ticker, min(date) as first_date, max(date) as last_date, count(*) as days, {_avg('sentiment_index')} as mean_index, sum(article_count)::bigint as articles from idx group by ticker",
    "agg_15_sector_day": f"with {_INDEX} select sector, date, {_avg('sentiment_index')} as mean_index, sum(article_count)::bigint as articles, count(distinct ticker) as tickers from idx group by all",
    "agg_16_label_stats": f"{_P} select final_sentiment, count(forward_return_3d) as n, {_avg('forward_return_3d')} as mean, {sql_r6('median(forward_return_3d)')} as median, {sql_r6('stddev_samp(forward_return_3d)')} as std from panel group by all",
    "agg_17_day_means": f"with {_INDEX} select date, {_avg('sentiment_index')} as mean_index, sum(article_count)::bigint as articles, count(distinct ticker) as tickers from idx group by all",
    "agg_18_aspect_label_counts": f"with {base.ARTICLES}, {base.SCORES} select category, final_sentiment, count(*) as n from scores join arts using (article_id) group by all",
    "agg_19_latest_day": f"with {_INDEX}, l as (select *, case when {sql_r6('sentiment_index')} > 0.25 then 'positive' when {sql_r6('sentiment_index')} < -0.25 then 'negative' else 'neutral' end as label from idx where date = (select max(date) from idx)) select date, count(distinct ticker) as tickers, (count(*) filter (label = 'positive')) as positive, (count(*) filter (label = 'neutral')) as neutral, (count(*) filter (label = 'negative')) as negative, {_avg('sentiment_index')} as mean_index, sum(article_count)::bigint as articles from l group by date",
    "agg_20_freshness": "select max(date) as last_date, count(*) as n, count(distinct ticker) as tickers from market_prices",
    "agg_21_distinct_over_join": f"with {base.ARTICLES}, {base.SCORES}, j as (select s.article_id, s.ticker, a.category from scores s join arts a using (article_id) join ticker_master t on t.ticker = s.ticker where t.is_active) select count(distinct article_id) as articles, count(distinct ticker) as tickers, (select count(*) from (select distinct category, ticker from j where category is not null)) as category_tickers from j",
    "agg_22_ticker_lists": f"with {base.SCORES} select article_id, string_agg(distinct ticker, ', ' order by ticker) as tickers from scores group by article_id",
    "agg_23_distinct": "select distinct ticker from article_ticker_sentiment",
    "agg_24_dominant_entity": f"with {base.SCORES} select distinct on (article_id) article_id, ticker, final_sentiment, confidence from scores order by article_id, confidence desc nulls first, ticker",
    "agg_28_row_counts": " union all ".join(f"select '{n}' as object_name, count(*) as row_count from {n}" for n in ("articles", "article_ticker_sentiment", "market_prices", "market_features", "intraday_prices", "ticker_aliases")),
    "agg_29_quality": "select 'category' as \"check\", category as value, count(*) as n from articles group by category union all select 'status', status, count(*) from articles group by status union all select 'short_content', null, count(*) from articles where length(coalesce(content, '')) < 300 union all select 'repeated_hash', null, count(content_hash) - count(distinct content_hash) from articles",
    "agg_30_top_tickers": "select ticker, count(*) as n from (select unnest(detected_tickers) as ticker from articles) group by ticker order by n desc, ticker limit 20",
    "agg_31_describe": f"select count(content) as count, {_avg('length(content)')} as mean, {sql_r6('stddev_samp(length(content))')} as std, min(length(content)) as min, {sql_r6('quantile_cont(length(content), 0.25)')} as p25, {sql_r6('quantile_cont(length(content), 0.5)')} as p50, {sql_r6('quantile_cont(length(content), 0.75)')} as p75, max(length(content)) as max from articles",
    "agg_35_pivot": f"{_P} select ticker, " + ", ".join(f"{_avg('case when final_sentiment = ' + chr(39) + x + chr(39) + ' then forward_return_1d end')} as {x}" for x in ("positive", "neutral", "negative")) + " from panel group by ticker",
    "agg_36_melt": f"with {_INDEX} select date, ticker, unnest(['positive_count', 'neutral_count', 'negative_count']) as label, unnest([positive_count, neutral_count, negative_count]) as n from idx",
    "agg_39_stratified_sample": f"with {base.SCORES} select ticker, article_id from (select *, row_number() over (partition by ticker order by md5('7:' || article_id), article_id) as k from scores) where k <= 3",
    "prj_05_score_group": f"with {base.SCORES} select article_id, ticker, case when sentiment_score is null then 'NO_NEWS' when sentiment_score > 0.1 then 'POS' when sentiment_score < -0.1 then 'NEG' else 'NEU' end as score_group from scores",
    "prj_07_direction": f"{_P} select date, ticker, case when final_sentiment = 'positive' and forward_return_1d > 0 then 'hit_positive' when final_sentiment = 'negative' and forward_return_1d < 0 then 'hit_negative' when final_sentiment = 'positive' and forward_return_1d < 0 then 'miss_positive' when final_sentiment = 'negative' and forward_return_1d > 0 then 'miss_negative' else 'neutral_or_ignored' end as direction_result from panel",
    "prj_08_sentiment_up": f"with {base.SCORES} select article_id, ticker, cast(sentiment_score > 0.1 as int) as up_or_null, coalesce(cast(sentiment_score > 0.1 as int), 0) as up_or_zero from scores",
    "prj_11_normalised_scores": f"with {base.SCORES}, t as (select *, positive_count + neutral_count + negative_count as total, greatest(positive_count, neutral_count, negative_count) as top from scores) select article_id, ticker, " + ", ".join(f"round(coalesce({x}_count::double / nullif(total, 0), 0.0), 4) as prob_{x}" for x in ("negative", "neutral", "positive")) + ", case when total = 0 then 'neutral' when negative_count = top then 'negative' when neutral_count = top then 'neutral' else 'positive' end as best_label from t",
    "flt_01_date_ticker": "select date, ticker, close, volume, source from market_prices where date between date '2025-03-01' and date '2025-03-31' and ticker in ('QVF1M', 'AQF7', 'SQU3')",
    "flt_04_future_dated": f"with {base.ARTICLES} select article_id, epoch_us(published_at) as published_us from arts where epoch_us(published_at) > epoch_us(timestamp '2025-10-08') order by published_us desc, article_id limit 100",
    "flt_05_weekend": f"with {_INDEX} select date, ticker from idx where dayofweek(date) in (0, 6)",
    "flt_06_news_days": f"with {_INDEX} select p.date, p.ticker, i.article_count from prices p join idx i on i.date = p.date and i.ticker = p.ticker where i.article_count > 0",
    "ddp_01_keep_last": f"with {base.PRICES.replace(' and close is not null)', ')')} select ticker, date, close, volume from prices",
    "ddp_02_keep_first": "select url, article_id from (select *, row_number() over (partition by url order by crawl_at nulls last, article_id) as k from articles where url is not null) where k = 1",
    "ddp_03_repeated_hashes": "select count(content_hash) - count(distinct content_hash) as repeated from articles",
    "jon_04_unscored_articles": f"with {base.ARTICLES} select article_id, status from arts a where not exists (select 1 from article_ticker_sentiment s where s.article_id = a.article_id)",
    "jon_05_tickers_without_prices": f"with {base.PRICES} select ticker, company_name from ticker_master t where not exists (select 1 from prices p where p.ticker = t.ticker)",
    "jon_06_work_queue": f"with {base.ARTICLES}, {base.SCORES} select s.article_id, s.ticker, epoch_us(a.published_at) as published_us from scores s join arts a using (article_id) left join (select distinct article_id, ticker from article_ticker_sentiment where confidence >= 0.7) d on d.article_id = s.article_id and d.ticker = s.ticker where d.ticker is null order by published_us desc nulls last, s.article_id, s.ticker limit 200",
    "jon_07_in_subquery": f"with {base.SCORES} select article_id, ticker from scores where ticker in (select ticker from ticker_master where is_active)",
    "jon_08_fan_out": f"with {base.SCORES} select article_id, ticker, final_sentiment from scores where article_id in (select article_id from scores where ticker = 'QVF1M')",
    "jon_11_overlay": f"with {_INDEX} select p.date, p.close, {sql_r6('i.sentiment_index')} as sentiment_index, i.article_count from prices p join idx i on i.date = p.date where p.ticker = 'QVF1M' and i.ticker = 'QVF1M'",
    "jon_12_metric_delta": f"{_P}, m as (select ticker, avg(case when final_sentiment = 'positive' then forward_return_1d end) as a, avg(case when final_sentiment = 'negative' then forward_return_1d end) as b from panel group by ticker) select ticker, {sql_r6('a')} as with_positive, {sql_r6('b')} as with_negative, {sql_r6('a - b')} as delta from m",
    "jon_15_id_lookup": "select l.doc_id, l.reading_level, l.rater, d.lang, d.n_chars from labels l join documents d on d.doc_id = l.doc_id",
    "ord_01_multi_key": _SECTOR + " order by target, correlation desc nulls last, sector",
    "ord_02_top_bottom": f"with {_INDEX}, l as (select ticker, {sql_r6('sentiment_index')} as sentiment_index from idx where date = (select max(date) from idx)) select * from (select *, 'top' as side from l order by sentiment_index desc nulls last, ticker limit 10) union all select * from (select *, 'bottom' as side from l order by sentiment_index nulls last, ticker limit 10)",
    "ord_05_page": f"with {base.ARTICLES} select article_id, category, epoch_us(published_at) as published_us, (select ceil(count(*) / 25)::bigint from arts) as pages from arts order by published_us desc nulls last, article_id limit 25 offset 25",
    "ord_09_top_signals": f"{_P} select date, ticker, final_sentiment, {sql_r6('forward_return_5d')} as f from panel where final_sentiment <> 'neutral' and forward_return_5d is not null order by f desc, ticker, date limit 100".replace(" as f from", " as forward_return_5d from").replace("order by f desc", f"order by {sql_r6('panel.forward_return_5d')} desc"),
    "set_01_union_all": "select ticker from ticker_master union all select ticker from market_prices",
    "set_03_differences": "select *, 'missing' as side from (select article_id from articles except select article_id from article_ticker_sentiment) union all select *, 'unexpected' from (select article_id from article_ticker_sentiment except select article_id from articles)",
    "set_04_intersection": "select distinct article_id from articles where list_has_any(detected_tickers, ['QVF1M', 'AQF7', 'SQU3', 'BRB6'])",
}
QUERIES = {name: f for name, f in globals().items() if name in SQL}
