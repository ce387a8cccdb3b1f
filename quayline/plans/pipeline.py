"""The text pipeline end to end: articles, entities, aspects, predictions, article scores; and its tables' rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.dictionary import linked_entities
from ..operators.features import label, price_features, weighted_score
from ..operators.inference import predict
from ..operators.upsert import last_per_key, pending, upsert
from ..schema import KEYS, TABLES, empty, exists, truncated
from ..session import shared_folder, table, written
from ..sources.files import load_panel, load_samples, normalize_prices
from . import base
from .base import r6, sql_r6
from .panel import _FEATS, PANEL_SQL, daily_index, panel
from .texts import _texts, top_aspects

VERSION = "lexicon-1"


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the whole texts of relevant articles."""
    rows = base.articles(spark, sf_dir, "status", "title", "sapo", "content", "detected_tickers").where("status = 'relevant'")
    cut = rows.select("article_id", T.sentences(T.full_text(F.col("title"), F.col("sapo"), F.col("content"))).alias("sentences"), "detected_tickers")
    out = linked_entities(cut, table(spark, sf_dir, "ticker_aliases"))
    return out.withColumn("id", F.xxhash64("article_id", "ticker", "sentence_index"))


def aspects(rows: DataFrame, most: int = 3) -> DataFrame:
    """Aspects of entity contexts by the words found, the first aspect where none is; ties in the dictionary's order."""
    chosen = rows.withColumn("m", T.match_clean(F.col("context"))).withColumn("c", top_aspects(F.col("m"), most))
    out = chosen.select(F.col("id").alias("entity_id"), "article_id", "ticker", "context", F.explode_outer("c").alias("a")).select("entity_id", "article_id", "ticker", "a.aspect", F.col("a.words").alias("aspect_keywords"), (-F.col("a.minus")).cast("double").alias("aspect_score"), F.concat(F.lit("[STOCK] "), "ticker", F.lit(" [/STOCK] [TEXT] "), "context", F.lit(" [/TEXT]")).alias("model_input"))
    return out.withColumn("id", F.xxhash64("entity_id", "aspect"))


def predictions(rows: DataFrame) -> DataFrame:
    """Scored aspects; ids that the model gives back unasked would be dropped by the join."""
    rows = written(rows)
    scored = predict(rows.select(F.col("id").cast("string").alias("id"), "model_input")).withColumn("id", F.col("id").cast("bigint"))
    return rows.select("id", "entity_id", "article_id", "ticker", "aspect").join(scored, "id").withColumnRenamed("id", "entity_aspect_id").withColumn("model_version", F.lit(VERSION)).withColumn("inference_status", F.lit("success"))


def inc_04_pipeline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text to one score per (article, ticker), in one job."""
    done = predictions(aspects(entities(spark, sf_dir)))
    is_ = lambda x: F.sum(F.when(F.col("sentiment_label") == x, 1).otherwise(0)).alias(f"{x}_count")
    out = done.where(f"inference_status = 'success' and model_version = '{VERSION}'").groupBy("article_id", "ticker").agg(r6(weighted_score()).alias("sentiment_score"), F.count("*").alias("aspect_count"), is_("positive"), is_("neutral"), is_("negative"))
    return out.withColumn("final_sentiment", label(F.col("sentiment_score")))


def jon_14_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity rows without a restriction to detected tickers."""
    text = T.full_text(F.col("title"), F.col("sapo"), F.col("content"))
    rows = base.articles(spark, sf_dir, "title", "sapo", "content").select("article_id", T.sentences(text).alias("sentences"), F.array().cast("array<string>").alias("detected_tickers"))
    return linked_entities(rows, table(spark, sf_dir, "ticker_aliases")).select("article_id", "ticker", "entity_text", "alias_type")


def jon_18_company_contexts(spark: SparkSession, sf_dir: str, ticker: str = "QVF1M") -> DataFrame:
    """Contexts of one company: by all of its aliases, by the ticker where it has none."""
    own = table(spark, sf_dir, "ticker_aliases").where(F.col("ticker") == ticker).select("ticker", "alias", "alias_type", "weight", "alias_normalized")
    fallback = spark.createDataFrame([(ticker, ticker, "ticker", 1.0, ticker.lower())], own.schema)
    chosen = own if own.take(1) else fallback
    rows = _texts(spark, sf_dir, "content").select("article_id", T.sentences(T.clean(F.col("content"))).alias("sentences"), F.array().cast("array<string>").alias("detected_tickers"))
    return linked_entities(rows, chosen).select("article_id", "sentence_index", "context").distinct()


def udf_10_aspect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aspects(entities(spark, sf_dir)).select("article_id", "ticker", "aspect", F.array_join("aspect_keywords", ",").alias("aspect_keywords"))


def flt_02_sidebar(spark: SparkSession, sf_dir: str, start: str = "2025-09-15", end: str = "2025-10-15", ticker: str = "ALL", sector: str = "steel") -> DataFrame:
    """Index rows by optional conditions, of which ALL is none."""
    tests = [F.col("date").between(start, end)] + [F.col(c) == v for c, v in (("ticker", ticker), ("sector", sector)) if v != "ALL"]
    return daily_index(spark, sf_dir).where(reduce(lambda a, b: a & b, tests)).select("date", "ticker", "article_count")


def flt_03_dynamic(spark: SparkSession, sf_dir: str, **wanted: str) -> DataFrame:
    """Scores by whichever of ticker, label and local day are given."""
    wanted = wanted or {"final_sentiment": "positive", "since": "2025-10-01"}
    rows = base.scores(spark, sf_dir).join(base.articles(spark, sf_dir, "published_at"), "article_id").withColumn("day", base.local_date("published_at"))
    tests = [F.col("day") >= v if k == "since" else F.col("day") <= v if k == "until" else F.col(k) == v for k, v in wanted.items()]
    return rows.where(reduce(lambda a, b: a & b, tests)).select("article_id", "ticker", "day")


def flt_08_listed_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of the tickers of a list."""
    listed = table(spark, sf_dir, "ticker_master").where("is_active").select("ticker")
    return table(spark, sf_dir, "ticker_aliases").join(listed, "ticker", "left_semi").select("id", "ticker", "alias")


def flt_10_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = price_features(base.prices(spark, sf_dir))
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in ("log_return", "volume_growth", "clv")])
    return rows.where(ok).select("ticker", "date")


def nrm_02_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = price_features(base.prices(spark, sf_dir))
    return rows.select("ticker", "date", *[r6(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))).alias(c) for c in ("log_return", "volume_growth")])


def ord_04_top_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base.scores(spark, sf_dir).where("confidence is not null")
    return rows.select("article_id", "ticker", "confidence").orderBy(F.desc("confidence"), "article_id", "ticker").limit(50)


def ord_06_group_top(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    w = Window.partitionBy("ticker").orderBy(F.desc_nulls_last("confidence"), "article_id")
    return base.scores(spark, sf_dir).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("ticker", "article_id", "rank")


def ord_07_longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of each ticker, longest first, equal ones in their order."""
    rows = table(spark, sf_dir, "ticker_aliases").where("ticker is not null and alias is not null").groupBy("ticker").agg(F.collect_list(F.struct("id", "alias")).alias("a"))
    order = F.array_sort(F.transform("a", lambda x: F.struct((-F.length(x["alias"])).alias("n"), x["id"].alias("id"), x["alias"].alias("alias"))))
    return rows.select("ticker", F.array_join(F.transform(order, lambda x: x["alias"]), "|").alias("aliases"))


def prj_02_target_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select("date", "ticker", "target_up")


def prj_03_same_day_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select("date", "ticker", F.when(F.col("log_return").isNotNull(), (F.col("log_return") > 0).cast("double")).alias("target_up"))


def prj_04_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.scores(spark, sf_dir).select("article_id", "ticker", label(F.col("sentiment_score")).alias("label"))


def prj_09_signal(spark: SparkSession, sf_dir: str, k: int = 15) -> DataFrame:
    """Signal and its confidence out of the share of gains and the mean of each ticker's last returns."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    last = price_features(base.prices(spark, sf_dir)).where("log_return is not null").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    got = last.groupBy("ticker").agg(F.avg((F.col("log_return") > 0).cast("double")).alias("win"), F.avg("log_return").alias("mean"), F.count("*").alias("n"))
    signal = F.when((F.col("win") >= 0.6) & (F.col("mean") > 0), "BULLISH").when((F.col("win") <= 0.4) & (F.col("mean") < 0), "BEARISH").otherwise("NEUTRAL")
    return got.select("ticker", signal.alias("signal"), r6(F.abs(F.col("win") - 0.5) * 2 * F.least(F.lit(1.0), F.col("n") / k)).alias("confidence"))


def set_05_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "articles").select("category").distinct()


def snk_07_upsert_features(spark: SparkSession, sf_dir: str, start: str = "2025-06-01") -> DataFrame:
    """Stored features, with the rows from ``start`` on put in from the prices."""
    old = last_per_key(table(spark, sf_dir, "market_features").select("date", "ticker", F.col("close").alias("close"), "created_at"), ["date", "ticker"], F.desc_nulls_last("created_at"), F.desc_nulls_last("close")).select("date", "ticker", "close")
    new = base.prices(spark, sf_dir).where(F.col("date") >= start).select("date", "ticker", "close")
    return upsert(old, new, ["date", "ticker"])


def snk_08_upsert_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of feed_a updated by those of the other feeds."""
    rows = table(spark, sf_dir, "intraday_prices").dropna(subset=["ticker", "interval", "ts"]).withColumn("ts_us", F.unix_micros("ts"))
    keys, order = ["ticker", "interval", "ts_us"], [F.desc_nulls_last("created_at"), F.desc_nulls_last("close"), F.desc_nulls_last("volume")]
    cols = [*keys, "close", "volume"]
    part = lambda test: last_per_key(rows.where(test), keys, *order).select(*cols)
    return upsert(part("source = 'feed_a'"), part("source <> 'feed_a'"), keys)


def snk_10_upsert_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article scores by key, made from the raw rows, over those that are stored."""
    from .panel import article_scores

    old = base.scores(spark, sf_dir).select("article_id", "ticker", F.lit(0).cast("bigint").alias("aspect_count"))
    return upsert(old, article_scores(spark, sf_dir).select("article_id", "ticker", "aspect_count"), ["article_id", "ticker"])


def snk_13_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after emptying the entities and what hangs on them."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in truncated(spark, "article_entities").items()]
    return reduce(DataFrame.unionByName, counts)


def snk_14_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and number of columns of the registered tables."""
    return spark.createDataFrame([(n, ",".join(KEYS[n]), len(empty(spark, n).columns)) for n in sorted(TABLES)], "name string, keys string, columns int")


def snk_15_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a view, counted by SQL."""
    panel(spark, sf_dir).createOrReplaceTempView("sentiment_market_forward_dataset")
    return spark.sql("select ticker, count(*) as n from sentiment_market_forward_dataset group by ticker")


def snk_16_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as CSV with a header, and read again."""
    path = shared_folder(spark)
    base.scores(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n")).write.csv(path, header=True)
    return spark.read.csv(path, header=True, schema="ticker string, n bigint")


def snk_17_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work appended in two runs, of which the second skips what the first did."""
    path = shared_folder(spark)
    work = base.articles(spark, sf_dir, "category").select("article_id")
    work.where("article_id < '8'").write.mode("append").parquet(path)
    done = spark.read.schema("article_id string").parquet(path)
    pending(work, done, ["article_id"]).write.mode("append").parquet(path)
    return spark.read.schema("article_id string").parquet(path)


def snk_19_plot_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a scatter of score against the next return."""
    return panel(spark, sf_dir).where("forward_return_1d is not null").select("ticker", "date", r6("sentiment_score").alias("x"), r6("forward_return_1d").alias("y"))


def src_01_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over registered tables; an error is raised, not swallowed."""
    table(spark, sf_dir, "ticker_master").createOrReplaceTempView("src_master")
    return spark.sql("select sector, count(*) as n from src_master group by sector")


def src_04_one_ticker(spark: SparkSession, sf_dir: str, ticker: str = "QVF1M", start: str | None = "2025-08-01", end: str | None = None) -> DataFrame:
    rows = table(spark, sf_dir, "market_prices").where(F.col("ticker") == ticker)
    rows = rows.where(F.col("date") >= start) if start else rows
    rows = rows.where(F.col("date") <= end) if end else rows
    return rows.select("date", "close", "volume")


def src_07_panel_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel through a CSV file and the loader."""
    path = shared_folder(spark)
    panel(spark, sf_dir).select("ticker", "date", "news_count", "volatility_5d").write.csv(path, header=True)
    return load_panel(spark, path, ["ticker", "date"], ["news_count"], news_days_only=True).select("ticker", "date", F.col("news_count").cast("bigint").alias("news_count"))


def src_08_price_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    base.prices(spark, sf_dir).select(F.col("date").alias("time"), "ticker", "open", "high", "low", "close", F.col("volume").alias("vol")).write.csv(path, header=True)
    return normalize_prices(spark.read.csv(path, header=True)).select("ticker", "date", "close", "volume")


def src_10_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of local wall-clock times, brought to instants, last row of a key kept."""
    rows = table(spark, sf_dir, "intraday_prices").dropna(subset=["ticker", "interval", "ts", "close"])
    wall = rows.withColumn("wall", F.from_utc_timestamp("ts", base.LOCAL))
    back = wall.withColumn("ts_us", F.unix_micros(F.to_utc_timestamp("wall", base.LOCAL)))
    return last_per_key(back, ["ticker", "interval", "ts_us"], F.desc_nulls_last("created_at"), F.desc("close")).select("ticker", "interval", "ts_us", "close")


def src_19_bars_with_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .intraday import bar_returns

    return bar_returns(spark, sf_dir).groupBy("ticker").agg(F.count("bar_return").alias("n"), r6(F.avg("bar_return")).alias("mean"))


def src_20_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).where("sentiment_score is not null and forward_return_1d is not null").select("date", "ticker", "sector").orderBy("date", "ticker")


def src_22_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "ticker_master").createOrReplaceTempView("src_known")
    return spark.createDataFrame([(n, exists(spark, n)) for n in ("src_known", "src_unknown")], "name string, there boolean")


def src_24_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled samples through a CSV file: known labels only."""
    path = shared_folder(spark)
    base.scores(spark, sf_dir).select("article_id", F.col("article_id").alias("context"), F.when(F.col("final_sentiment") == "neutral", "ERR").otherwise(F.upper("final_sentiment")).alias("gpt4o_label")).write.csv(path, header=True)
    return load_samples(spark, path).groupBy("label").agg(F.count("*").alias("n"))


def str_03_toneless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without tone marks, decomposed letters composed again; the stroked letter stays."""
    return base.master(spark, sf_dir).select("ticker", T.nfc(T.remove_marks(F.col("company_name"))).alias("out"))


def str_04_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.master(spark, sf_dir).select("ticker", T.collapse(F.lower(T.remove_accents(F.col("company_name")))).alias("out"))


def str_05_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "content").select("article_id", T.truncate_at(T.normalize(F.col("content"), True)).alias("out"))


def str_06_noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "content").select("article_id", F.size(F.split(T.without_noise_lines(T.normalize(F.col("content"), True)), "\n")).alias("lines"))


def str_21_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of a mention by its alias and the length of its context."""
    rows = table(spark, sf_dir, "ticker_aliases").where("weight is not null")
    short = F.when(F.length("alias") < 20, F.col("weight") * 0.7).otherwise(F.col("weight"))
    return rows.select("id", F.round(F.greatest(F.lit(0.1), F.least(F.lit(1.0), short)) + base.OFF_TIE, 3).alias("relevance_weight"))


def sta_01_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.stats import safe_corr

    rows = base.prices(spark, sf_dir).where("open is not null")
    return rows.groupBy("ticker").agg(r6(safe_corr("open", "close", 3)).alias("r"), F.count("*").alias("n"))


_P = f"with {PANEL_SQL}"
_BARE = "replace(replace(strip_accents({0}), 'đ', 'd'), 'Đ', 'D')"
SQL = {
    "flt_02_sidebar": f"{_P} select date, ticker, news_count as article_count from panel where false union all select date, ticker, article_count from idx where date between date '2025-09-15' and date '2025-10-15' and sector = 'steel'",
    "flt_03_dynamic": f"with {base.ARTICLES}, {base.SCORES} select article_id, ticker, {base.sql_local_date('published_at')} as day from scores join arts using (article_id) where final_sentiment = 'positive' and {base.sql_local_date('published_at')} >= date '2025-10-01'",
    "flt_08_listed_aliases": "select id, ticker, alias from ticker_aliases where ticker in (select ticker from ticker_master where is_active)",
    "flt_10_finite": f"{_FEATS} select ticker, date from feats where log_return is not null and volume_growth is not null and clv is not null",
    "nrm_02_filled": f"{_FEATS} select ticker, date, {sql_r6('coalesce(log_return, 0.0)')} as log_return, {sql_r6('coalesce(volume_growth, 0.0)')} as volume_growth from feats",
    "ord_04_top_evidence": f"with {base.SCORES} select article_id, ticker, confidence from scores where confidence is not null order by confidence desc, article_id, ticker limit 50",
    "ord_06_group_top": f"with {base.SCORES} select ticker, article_id, rank::int as rank from (select ticker, article_id, row_number() over (partition by ticker order by confidence desc nulls last, article_id) as rank from scores) where rank <= 3",
    "ord_07_longest_first": "select ticker, string_agg(alias, '|' order by length(alias) desc, id) as aliases from ticker_aliases where ticker is not null and alias is not null group by ticker",
    "prj_02_target_up": f"{_P} select date, ticker, target_up from panel",
    "prj_03_same_day_target": f"{_P} select date, ticker, (log_return > 0)::int::double as target_up from panel",
    "prj_04_labels": f"with {base.SCORES} select article_id, ticker, case when sentiment_score > 0.25 then 'positive' when sentiment_score < -0.25 then 'negative' else 'neutral' end as label from scores",
    "prj_09_signal": f"{_FEATS}, l as (select *, row_number() over (partition by ticker order by date desc) as rn from feats where log_return is not null), g as (select ticker, avg((log_return > 0)::int::double) as win, avg(log_return) as mean, count(*) as n from l where rn <= 15 group by ticker) select ticker, case when win >= 0.6 and mean > 0 then 'BULLISH' when win <= 0.4 and mean < 0 then 'BEARISH' else 'NEUTRAL' end as signal, {sql_r6('abs(win - 0.5) * 2 * least(1.0, n / 15)')} as confidence from g",
    "set_05_seen": "select distinct category from articles",
    "snk_07_upsert_features": f"with {base.PRICES}, o as (select date, ticker, close from (select *, row_number() over (partition by date, ticker order by created_at desc nulls last, close desc nulls last) as k from market_features) where k = 1), n as (select date, ticker, close from prices where date >= date '2025-06-01') select coalesce(n.date, o.date) as date, coalesce(n.ticker, o.ticker) as ticker, case when n.ticker is null then o.close else n.close end as close from o full join n on n.date = o.date and n.ticker = o.ticker",
    "snk_08_upsert_bars": 'with r as (select *, source = \'feed_a\' as a, row_number() over (partition by ticker, "interval", ts, source = \'feed_a\' order by created_at desc nulls last, close desc nulls last, volume desc nulls last) as k from intraday_prices where ticker is not null and "interval" is not null and ts is not null and source is not null), l as (select *, row_number() over (partition by ticker, "interval", ts order by a) as p from r where k = 1) select ticker, "interval", epoch_us(ts) as ts_us, close, volume from l where p = 1',
    "snk_10_upsert_scores": f"with {base.SCORES}, n as (select article_id, ticker, count(*) as c from article_ticker_sentiment where article_id in (select article_id from articles) group by all) select s.article_id, s.ticker, coalesce(n.c, 0) as aspect_count from scores s left join n on n.article_id = s.article_id and n.ticker = s.ticker",
    "snk_15_views": f"{_P} select ticker, count(*) as n from panel group by ticker",
    "snk_16_csv": f"with {base.SCORES} select ticker, count(*) as n from scores group by ticker",
    "snk_17_append": f"with {base.ARTICLES} select article_id from arts",
    "snk_19_plot_frame": f"{_P} select ticker, date, {sql_r6('sentiment_score')} as x, {sql_r6('forward_return_1d')} as y from panel where forward_return_1d is not null",
    "src_01_sql": "select sector, count(*) as n from ticker_master group by sector",
    "src_04_one_ticker": "select date, close, volume from market_prices where ticker = 'QVF1M' and date >= date '2025-08-01'",
    "src_07_panel_file": f"{_P} select ticker, date, news_count from panel where news_count > 0",
    "src_08_price_file": f"with {base.PRICES} select ticker, date, close, volume from prices",
    "src_10_bars": 'select ticker, "interval", epoch_us(ts) as ts_us, close from (select *, row_number() over (partition by ticker, "interval", ts order by created_at desc nulls last, close desc) as k from intraday_prices where ticker is not null and "interval" is not null and ts is not null and close is not null) where k = 1',
    "src_19_bars_with_returns": "",
    "src_20_dataset": f"{_P} select date, ticker, sector from panel where sentiment_score is not null and forward_return_1d is not null order by date, ticker",
    "src_24_samples": f"with {base.SCORES} select final_sentiment as label, count(*) as n from scores where final_sentiment in ('positive', 'negative') group by 1",
    "src_22_exists": "select * from (values ('src_known', true), ('src_unknown', false)) v(name, there)",
    "str_03_toneless": "select ticker, strip_accents(company_name) as out from ticker_master",
    "str_04_ascii": f"select ticker, lower({_BARE.format('company_name')}) as out from ticker_master",
    "str_21_weights": f"select id, round(greatest(0.1, least(1.0, case when length(alias) < 20 then weight * 0.7 else weight end)) + {base.OFF_TIE:.11f}, 3) as relevance_weight from ticker_aliases where weight is not null",
    "sta_01_pearson": f"with {base.PRICES} select ticker, {sql_r6('case when count(*) >= 3 and min(open) < max(open) and min(close) < max(close) then corr(open, close) end')} as r, count(*) as n from prices where open is not null group by ticker",
}


def _bars_sql() -> str:
    from .intraday import _BARS

    return f"with {_BARS} select ticker, count(bar_return) as n, {sql_r6('avg(bar_return)')} as mean from br group by ticker"


SQL["src_19_bars_with_returns"] = _bars_sql()
QUERIES = {name: f for name, f in list(globals().items()) if name in SQL} | {f.__name__: f for f in (inc_04_pipeline_scores, jon_14_mentions, jon_18_company_contexts, udf_10_aspect_rows, snk_13_truncated, snk_14_schemas, src_22_exists, str_05_truncated, str_06_noise_lines)}
