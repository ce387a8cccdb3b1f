"""Research queries: analog forecasts, Granger tests, nearest neighbours, model comparisons, scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.analog import analog_forecasts
from ..operators.features import by_day, price_features
from ..operators.granger import granger_by_ticker, var_by_ticker
from ..operators.inference import predict
from ..operators.learning import chronological_split, class_metrics, classify, laid_out, regress, value_metrics
from ..operators.windows import rolling_past
from ..session import table
from . import base
from .base import r6
from .panel import daily_index, panel


def full_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price row with its features, and the index of its day where there is one."""
    rows = price_features(base.prices(spark, sf_dir))
    return rows.join(daily_index(spark, sf_dir).select("date", "ticker", F.col("sentiment_index").alias("sentiment_score"), F.col("article_count").alias("news_count")), ["date", "ticker"], "left")


def vec_02_analogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analog_forecasts(full_panel(spark, sf_dir))
    return out.select("ticker", "as_of", "signal", *[r6(c).alias(c) for c in ("win_rate", "avg_fwd", "median_fwd", "confidence", "recent_return")], "n_analogs").orderBy(F.desc("confidence"), "ticker")


def jon_16_nearest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest past windows of each ticker with rank and distance."""
    out = analog_forecasts(full_panel(spark, sf_dir))
    return out.select("ticker", F.posexplode(F.arrays_zip("nearest", "distances")).alias("k", "n")).select("ticker", (F.col("k") + 1).alias("rank"), F.col("n.nearest").alias("start"), r6("n.distances").alias("distance"))


def win_18_signal_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analog_forecasts(full_panel(spark, sf_dir), days=10).select("ticker", "as_of", "signal", r6("confidence").alias("confidence"))


def sta_06_granger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = full_panel(spark, sf_dir).withColumn("sentiment_score", F.coalesce("sentiment_score", F.lit(0.0)))
    out = granger_by_ticker(rows)
    return out.select("ticker", "window", "n", r6("f_stat").alias("f_stat"), r6("p_value").alias("p_value"), "df_num", "df_den", "status").orderBy(F.asc_nulls_last("p_value"), "ticker", "window")


def sta_07_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = full_panel(spark, sf_dir).withColumn("sentiment_score", F.coalesce("sentiment_score", F.lit(0.0)))
    return var_by_ticker(rows).select("ticker", "lag", "n", r6("test_stat").alias("test_stat"), r6("p_value").alias("p_value"), "status")


_BASE = ["log_return", "volume_growth", "clv"]


def dataset(spark: SparkSession, sf_dir: str, size: int = 10) -> tuple[DataFrame, list[str], list[str]]:
    """Rolling features of all tickers with the next return; price features, and those of sentiment besides."""
    rows = full_panel(spark, sf_dir).withColumn("sentiment_score", F.coalesce("sentiment_score", F.lit(0.0))).withColumn("news_count", F.coalesce("news_count", F.lit(0)).cast("double"))
    out = rolling_past(rows.select("ticker", "date", *_BASE, "sentiment_score", "news_count").withColumn("target_return", F.lead("log_return").over(by_day())), [*_BASE, "sentiment_score", "news_count"], size, by_day())
    names = lambda cols: [f"{c}_{k}" for c in cols for k in ("mean", "std", "last")]
    plain, full = names(_BASE), names([*_BASE, "sentiment_score", "news_count"])
    return out.dropna(subset=[*full, "target_return"]).withColumn("target_up", (F.col("target_return") > 0).cast("int")), plain, full


def mle_02_classifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, plain, full = dataset(spark, sf_dir)
    train, test = map(laid_out, chronological_split(data.cache()))
    parts = [class_metrics(p).select(F.lit(kind).alias("feature_set"), F.lit(name).alias("model"), "*") for kind, cols in (("price", plain), ("price_sentiment", full)) for name, p in classify(train, test, cols).items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "feature_set string, model string, n_test bigint, accuracy double, precision double, recall double, f1 double, auc double")


def mle_03_regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, full = dataset(spark, sf_dir)
    train, test = map(laid_out, chronological_split(data.cache()))
    return reduce(DataFrame.unionByName, [value_metrics(p).select(F.lit(name).alias("model"), "*") for name, p in regress(train, test, full).items()])


def mle_05_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on either side of the split, over all and by ticker."""
    data, _, _ = dataset(spark, sf_dir)
    train, test = chronological_split(data.select("ticker", "date"))
    rows = train.select("ticker", F.lit("train").alias("part")).unionByName(test.select("ticker", F.lit("test").alias("part")))
    return rows.groupingSets([["ticker", "part"], ["part"]], "ticker", "part").agg(F.count("*").alias("n")).withColumn("ticker", F.coalesce("ticker", F.lit("ALL")))


def udf_07_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = T.full_text(F.col("title"), F.col("sapo"), F.col("content"))
    rows = base.articles(spark, sf_dir, "title", "sapo", "content").select(F.col("article_id").alias("id"), text.alias("model_input"))
    return predict(rows).select("id", "sentiment_label", *[r6(c).alias(c) for c in ("sentiment_score", "confidence")])


def mth_03_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each embedding to the mean embedding of its label."""
    rows = table(spark, sf_dir, "embeddings")
    long = rows.select("vec_id", "label", F.posexplode("embedding").alias("k", "x"))
    means = long.groupBy("label", "k").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return long.join(means, ["label", "k"]).groupBy("vec_id").agg(F.round(F.sqrt(F.sum((F.col("x") - F.col("m")) * (F.col("x") - F.col("m")))), 4).alias("distance"))


SQL = {
    "mth_03_distances": "with l as (select vec_id, label, unnest(range(len(embedding))) as k, unnest(embedding)::double as x from embeddings), m as (select *, avg(x) over (partition by label, k) as m from l) select vec_id, round(sqrt(sum((x - m) * (x - m))), 4) as distance from m group by vec_id",
}
QUERIES = {f.__name__: f for f in (vec_02_analogs, jon_16_nearest_windows, win_18_signal_history, sta_06_granger, sta_07_var, mle_02_classifiers, mle_03_regressors, mle_05_split_sizes, udf_07_predictions, mth_03_distances)}
