"""Time-series queries: shifts, rolling frames, event studies, lagged correlations, chronological splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import safe_corr, t_p_value, t_statistic
from ..operators.features import by_day, price_features
from ..operators.spikes import medians
from ..operators.windows import encoded_windows, forward_sum, lag_matrix, rolling_past, running_path, shifted
from ..session import written
from . import base
from .base import r6, sql_r6
from .panel import _FEATS, PANEL_SQL, panel
from .panel import _STEPS as STEPS_SQL

_P = f"with {PANEL_SQL}"
LAGS = 3
HORIZONS = (1, 3, 5, 10)
W = "window w as (partition by ticker order by date)"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_features(base.prices(spark, sf_dir))


def win_07_signed_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select("ticker", "date", r6(shifted("close", 2, by_day())).alias("past"), r6(shifted("close", -2, by_day())).alias("ahead"))


def win_08_lag_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lag_matrix(_features(spark, sf_dir).select("ticker", "date", "log_return", "volume_growth"), ["log_return", "volume_growth"], LAGS, by_day())
    return out.select("ticker", "date", *[r6(c).alias(c) for c in out.columns if "_lag_" in c])


def win_11_rolling_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rolling_past(_features(spark, sf_dir).select("ticker", "date", "log_return"), ["log_return"], 10, by_day())
    return out.select("ticker", "date", *[r6(f"log_return_{k}").alias(f"log_return_{k}") for k in ("mean", "std", "last")])


def win_20_feature_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling features of all tickers with their target; rows with a null in either are left out."""
    rows = panel(spark, sf_dir).select("ticker", "date", "log_return", "sentiment_score", "target_up")
    out = rolling_past(rows, ["log_return", "sentiment_score"], 9, by_day())
    names = [f"{c}_{k}" for c in ("log_return", "sentiment_score") for k in ("mean", "std", "last")]
    return out.dropna(subset=names).select("ticker", "date", "target_up", *[r6(n).alias(n) for n in names])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News days with future and abnormal returns (own less the mean of the other tickers)."""
    rows = _features(spark, sf_dir).select("ticker", "date", "log_return")
    day = rows.groupBy("date").agg(F.sum("log_return").alias("_sum"), F.count("log_return").alias("_n"))
    rows = rows.join(day, "date").withColumn("market", F.when(F.col("_n") > 1, (F.col("_sum") - F.col("log_return")) / (F.col("_n") - 1)))
    own, market = F.col("log_return"), F.col("market")
    out = [forward_sum(own, h, by_day()).alias(f"future_return_{h}") for h in HORIZONS] + [(forward_sum(own, h, by_day()) - forward_sum(market, h, by_day())).alias(f"future_abret_{h}") for h in HORIZONS]
    ahead = rows.select("ticker", "date", *out)
    s = F.col("sentiment_score")
    news = panel(spark, sf_dir).select("ticker", "date", F.when(s.isNull(), "NO_NEWS").when(s > 0.1, "POS").when(s < -0.1, "NEG").otherwise("NEU").alias("sentiment_group"))
    return ahead.join(news, ["ticker", "date"])


def win_12_future_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("ticker", "date", "sentiment_group", *[r6(f"future_{k}_{h}").alias(f"future_{k}_{h}") for k in ("return", "abret") for h in HORIZONS])


def _melted(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [f"future_{k}_{h}" for k in ("return", "abret") for h in HORIZONS]
    return events(spark, sf_dir).unpivot(["ticker", "sentiment_group"], metrics, "metric", "value").where("value is not null")


def sta_09_event_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events summed up by group; the t-test is over the means of the tickers, as their events overlap."""
    keys = ["sentiment_group", "metric"]
    melted = written(_melted(spark, sf_dir))
    by_ticker = melted.groupBy(*keys, "ticker").agg(F.avg("value").alias("m"))
    tests = by_ticker.groupBy(*keys).agg(F.count("*").alias("n_tickers"), t_statistic("m").alias("t"))
    sums = medians(melted, keys, "value", mean=F.avg("value"), std=F.stddev_samp("value"))
    return sums.join(tests, keys).select(*keys, "n", "n_tickers", *[r6(c).alias(c) for c in ("mean", "median", "std")], F.round("t", 4).alias("t_stat"))


def agg_32_event_summary_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["ticker", "sentiment_group", "metric"]
    return _melted(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"), r6(F.median("value")).alias("median"), r6(F.stddev_samp("value")).alias("std"), F.round(t_statistic("value"), 4).alias("t_stat"))


def sta_02_t_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-sample t-test of forward returns by ticker, with its p-value."""
    rows = panel(spark, sf_dir).groupBy("ticker").agg(F.count("forward_return_1d").alias("n"), t_statistic("forward_return_1d").alias("t"))
    return rows.withColumn("p_value", F.round(t_p_value(F.col("t"), (F.col("n") - 1).cast("double")), 6)).withColumn("t", F.round("t", 4))


def sta_03_pearson_p(spark: SparkSession, sf_dir: str, least: int = 10) -> DataFrame:
    rows = panel(spark, sf_dir).where("sentiment_score is not null and forward_return_1d is not null")
    out = rows.groupBy("ticker").agg(safe_corr("sentiment_score", "forward_return_1d", least).alias("r"), F.count("*").alias("n")).where(F.col("n") >= least)
    t = F.when(F.abs("r") < 1, F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r"))))
    return out.select("ticker", "n", r6("r").alias("r"), F.round(t_p_value(t, (F.col("n") - 2).cast("double")), 6).alias("p_value"))


PAIRS = [("sentiment_score", "log_return"), ("sentiment_score", "volume_growth"), ("sentiment_score", "clv"), ("news_count", "log_return"), ("news_count", "volume_growth"), ("log_return", "volume_growth")]


def cross_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of x shifted by each lag with y, by ticker; at least five pairs of values."""
    names = sorted({c for p in PAIRS for c in p})
    rows = panel(spark, sf_dir).select("ticker", "date", *[F.col(c).cast("double").alias(c) for c in names])
    lags = range(-LAGS, LAGS + 1)
    cells = [F.struct(F.lit(f"{x}->{y}").alias("pair"), F.lit(k).alias("lag"), (shifted(x, k, by_day()) if k else F.col(x)).alias("x"), F.col(y).alias("y")) for x, y in PAIRS for k in lags]
    wide = rows.select("ticker", F.array(*cells).alias("c"))
    long = wide.select("ticker", F.explode("c").alias("c")).select("ticker", "c.*").where("x is not null and y is not null")
    return long.groupBy("ticker", "pair", "lag").agg(safe_corr("x", "y", 5).alias("correlation"), F.count("*").alias("n")).where("correlation is not null")


def sta_04_cross_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_correlations(spark, sf_dir).select("ticker", "pair", "lag", r6("correlation").alias("correlation"), "n")


def agg_37_all_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_correlations(spark, sf_dir).groupBy("pair", "lag").agg(r6(F.avg("correlation")).alias("correlation"), F.sum("n").alias("n"))


def ord_03_top_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg_37_all_mean(spark, sf_dir).orderBy(F.abs("correlation").desc(), "pair", "lag").limit(12)


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted (score above 0) against actual (forward return above 0) at lags 0 to 2, by ticker and pooled."""
    rows = panel(spark, sf_dir).where("forward_return_1d is not null").select("ticker", "date", "sentiment_score", (F.col("forward_return_1d") > 0).cast("int").alias("y"))
    lagged = reduce(DataFrame.unionByName, [rows.withColumn("s", shifted("sentiment_score", k, by_day()) if k else F.col("sentiment_score")).withColumn("lag", F.lit(k)) for k in range(3)])
    marked = lagged.where("s is not null").withColumn("p", (F.col("s") > 0).cast("int"))
    cell = lambda p, y: F.sum(F.when((F.col("p") == p) & (F.col("y") == y), 1).otherwise(0))
    by = marked.groupingSets([["ticker", "lag"], ["lag"]], "ticker", "lag").agg(cell(1, 1).alias("tp"), cell(1, 0).alias("fp"), cell(0, 1).alias("fn"), cell(0, 0).alias("tn"))
    return by.withColumn("ticker", F.coalesce("ticker", F.lit("ALL")))


def agg_38_confusion_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(spark, sf_dir)


def sta_05_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, precision, recall and F1; all null where only one class occurs, 0 for a zero divisor."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    two = ((tp + fn) > 0) & ((fp + tn) > 0)
    safe = lambda a, b: F.when(two, F.coalesce(F.try_divide(a, b), F.lit(0.0)))
    return confusion(spark, sf_dir).select("ticker", "lag", r6(safe(tp + tn, tp + fp + fn + tn)).alias("accuracy"), r6(safe(tp, tp + fp)).alias("precision"), r6(safe(tp, tp + fn)).alias("recall"), r6(safe(2 * tp, 2 * tp + fp + fn)).alias("f1"))


def sta_08_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel(spark, sf_dir).where("sentiment_score is not null and forward_return_1d is not null")
    out = rows.groupBy("ticker").agg(F.count("*").alias("n"), F.regr_slope("forward_return_1d", "sentiment_score").alias("slope"), F.regr_intercept("forward_return_1d", "sentiment_score").alias("intercept"))
    return out.where("n >= 5").select("ticker", "n", r6("slope").alias("slope"), r6("intercept").alias("intercept"))


def win_14_pattern_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).select("ticker", "date", "log_return", "volume_growth", F.col("clv").alias("sentiment_score"))
    out = encoded_windows(rows, 5, by_day(), ["log_return", "volume_growth"], ["sentiment_score"])
    return out.where("vector is not null").select("ticker", "date", F.posexplode("vector").alias("k", "value")).select("ticker", "date", "k", F.round(F.col("value") + base.OFF_TIE, 5).alias("value"))


def win_15_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).select("ticker", "date", running_path("log_return", 5, by_day()).alias("path")).where("path is not null")
    return rows.select("ticker", "date", F.posexplode("path").alias("k", "value")).select("ticker", "date", "k", r6("value").alias("value"))


def win_16_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last close of each ticker and its change to the rows 1, 4 and 19 before."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    rows = base.prices(spark, sf_dir).withColumn("rn", F.row_number().over(w)).where(F.col("rn").isin(1, 2, 5, 20))
    at = lambda k: F.max(F.when(F.col("rn") == k, F.col("close")))
    return rows.groupBy("ticker").agg(at(1).alias("close"), *[r6(F.try_divide(at(1), at(k)) - 1).alias(f"change_{k}") for k in (2, 5, 20)])


def win_17_as_of(spark: SparkSession, sf_dir: str, day: str = "2025-06-15") -> DataFrame:
    rows = base.prices(spark, sf_dir).where(F.col("date") <= day)
    return rows.groupBy("ticker").agg(F.max_by(F.struct("date", "close"), "date").alias("r")).select("ticker", "r.date", "r.close")


def mle_01_chronological_split(spark: SparkSession, sf_dir: str, ratio: float = 0.7, horizon: int = 1) -> DataFrame:
    """Days before the cut less the horizon train, days from the cut on test; the days between are left out."""
    days = panel(spark, sf_dir).select("date").distinct()
    ranked = days.withColumn("k", F.row_number().over(Window.orderBy("date")) - 1).withColumn("n", days.agg(F.count("*")).scalar())
    cut = F.floor(F.col("n") * ratio)
    part = F.when(F.col("k") < cut - horizon, "train").when(F.col("k") >= cut, "test").otherwise("embargo")
    return ranked.where("n >= 5").select("date", part.alias("part"))


def agg_06_safe_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded correlation of returns and volume growth by ticker."""
    rows = _features(spark, sf_dir).where("log_return is not null and volume_growth is not null")
    return rows.groupBy("ticker").agg(r6(safe_corr("log_return", "volume_growth", 3)).alias("correlation"), F.count("*").alias("n"))


_MARKET = f"{base.PRICES}, {STEPS_SQL}"
_METRICS = [f"future_{k}_{h}" for k in ("return", "abret") for h in HORIZONS]


def _ahead(x: str, h: int) -> str:
    f = f"over (partition by ticker order by date rows between 1 following and {h} following)"
    return f"case when count({x}) {f} = {h} then sum({x}) {f} end"


_EVENTS = (
    f"{PANEL_SQL}, lone as (select ticker, date, log_return, case when count(log_return) over (partition by date) > 1 then (sum(log_return) over (partition by date) - log_return) / (count(log_return) over (partition by date) - 1) end as market from feats), "
    + "ahead as (select ticker, date, "
    + ", ".join(f"{_ahead('log_return', h)} as future_return_{h}" for h in HORIZONS)
    + ", "
    + ", ".join(f"{_ahead('log_return', h)} - {_ahead('market', h)} as future_abret_{h}" for h in HORIZONS)
    + " from lone), ev as (select a.*, case when p.sentiment_score is null then 'NO_NEWS' when p.sentiment_score > 0.1 then 'POS' when p.sentiment_score < -0.1 then 'NEG' else 'NEU' end as sentiment_group from ahead a join panel p on p.ticker = a.ticker and p.date = a.date), "
    + f"long as (select * from (select ticker, sentiment_group, unnest({_METRICS}) as metric, unnest([{', '.join(_METRICS)}]) as value from ev) where value is not null)"
)
_T = "case when count({0}) >= 2 and min({0}) < max({0}) then round(avg({0}) / (stddev_samp({0}) / sqrt(count({0}))), 4) end"
_CROSS = f"""{PANEL_SQL}, cells as (select ticker, unnest([{", ".join(f"struct_pack(pair := '{x}->{y}', lag := {k}, x := ({f'lag({x}, {k}) over w' if k > 0 else f'lead({x}, {-k}) over w' if k < 0 else x})::double, y := {y}::double)" for x, y in PAIRS for k in range(-LAGS, LAGS + 1))}]) as c from panel {W}),
cross_c as (select * from (select ticker, c.pair as pair, c.lag as lag, case when count(*) >= 5 and min(c.x) < max(c.x) and min(c.y) < max(c.y) then corr(c.x, c.y) end as correlation, count(*) as n from cells where c.x is not null and c.y is not null group by 1, 2, 3) where correlation is not null)"""
_ALL_MEAN = f"select pair, lag, {sql_r6('avg(correlation)')} as correlation, sum(n)::bigint as n from cross_c group by pair, lag"
_CONF = f"""{PANEL_SQL}, base_rows as (select ticker, date, sentiment_score, cast(forward_return_1d > 0 as int) as y from panel where forward_return_1d is not null),
lagged as (select ticker, y, unnest([0, 1, 2]) as lag, unnest([sentiment_score, lag(sentiment_score, 1) over w, lag(sentiment_score, 2) over w]) as s from base_rows {W}),
conf as (select coalesce(ticker, 'ALL') as ticker, lag, (count(*) filter (s > 0 and y = 1)) as tp, (count(*) filter (s > 0 and y = 0)) as fp, (count(*) filter (not s > 0 and y = 1)) as fn, (count(*) filter (not s > 0 and y = 0)) as tn from lagged where s is not null group by grouping sets ((ticker, lag), (lag)))"""
_SAFE = "case when tp + fn > 0 and fp + tn > 0 then coalesce(({0})::double / nullif({1}, 0), 0.0) end"
_WIN = f"""{_MARKET}, arr as (select ticker, date, list(coalesce(log_return, 0.0)) over f as a, list(coalesce(volume_growth, 0.0)) over f as b, list(clv) over f as c from feats window f as (partition by ticker order by date rows between 4 preceding and current row)),
st as (select *, list_avg(a) as ma, list_stddev_pop(a) as sa, list_avg(b) as mb, list_stddev_pop(b) as sb from arr where len(a) = 5),
cells as (select ticker, date, unnest(range(15)) as k, a, b, c, ma, sa, mb, sb from st)"""

SQL = {
    "win_07_signed_shift": f"{_FEATS} select ticker, date, {sql_r6('lag(close, 2) over w')} as past, {sql_r6('lead(close, 2) over w')} as ahead from feats {W}",
    "win_08_lag_matrix": f"{_FEATS} select ticker, date, " + ", ".join(f"{sql_r6(f'lag({c}, {k}) over w')} as {c}_lag_{k}" for c in ("log_return", "volume_growth") for k in range(1, LAGS + 1)) + f" from feats {W}",
    "win_11_rolling_past": f"{_FEATS} select ticker, date, {sql_r6('case when count(log_return) over p >= 3 then avg(log_return) over p end')} as log_return_mean, {sql_r6('case when count(log_return) over p >= 3 then stddev_samp(log_return) over p end')} as log_return_std, {sql_r6('lag(log_return) over (partition by ticker order by date)')} as log_return_last from feats window p as (partition by ticker order by date rows between 10 preceding and 1 preceding)",
    "win_20_feature_dataset": f"{_P}, r as (select ticker, date, target_up, " + ", ".join(f"case when count({c}) over p >= 3 then avg({c}) over p end as {c}_mean, case when count({c}) over p >= 3 then stddev_samp({c}) over p end as {c}_std, lag({c}) over (partition by ticker order by date) as {c}_last" for c in ("log_return", "sentiment_score")) + " from panel window p as (partition by ticker order by date rows between 9 preceding and 1 preceding)) select ticker, date, target_up, " + ", ".join(f"{sql_r6(f'{c}_{k}')} as {c}_{k}" for c in ("log_return", "sentiment_score") for k in ("mean", "std", "last")) + " from r where " + " and ".join(f"{c}_{k} is not null" for c in ("log_return", "sentiment_score") for k in ("mean", "std", "last")),
    "win_12_future_returns": f"with {_EVENTS} select ticker, date, sentiment_group, " + ", ".join(f"{sql_r6(m)} as {m}" for m in _METRICS) + " from ev",
    "sta_09_event_study": f"with {_EVENTS}, m as (select sentiment_group, metric, ticker, avg(value) as m from long group by all), t as (select sentiment_group, metric, count(*) as n_tickers, {_T.format('m')} as t_stat from m group by all), s as (select sentiment_group, metric, count(*) as n, {sql_r6('avg(value)')} as mean, {sql_r6('median(value)')} as median, {sql_r6('stddev_samp(value)')} as std from long group by all) select s.*, t.n_tickers, t.t_stat from s join t using (sentiment_group, metric)",
    "agg_32_event_summary_by_ticker": f"with {_EVENTS} select ticker, sentiment_group, metric, count(*) as n, {sql_r6('avg(value)')} as mean, {sql_r6('median(value)')} as median, {sql_r6('stddev_samp(value)')} as std, {_T.format('value')} as t_stat from long group by all",
    "sta_04_cross_correlation": f"with {_CROSS} select ticker, pair, lag, {sql_r6('correlation')} as correlation, n from cross_c",
    "agg_37_all_mean": f"with {_CROSS} {_ALL_MEAN}",
    "ord_03_top_correlations": f"with {_CROSS} select * from ({_ALL_MEAN}) order by abs(correlation) desc, pair, lag limit 12",
    "agg_38_confusion_levels": f"with {_CONF} select * from conf",
    "sta_05_binary_metrics": f"with {_CONF} select ticker, lag, {sql_r6(_SAFE.format('tp + tn', '(tp + fp + fn + tn)'))} as accuracy, {sql_r6(_SAFE.format('tp', '(tp + fp)'))} as precision, {sql_r6(_SAFE.format('tp', '(tp + fn)'))} as recall, {sql_r6(_SAFE.format('2 * tp', '(2 * tp + fp + fn)'))} as f1 from conf",
    "sta_08_line": f"{_P} select ticker, count(*) as n, {sql_r6('regr_slope(forward_return_1d, sentiment_score)')} as slope, {sql_r6('regr_intercept(forward_return_1d, sentiment_score)')} as intercept from panel where sentiment_score is not null and forward_return_1d is not null group by ticker having count(*) >= 5",
    "win_14_pattern_windows": f"with {_WIN} select ticker, date, k::int as k, round((case k % 3 when 0 then case when sa > 1e-8 then (a[k // 3 + 1] - ma) / sa else 0.0 end when 1 then case when sb > 1e-8 then (b[k // 3 + 1] - mb) / sb else 0.0 end else c[k // 3 + 1] end) + 3.1e-10, 5) as value from cells",
    "win_15_paths": f"{_FEATS}, p as (select ticker, date, list(log_return) over n as a from feats window n as (partition by ticker order by date rows between 1 following and 5 following)), e as (select ticker, date, unnest(range(5)) as k, a from p where len(list_filter(a, lambda x: x is not null)) = 5) select ticker, date, k::int as k, {sql_r6('list_sum(a[1:k + 1])')} as value from e",
    "win_16_last_rows": f"with {base.PRICES}, r as (select *, row_number() over (partition by ticker order by date desc) as k from prices), l as (select ticker, max(close) filter (k = 1) as c1, max(close) filter (k = 2) as c2, max(close) filter (k = 5) as c5, max(close) filter (k = 20) as c20 from r group by ticker) select ticker, c1 as close, " + ", ".join(f"{sql_r6(f'c1 / nullif(c{k}, 0) - 1')} as change_{k}" for k in (2, 5, 20)) + " from l",
    "win_17_as_of": f"with {base.PRICES} select ticker, max(date) as date, arg_max(close, date) as close from prices where date <= date '2025-06-15' group by ticker",
    "mle_01_chronological_split": f"{_P}, d as (select date, row_number() over (order by date) - 1 as k, count(*) over () as n from (select distinct date from panel)) select date, case when k < floor(n * 0.7) - 1 then 'train' when k >= floor(n * 0.7) then 'test' else 'embargo' end as part from d where n >= 5",
    "agg_06_safe_correlation": f"{_FEATS} select ticker, {sql_r6('case when count(*) >= 3 and min(log_return) < max(log_return) and min(volume_growth) < max(volume_growth) then corr(log_return, volume_growth) end')} as correlation, count(*) as n from feats where log_return is not null and volume_growth is not null group by ticker",
}
QUERIES = {name: f for name, f in list(globals().items()) if name in SQL} | {"sta_02_t_test": sta_02_t_test, "sta_03_pearson_p": sta_03_pearson_p}
