"""Queries over market prices: rolling totals and implausible values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.rolling import daily, rolling_findings, rolling_totals
from ..operators.spikes import implausible
from ..session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_findings(table(spark, sf_dir, "market_prices"), table(spark, sf_dir, "market_features"))


def p4_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = daily(table(spark, sf_dir, "market_prices"), "close", "volume")
    return rolling_totals(kept, "ticker", "date", "volume").select("ticker", "date", "total_7", "total_30")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return implausible(table(spark, sf_dir, "market_prices"), table(spark, sf_dir, "intraday_prices"))


_KEPT = """kept as (
  select ticker, date, close, volume from (
    select *, row_number() over (partition by ticker, date order by updated_at desc nulls last, close desc nulls last, volume desc nulls last) as rn
    from market_prices where ticker is not null and date is not null) where rn = 1),
span as (select ticker, min(date) as first, max(date) as last from kept group by ticker),
calendar as (select ticker, first, cast(unnest(generate_series(first, last, interval 1 day)) as date) as date from span),
totals as (
  select c.ticker, c.first, c.date, coalesce(sum(case when k.date > c.date - 7 then greatest(k.volume, 0) end), 0)::bigint as total_7,
         coalesce(sum(greatest(k.volume, 0)), 0)::bigint as total_30
  from calendar c left join kept k on k.ticker = c.ticker and k.date between c.date - 29 and c.date
  group by all)"""

SQL = {
    "p4_totals": f"with {_KEPT} select ticker, date, total_7, total_30 from totals",
    "p4_found": f"""with {_KEPT},
steps as (select *, case when close > 0 and lag(close) over w > 0 then ln(close / lag(close) over w) end as step from kept window w as (partition by ticker order by date)),
features as (
  select ticker, date, volume / nullif(avg(volume) over f, 0) as volume_change_5d, stddev_samp(step) over f as volatility_5d
  from steps window f as (partition by ticker order by date rows between 4 preceding and current row)),
stored as (
  select m.ticker, m.date, unnest(['volume_change_5d', 'volatility_5d']) as kind,
         unnest([m.volume_change_5d, m.volatility_5d]) as stored, unnest([f.volume_change_5d, f.volatility_5d]) as correct
  from market_features m join features f on m.ticker = f.ticker and m.date = f.date)
select ticker, strftime(date, '%Y-%m-%d') as day, case when total_7 = 0 then 'idle' else 'surge' end as kind
from totals where date >= first + 29 and ((total_7 = 0 and total_30 > 0) or 2 * total_7 > total_30)
union all
select distinct ticker, strftime(date, '%Y-%m-%d') as day, kind from stored
where abs(stored - correct) > 0.02 * abs(correct) and abs(stored - correct) > 0.0003""",
}
# The definition of problem 7 read directly: hard bounds over whole series, without a model.
SQL["p7_found"] = """with daily as (select * from (
  select *, row_number() over (partition by ticker, date order by updated_at desc nulls last, close desc nulls last, volume desc nulls last, low desc nulls last, high desc nulls last) as rn
  from market_prices where ticker is not null and date is not null) where rn = 1),
bars as (select * from (
  select *, row_number() over (partition by ticker, "interval", ts order by created_at desc nulls last, close desc nulls last, low desc nulls last, high desc nulls last) as rn
  from intraday_prices where ticker is not null and "interval" is not null and ts is not null) where rn = 1),
closes as (
  select 'market_prices.close' as measure, ticker, '1d' as bar_interval, strftime(date, '%Y-%m-%d') as at_time, epoch_us(date) as us, close as v, low, high, 8 as least_run from daily
  union all
  select 'intraday_prices.close', ticker, "interval", strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M:%S'), epoch_us(ts), close, low, high, 12 from bars),
judged as (select *, v <= 0 or coalesce(v > high + 0.001 * abs(high), false) or coalesce(v < low - 0.001 * abs(low), false) as bad from closes where v is not null),
volumes as (select 'market_prices.volume' as measure, ticker, '1d' as bar_interval, strftime(date, '%Y-%m-%d') as at_time, epoch_us(date) as us, volume as v, 6 as least_run, volume < 0 as bad,
  median(volume) over (partition by ticker) as typical from daily where volume is not null),
fit as (
  select measure, ticker, bar_interval, at_time, us, v::double as v, least_run, null as typical from judged where not bad
  union all
  select measure, ticker, bar_interval, at_time, us, v::double, least_run, typical from volumes where not bad),
near as (select *, lag(v) over w as a, lead(v) over w as b, coalesce(v = lag(v) over w and (v > 0 or measure <> 'market_prices.volume'), false) as same
  from fit window w as (partition by measure, ticker, bar_interval order by us)),
series as (select measure, ticker, bar_interval, 1.4826 * median(abs(ln(v / a))) filter (measure <> 'market_prices.volume' and v <> a) as usual, avg(same::int) filter (a is not null) as repeats from near group by all),
runs as (select *, sum(1 - same::int) over (partition by measure, ticker, bar_interval order by us) as run from near),
sized as (select *, count(*) over (partition by measure, ticker, bar_interval, run) as size from runs)
select measure, ticker, bar_interval, at_time from judged where bad
union all select measure, ticker, bar_interval, at_time from volumes where bad
union all
select r.measure, r.ticker, r.bar_interval, r.at_time from sized r join series s on s.measure = r.measure and s.ticker = r.ticker and s.bar_interval = r.bar_interval
where (same and size >= least_run and repeats < 0.4)
  or (r.measure = 'market_prices.volume' and typical > 0 and v > 20 * typical)
  or (r.measure <> 'market_prices.volume' and (v > a) = (v > b) and v <> a and v <> b and least(abs(ln(v / a)), abs(ln(v / b))) > 7 * usual)"""
QUERIES = {f.__name__: f for f in (p4_found, p4_totals, p7_found)}
