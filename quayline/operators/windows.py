"""Window operators over ordered series; nulls stay null, nothing is ever NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def shifted(x: str, by: int, w: WindowSpec) -> Column:
    """The value ``by`` rows earlier; later for a negative number."""
    return F.lag(x, by).over(w) if by >= 0 else F.lead(x, -by).over(w)


def lag_matrix(df: DataFrame, columns: list[str], lags: int, w: WindowSpec) -> DataFrame:
    """Adds ``column_lag_k`` for k from 1 to ``lags``, in one sort."""
    return df.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in range(1, lags + 1)])


def forward_sum(x: Column, horizon: int, w: WindowSpec) -> Column:
    """Sum of the next ``horizon`` rows; null unless all are there."""
    ahead = w.rowsBetween(1, horizon)
    return F.when(F.count(x).over(ahead) == horizon, F.sum(x).over(ahead))


def rolling_past(df: DataFrame, columns: list[str], size: int, w: WindowSpec) -> DataFrame:
    """Mean, deviation and last value of the ``size`` rows before; null under ``max(3, size // 3)`` values."""
    past, least = w.rowsBetween(-size, -1), max(3, size // 3)
    out = []
    for c in columns:
        enough = F.count(c).over(past) >= least
        out += [F.when(enough, F.avg(c).over(past)).alias(f"{c}_mean"), F.when(enough, F.stddev_samp(c).over(past)).alias(f"{c}_std"), F.lag(c).over(w).alias(f"{c}_last")]
    return df.select("*", *out)


def encoded_windows(df: DataFrame, size: int, w: WindowSpec, scaled: list[str], raw: list[str]) -> DataFrame:
    """Adds ``vector``: the last ``size`` rows, row by row, each with its scaled and raw columns.

    Scaled columns are centred and divided by the population deviation within the window, and 0 where
    that is at most 1e-8. Null while the window is not full.
    """
    frame = w.rowsBetween(-(size - 1), 0)
    full = df.withColumn("_rows", F.collect_list(F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in (*scaled, *raw)])).over(frame))
    for c in scaled:
        v = F.col(f"_rows.{c}")
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / size
        full = full.withColumn(f"_mean_{c}", mean)
        full = full.withColumn(f"_std_{c}", F.sqrt(F.aggregate(F.transform(v, _square_gap(f"_mean_{c}")), F.lit(0.0), lambda a, x: a + x) / size))
    cell = lambda r: F.array(*[F.when(F.col(f"_std_{c}") > 1e-8, (r[c] - F.col(f"_mean_{c}")) / F.col(f"_std_{c}")).otherwise(0.0) for c in scaled], *[r[c] for c in raw])
    vector = F.when(F.size("_rows") == size, F.flatten(F.transform("_rows", cell)))
    return full.withColumn("vector", vector).drop("_rows", *[f"_{k}_{c}" for k in ("mean", "std") for c in scaled])


def _square_gap(mean: str):
    return lambda x: (x - F.col(mean)) * (x - F.col(mean))


def running_path(x: str, horizon: int, w: WindowSpec) -> Column:
    """Cumulative sums of the next ``horizon`` rows, as an array; null unless all are there."""
    ahead = w.rowsBetween(1, horizon)
    got = F.collect_list(x).over(ahead)
    sums = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: F.aggregate(F.slice(got, F.lit(1), k), F.lit(0.0), lambda a, y: a + y))
    return F.when(F.count(x).over(ahead) == horizon, sums)


__all__ = ["encoded_windows", "forward_sum", "lag_matrix", "rolling_past", "running_path", "shifted", "Window"]
