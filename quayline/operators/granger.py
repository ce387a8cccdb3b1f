"""Granger-type tests by series: does a third variable help to foretell the first."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions.stats import f_p

OLS_SCHEMA = "ticker string, window int, n int, f_stat double, p_value double, df_num int, df_den int, status string"
VAR_SCHEMA = "ticker string, lag int, n int, test_stat double, p_value double, status string"


#: Share of the largest pivot under which a column of a design adds nothing.
NOTHING = 1e-10


def explained(y: np.ndarray, blocks: list[np.ndarray]) -> tuple[list[float], list[int], float]:
    """What each block of columns explains of ``y`` beyond the blocks before it, its own rank, and what is left.

    One pass of orthogonalisation: a column is reduced by the directions that are there, twice for
    accuracy, and is a new direction if something of it is left.
    """
    basis = np.empty((len(y), 0))
    left, sums, ranks = y.astype(float), [], []
    for block in blocks:
        before, gained = basis.shape[1], 0.0
        for column in block.T.astype(float):
            size = np.linalg.norm(column)
            for _ in range(2):
                column = column - basis @ (basis.T @ column)
            rest = np.linalg.norm(column)
            if rest <= NOTHING * max(size, 1e-300):
                continue
            direction = column / rest
            basis = np.column_stack([basis, direction])
            part = float(direction @ left)
            left = left - part * direction
            gained += part * part
        sums.append(gained)
        ranks.append(basis.shape[1] - before)
    return sums, ranks, float(left @ left)


def lags(values: np.ndarray, window: int) -> np.ndarray:
    """Columns of the values 1 to ``window`` rows before, column by column; the first rows are NaN."""
    out = []
    for column in values.T:
        for k in range(1, window + 1):
            out.append(np.concatenate([np.full(k, np.nan), column[:-k]])[: len(column)])
    return np.column_stack(out)


def granger(target: np.ndarray, controls: np.ndarray, cause: np.ndarray, window: int, least: int = 30) -> dict:
    """F-test of the lags of ``cause`` next to those of the controls; rows with a null are left out.

    The numerator is what the lags of the cause explain beyond intercept and controls, over its rank.
    """
    known, tested = lags(controls, window), lags(cause[:, None], window)
    whole = np.isfinite(np.column_stack([target, known, tested])).all(axis=1)
    n, width = int(whole.sum()), known.shape[1] + tested.shape[1]
    out = {"n": n, "f_stat": None, "p_value": None, "df_num": window, "df_den": None}
    if n < max(least, width + 5):
        return out | {"status": "too_few_observations"}
    sums, ranks, rest = explained(target[whole], [np.column_stack([np.ones(n), known[whole]]), tested[whole]])
    out |= {"df_num": ranks[1], "df_den": n - sum(ranks)}
    if min(out["df_num"], out["df_den"]) <= 0 or rest <= 0:
        return out | {"status": "invalid_degrees_of_freedom"}
    f = sums[1] / ranks[1] * out["df_den"] / rest
    return out | {"f_stat": f, "p_value": f_p(f, ranks[1], out["df_den"]), "status": "ok"}


def var_causality(values: np.ndarray, lag: int, least: int = 30) -> dict:
    """Wald F-test in a vector autoregression: the lags of the last column in the first equation.

    The test statistic is the Wald statistic over the number of restrictions, its degrees of freedom
    (lag, k (n - lag - k lag - 1)) for k columns and n rows.
    """
    values = values[np.isfinite(values).all(axis=1)]
    n, k = values.shape
    if n < max(least, lag * k + 10):
        return {"n": n, "test_stat": None, "p_value": None, "status": "too_few_observations"}
    x = np.column_stack([np.ones(n - lag)] + [values[lag - j : n - j] for j in range(1, lag + 1)])
    y = values[lag:]
    rows, width = x.shape
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    if rank < width or rows <= width:
        return {"n": n, "test_stat": None, "p_value": None, "status": "failed: singular design"}
    gap = y[:, 0] - x @ beta[:, 0]
    sigma = gap @ gap / (rows - width)
    at = [1 + j * k + k - 1 for j in range(lag)]
    cov = np.linalg.inv(x.T @ x)[np.ix_(at, at)] * sigma
    b = beta[at, 0]
    f = float(b @ np.linalg.solve(cov, b)) / lag
    return {"n": n, "test_stat": f, "p_value": f_p(f, lag, k * (rows - width)), "status": "ok"}


def granger_by_ticker(panel: DataFrame, windows: tuple[int, ...] = (1, 2, 3), least: int = 30) -> DataFrame:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("date")[["log_return", "volume_growth", "sentiment_score"]].astype(float).to_numpy()
        rows = [{"ticker": key[0], "window": w, **granger(v[:, 0], v[:, :2], v[:, 2], w, least)} for w in windows]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in OLS_SCHEMA.split(", ")])

    return panel.select("ticker", "date", "log_return", "volume_growth", "sentiment_score").groupBy("ticker").applyInPandas(run, OLS_SCHEMA)


def var_by_ticker(panel: DataFrame, orders: tuple[int, ...] = (1, 2), least: int = 30) -> DataFrame:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("date")[["log_return", "volume_growth", "sentiment_score"]].astype(float).to_numpy()
        rows = [{"ticker": key[0], "lag": p, **var_causality(v, p, least)} for p in orders]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in VAR_SCHEMA.split(", ")])

    return panel.select("ticker", "date", "log_return", "volume_growth", "sentiment_score").groupBy("ticker").applyInPandas(run, VAR_SCHEMA)
