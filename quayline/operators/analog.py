"""Pattern forecasts by nearest historical windows, within each series.

Series are bounded by the number of days, so a series is handled as one Arrow group; hot tickers
cannot hold more rows than there are trading days.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

FIELDS = ["log_return", "volume_growth", "sentiment_score"]
SCHEMA = "ticker string, as_of date, signal string, win_rate double, avg_fwd double, median_fwd double, n_analogs int, confidence double, recent_return double, nearest array<int>, distances array<double>, fwd_paths array<array<double>>"


def encode(values: np.ndarray, size: int) -> np.ndarray:
    """All windows of ``size`` rows as vectors, row by row; the first two fields are scaled within the window."""
    windows = np.lib.stride_tricks.sliding_window_view(values, size, axis=0).transpose(0, 2, 1).copy()
    part = windows[:, :, :2]
    mean, std = part.mean(axis=1, keepdims=True), part.std(axis=1, keepdims=True)
    windows[:, :, :2] = np.where(std > 1e-8, (part - mean) / np.where(std > 1e-8, std, 1.0), 0.0)
    return windows.reshape(len(windows), -1)


def encode_by_field(values: np.ndarray, size: int) -> np.ndarray:
    """The same vectors ordered field by field."""
    rows = encode(values, size)
    return rows.reshape(len(rows), size, -1).transpose(0, 2, 1).reshape(len(rows), -1)


def forecast(values: np.ndarray, end: int, size: int = 5, top: int = 15, horizon: int = 5, layout: str = "row_major") -> dict | None:
    """Outcome of the ``top`` windows most like the one that ends at row ``end``.

    Only windows whose outcome lies before ``end`` count; with fewer than ``max(top, 5)`` of them, or
    fewer than five outcomes, there is no forecast. The tail of the vectors from ``2 * size`` on is
    scaled over all candidates.
    """
    last = end - horizon
    count = last + 2 - size
    if end + 1 < size or count < max(top, 5):
        return None
    vectors = (encode if layout == "row_major" else encode_by_field)(values[: end + 1], size)
    known, now = vectors[:count].copy(), vectors[end + 1 - size].copy()
    tail = known[:, 2 * size :]
    mean, std = tail.mean(axis=0), tail.std(axis=0)
    std = np.where(std < 1e-8, 1.0, std)
    known[:, 2 * size :], now[2 * size :] = (tail - mean) / std, (now[2 * size :] - mean) / std
    distance = np.sqrt(((known - now) ** 2).sum(axis=1))
    nearest = np.argsort(distance, kind="stable")[: min(top, count)]
    paths = [values[k + size : k + size + horizon, 0].cumsum() for k in nearest if k + size + horizon <= len(values)]
    if len(paths) < 5:
        return None
    total = np.array([p[-1] for p in paths])
    win, mean_total = float((total > 0).mean()), float(total.mean())
    signal = "BULLISH" if win >= 0.6 and mean_total > 0 else "BEARISH" if win <= 0.4 and mean_total < 0 else "NEUTRAL"
    return {
        "signal": signal,
        "win_rate": win,
        "avg_fwd": mean_total,
        "median_fwd": float(np.median(total)),
        "n_analogs": len(total),
        "confidence": abs(win - 0.5) * 2 * min(1.0, len(total) / top),
        "recent_return": float(values[end + 1 - size : end + 1, 0].sum()),
        "nearest": [int(k) for k in nearest],
        "distances": [float(x) for x in distance[nearest]],
        "fwd_paths": [[float(x) for x in p] for p in paths],
    }


def analog_forecasts(panel: DataFrame, days: int = 1, **settings) -> DataFrame:
    """Forecasts of each ticker as of its last ``days`` rows; panel: ticker, date and the three fields."""

    def per_series(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        values = pdf[FIELDS].astype(float).fillna(0.0).to_numpy()
        rows = []
        for end in range(max(0, len(values) - days), len(values)):
            if (found := forecast(values, end, **settings)) is not None:
                rows.append({"ticker": key[0], "as_of": pdf["date"].iloc[end], **found})
        return pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return panel.select("ticker", "date", *FIELDS).groupBy("ticker").applyInPandas(per_series, SCHEMA)


