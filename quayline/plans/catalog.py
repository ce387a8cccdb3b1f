"""All queries of the core, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import intraday, market, panel, pipeline, reports, research, series, tables, texts

PARTS = (panel, reports, series, intraday, texts, research, tables, pipeline, market)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.prj_01_panel(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.SQL.items()}
