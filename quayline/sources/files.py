"""File sources: panels, price lists, labelled samples; loose headers, strict types, bad values as nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Other headers of price columns.
SYNONYMS = {"time": "date", "tradingdate": "date", "trading_date": "date", "datetime": "date", "vol": "volume"}
PRICE_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "volume"]
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy"]
#: Name of the column with the place of a row in its file.
SEQUENCE = "_seq"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, headers trimmed, a byte-order mark ignored."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    return rows.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in rows.columns})


def to_day(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS]))


def normalize_prices(rows: DataFrame) -> DataFrame:
    """Price rows with plain headers and types; rows without day, ticker or close dropped, the last row of a key kept.

    Rows of one key are taken in the order of ``_seq`` where there is such a column.
    """
    rows = rows.withColumnsRenamed({c: SYNONYMS.get(c.strip().lower(), c.strip().lower()) for c in rows.columns})
    missing = [c for c in PRICE_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"price columns are missing: {missing}")
    source = F.coalesce("source", F.lit("unknown")) if "source" in rows.columns else F.lit("unknown")
    seq = F.col(SEQUENCE) if SEQUENCE in rows.columns else F.lit(0)
    day = F.col("date") if dict(rows.dtypes)["date"] == "date" else to_day(F.col("date").cast("string"))
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")]
    out = rows.select(day.alias("date"), F.nullif(F.upper(F.trim("ticker")), F.lit("")).alias("ticker"), *numbers, F.col("volume").try_cast("double").cast("bigint").alias("volume"), source.alias("source"), seq.alias(SEQUENCE))
    kept = out.dropna(subset=["date", "ticker", "close"]).groupBy("date", "ticker").agg(F.max(F.struct(SEQUENCE, "close", "volume", "open", "high", "low", "source")).alias("r"))
    return kept.select("date", "ticker", *[f"r.{c}" for c in ("open", "high", "low", "close", "volume", "source")])


def load_panel(spark: SparkSession, path: str, required: list[str] | None = None, numeric: list[str] | None = None, fill_sentiment: float | None = None, news_days_only: bool = False) -> DataFrame:
    """A panel file: required columns checked, tickers and days cleaned, numbers coerced, keyless rows dropped."""
    rows = read_csv(spark, path)
    if "volatility" not in rows.columns and "volatility_5d" in rows.columns:
        rows = rows.withColumn("volatility", F.col("volatility_5d"))
    missing = [c for c in required or [] if c not in rows.columns]
    if missing:
        raise ValueError(f"panel columns are missing: {missing}")
    rows = rows.withColumn("ticker", F.nullif(F.upper(F.trim("ticker")), F.lit(""))).withColumn("date", to_day("date"))
    for c in numeric or []:
        if c in rows.columns:
            value = F.col(c).try_cast("double")
            rows = rows.withColumn(c, F.when(~F.isnan(value), value))
    if fill_sentiment is not None and "sentiment_score" in rows.columns:
        rows = rows.fillna({"sentiment_score": fill_sentiment})
    rows = rows.dropna(subset=["ticker", "date"])
    if news_days_only:
        rows = rows.where(F.coalesce(F.col("news_count").try_cast("double"), F.lit(0.0)) > 0) if "news_count" in rows.columns else rows.limit(0)
    return rows


def first_filled(rows: DataFrame, names: list[str]) -> Column:
    """The first of the columns that is there and not blank."""
    have = {c.lower(): c for c in rows.columns}
    parts = [F.nullif(F.trim(F.col(f"`{have[n]}`").cast("string")), F.lit("")) for n in names if n in have]
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")


def build_master(listing: DataFrame) -> DataFrame:
    """Ticker, company name and sector out of a listing with varying columns."""
    out = listing.select(F.upper(first_filled(listing, ["ticker", "symbol", "code"])).alias("ticker"), first_filled(listing, ["organ_name", "company_name", "full_name", "name"]).alias("company_name"), first_filled(listing, ["icb_name3", "icb_name2", "icb_name1", "com_group_code", "organ_type_code"]).alias("sector"))
    return out.where("ticker is not null").groupBy("ticker").agg(F.max(F.struct("company_name", "sector")).alias("r")).select("ticker", "r.company_name", "r.sector", F.lit(True).alias("is_active"))


def load_samples(spark: SparkSession, path: str, labels: tuple[str, ...] = ("positive", "neutral", "negative")) -> DataFrame:
    """Labelled samples: known labels only, the first text column that is filled."""
    rows = read_csv(spark, path)
    text = first_filled(rows, ["model_input", "context", "text"])
    label = F.lower(first_filled(rows, ["gpt4o_label", "label"]))
    return rows.select(text.alias("text"), label.alias("label")).where(F.col("label").isin(*labels) & F.col("text").isNotNull())


def parse_tickers(text: str | None) -> list[str]:
    return [t.strip().upper() for t in (text or "").split(",") if t.strip()]


def any_of(conditions: list[Column]) -> Column:
    """All of the conditions, of which there may be none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
