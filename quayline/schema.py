"""Schemas and keys of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_NUMBERS = ", ".join(f"{n} double" for n in ("return_1d", "return_3d", "return_5d", "forward_return_1d", "forward_return_3d", "forward_return_5d", "volume_change_5d", "volatility_5d", "log_return", "volume_growth", "clv"))
TABLES = {
    "articles": "article_id string, url string, title string, sapo string, content string, category string, crawl_at timestamp, published_at timestamp, status string, content_hash string, detected_tickers array<string>, error_message string, created_at timestamp, updated_at timestamp",
    "article_relevance": "article_id string, relevance_type string, relevance_score double, decision string, reason string, detected_tickers array<string>, detected_keywords array<string>, created_at timestamp",
    "ticker_master": "ticker string, company_name string, sector string, is_active boolean, created_at timestamp, updated_at timestamp",
    "ticker_aliases": "id int, ticker string, alias string, alias_type string, weight double, alias_normalized string, created_at timestamp",
    "article_entities": "id bigint, article_id string, ticker string, entity_text string, alias_type string, alias_weight double, sentence_index int, context string, relevance_weight double, created_at timestamp",
    "entity_aspects": "id bigint, entity_id bigint, aspect string, aspect_keywords array<string>, aspect_score double, model_input string, created_at timestamp",
    "entity_sentiments": "id bigint, entity_aspect_id bigint, entity_id bigint, article_id string, ticker string, aspect string, sentiment_label string, sentiment_score double, confidence double, prob_negative double, prob_neutral double, prob_positive double, model_version string, inference_status string, error_message string, created_at timestamp",
    "article_ticker_sentiment": "article_id string, ticker string, sentiment_score double, final_sentiment string, confidence double, aspect_count int, positive_count int, neutral_count int, negative_count int, created_at timestamp, updated_at timestamp",
    "daily_sentiment_index": "date date, ticker string, sector string, sentiment_index double, final_sentiment string, article_count int, positive_count int, neutral_count int, negative_count int, avg_confidence double, trust_level string, created_at timestamp",
    "market_prices": "date date, ticker string, open double, high double, low double, close double, volume bigint, source string, created_at timestamp, updated_at timestamp",
    "market_features": f"date date, ticker string, close double, volume bigint, {_NUMBERS}, created_at timestamp",
    "intraday_prices": "ts timestamp, ticker string, interval string, open double, high double, low double, close double, volume bigint, source string, created_at timestamp",
}
KEYS = {
    "articles": ["article_id"],
    "article_relevance": ["article_id"],
    "ticker_master": ["ticker"],
    "ticker_aliases": ["ticker", "alias"],
    "article_entities": ["article_id", "ticker", "sentence_index"],
    "entity_aspects": ["entity_id", "aspect"],
    "entity_sentiments": ["entity_aspect_id", "model_version"],
    "article_ticker_sentiment": ["article_id", "ticker"],
    "daily_sentiment_index": ["date", "ticker"],
    "market_prices": ["date", "ticker"],
    "market_features": ["date", "ticker"],
    "intraday_prices": ["ts", "ticker", "interval"],
}
#: Tables that are emptied together with another.
CASCADE = {"article_entities": ["entity_aspects", "entity_sentiments"], "entity_aspects": ["entity_sentiments"]}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def truncated(spark: SparkSession, *names: str) -> dict[str, DataFrame]:
    """Empty frames of the tables and of all that hang on them."""
    wanted = dict.fromkeys(names)
    for name in names:
        wanted.update(dict.fromkeys(CASCADE.get(name, [])))
    return {name: empty(spark, name) for name in wanted}


def exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view of that name is there."""
    return spark.catalog.tableExists(name)
