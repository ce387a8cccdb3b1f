"""Queries of the training-data operators; each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .furniture import furniture_lines, without_furniture
from .leaks import find_leaks
from .lookalikes import same_on_screen
from .neardup import expand, groups, near_duplicates
from .nearest import nearest
from .reading import reading_levels
from .sentences import sentence_ends
from .tokens import encode_texts


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_ends(table(spark, sf_dir, "articles"), "article_id", ["content", "sapo"]).withColumnRenamed("id", "article_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles, aliases = table(spark, sf_dir, "articles"), table(spark, sf_dir, "ticker_aliases")
    fields = F.explode(F.array(*[F.struct(F.lit(f"articles.{c}").alias("field"), F.col(c).alias("text")) for c in ("title", "content")])).alias("f")
    texts = articles.select(F.col("article_id").alias("key"), fields).select("f.field", "key", "f.text")
    names = aliases.select(F.lit("ticker_aliases.alias_normalized").alias("field"), F.col("id").cast("string").alias("key"), F.col("alias_normalized").alias("text"))
    return same_on_screen(texts.unionByName(names).where("text <> ''"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = table(spark, sf_dir, "article_ticker_sentiment").select("article_id", "ticker").distinct()
    times = table(spark, sf_dir, "articles").where("published_at is not null").groupBy("article_id").agg(F.min("published_at").alias("published_at"))
    asked = linked.join(times, "article_id").select(F.col("article_id").alias("id"), F.col("ticker").alias("entity"), F.unix_micros("published_at").alias("us"))
    bars = table(spark, sf_dir, "intraday_prices").select(F.col("ticker").alias("entity"), F.unix_micros("ts").alias("us"))
    return nearest(asked, bars, 600 * 1_000_000).select(F.col("id").alias("article_id"), F.col("entity").alias("ticker"), F.col("bar").alias("bar_us"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, links = near_duplicates(table(spark, sf_dir, "articles"), "article_id", "content")
    return expand(members, links).toDF("article_a", "article_b")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article with words enough, its class of equal contents, its group of near-equal ones and its number of links."""
    return groups(*near_duplicates(table(spark, sf_dir, "articles"), "article_id", "content")).withColumnRenamed("id", "article_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return furniture_lines(table(spark, sf_dir, "articles"), "article_id", "category", "content").toDF("article_id", "line_no")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_furniture(table(spark, sf_dir, "articles"), "article_id", "category", "content").toDF("article_id", "content")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("level = 4").select("doc_id")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p5_found, p5_groups, p6_found, p6_clean, p8_ids, p9_found, p10_found, p10_levels)}


SQL = {
    "p3_found": """with linked as (select distinct article_id, ticker from article_ticker_sentiment),
times as (select article_id, min(epoch_us(published_at)) as us from articles where published_at is not null group by article_id),
bars as (select distinct ticker, epoch_us(ts) as bar_us from intraday_prices),
near as (select l.article_id, l.ticker, b.bar_us, row_number() over (partition by l.article_id, l.ticker order by abs(b.bar_us - t.us), b.bar_us) as k
  from linked l join times t using (article_id) join bars b on b.ticker = l.ticker and b.bar_us between t.us - 600000000 and t.us + 600000000)
select article_id, ticker, bar_us from near where k = 1""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
