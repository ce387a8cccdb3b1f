"""The text queries without SQL, on articles that name a company only in their contents."""

import datetime as dt

import pytest

from quayline.plans import pipeline, research

ARTICLES = "article_id string, title string, sapo string, content string, detected_tickers array<string>, status string, crawl_at timestamp, updated_at timestamp"
ALIASES = "id bigint, ticker string, alias string, alias_type string, weight double, alias_normalized string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at, out = dt.datetime(2025, 10, 1), tmp_path_factory.mktemp("articles")
    content = "Phiên sáng giao dịch trầm lắng. Doanh thu của AAA tăng mạnh trong quý. Thị trường chung đi ngang cả ngày. Cổ phiếu AAA giảm nhẹ sau đó. Ngân hàng BBB giữ lãi suất."
    rows = [("x", "Thị trường hôm nay", "Nhà đầu tư thận trọng", content, [], "relevant", at, at), ("y", "Tin về AAA trong ngày", None, None, ["AAA"], "relevant", at, at)]
    spark.createDataFrame(rows, ARTICLES).coalesce(1).write.parquet(f"{out}/articles.parquet")
    spark.createDataFrame([(k, t, t, "ticker", 1.0, t.lower()) for k, t in enumerate(("AAA", "BBB"))], ALIASES).coalesce(1).write.parquet(f"{out}/ticker_aliases.parquet")
    return str(out)


def test_pipeline_reads_contents(spark, folder):
    aspects = {tuple(r)[:3] for r in pipeline.udf_10_aspect_rows(spark, folder).collect()}
    assert {("x", "AAA", "business_financials"), ("x", "BBB", "macro_policy"), ("y", "AAA", "business_financials")} <= aspects
    scores = {(r.article_id, r.ticker): r.aspect_count for r in pipeline.inc_04_pipeline_scores(spark, folder).collect()}
    assert set(scores) == {("x", "AAA"), ("x", "BBB"), ("y", "AAA")} and scores["x", "AAA"] >= 2


def test_mentions_contexts_and_scores_of_contents(spark, folder):
    mentions = sorted(tuple(r)[:2] for r in pipeline.jon_14_mentions(spark, folder).collect())
    assert mentions == [("x", "AAA"), ("x", "AAA"), ("x", "BBB"), ("y", "AAA")]
    found = {(r.article_id, r.sentence_index) for r in pipeline.jon_18_company_contexts(spark, folder, "AAA").collect()}
    assert found == {("x", 1), ("x", 3)}
    scores = {r.id: r.confidence for r in research.udf_07_predictions(spark, folder).collect()}
    assert scores == {"x": 0.333333, "y": 1.0}
