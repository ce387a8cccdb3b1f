"""Golden rows and properties of the core operators."""

import datetime as dt
import math
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayline.functions import stats, text
from quayline.operators.analog import encode, encode_by_field, forecast
from quayline.operators.asof import forward
from quayline.operators.dictionary import Detector, Linker, contexts, relevance_weight
from quayline.operators.features import price_features
from quayline.operators.granger import granger, var_causality
from quayline.operators.inference import predict
from quayline.operators.learning import chronological_split
from quayline.operators.upsert import last_per_key, raw_only, rebuild, upsert, without_nan, write_days
from quayline.plans.texts import day_first
from quayline.schema import KEYS, TABLES, empty, exists, truncated
from quayline.sources import files, pages
from quayline.streaming.live import live_index, read_state, upsert_stream


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_price_features_golden(spark):
    data = [(100, 105, 95, 10), (110, 112, 104, 20), (99, 108, 98, 0), (99, 99, 99, 40), (0, 5, 0, 50), (120, 121, 118, 60)]
    rows = spark.createDataFrame([("A", dt.date(2025, 1, k + 1), *map(float, d[:3]), d[3]) for k, d in enumerate(data)], "ticker string, date date, close double, high double, low double, volume bigint")
    got = price_features(rows).orderBy("date").collect()
    near = lambda name, want: all((g is None and w is None) or abs(g - w) < 1e-6 for g, w in zip([r[name] for r in got], want))
    assert near("return_1d", [None, 0.1, -0.1, 0.0, -1.0, None])
    assert near("forward_return_1d", [0.1, -0.1, 0.0, -1.0, None, None])
    assert near("volume_change_5d", [1.0, 1.333333, 0.0, 2.285714, 2.083333, 1.764706])
    assert near("log_return", [None, 0.095310, -0.105361, 0.0, None, None])
    assert near("volatility_5d", [None, None, 0.141896, 0.100377, 0.100377, 0.100377])
    assert near("volume_growth", [None, 0.693147, None, None, 0.223144, 0.182322])
    assert near("clv", [0.0, 0.5, -0.8, 0.0, -1.0, 0.333333])


def test_forward_as_of(spark):
    bars = spark.createDataFrame([("A", 1), ("A", 4), ("A", 9), ("B", 3), (None, 2)], "t string, at int")
    asked = spark.createDataFrame([("A", 2), ("A", 9), ("A", 10), ("B", 1), ("C", 1), (None, 1), ("A", None)], "t string, q int")
    for bucket in (1, 2, 100):
        got = {(r.t, r.q): r["at"] for r in forward(asked, bars, "t", "q", "at", bucket).collect()}
        assert got == {("A", 2): 4, ("A", 9): 9, ("A", 10): None, ("B", 1): 3, ("C", 1): None, (None, 1): None, ("A", None): None}


def test_forward_as_of_like_brute_force(spark):
    rng = random.Random(4)
    bars = sorted({(rng.choice("AB"), rng.randrange(1000)) for _ in range(40)})
    asked = [(rng.choice("ABC"), rng.randrange(1100)) for _ in range(200)]
    df = forward(spark.createDataFrame(asked, "t string, q int"), spark.createDataFrame([(*b, b[1] * 2) for b in bars], "t string, at int, v int"), "t", "q", "at", 16, ["v"])
    got = sorted(((r.t, r.q, r["at"], r.v) for r in df.collect()), key=str)
    best = lambda t, q: min((x for e, x in bars if e == t and x >= q), default=None)
    assert got == sorted(((t, q, best(t, q), None if best(t, q) is None else best(t, q) * 2) for t, q in asked), key=str)


def test_safe_correlation(spark):
    rows = spark.createDataFrame([("two", 1.0, 2.0), ("two", 2.0, 3.0), ("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0), ("line", None, 9.0)], "k string, x double, y double")
    got = {r.k: r.c for r in rows.groupBy("k").agg(stats.safe_corr("x", "y").alias("c")).collect()}
    assert got["two"] is None and got["flat"] is None and abs(got["line"] - 1) < 1e-12


def test_p_values():
    assert abs(stats.t_p(1.0, 1) - 0.5) < 1e-12
    assert abs(stats.t_p(2.0, 2) - (1 - 2 / math.sqrt(6))) < 1e-12
    assert abs(stats.f_p(3.0, 2, 2) - 1 / (1 + 3.0)) < 1e-12
    assert abs(stats.f_p(4.0, 1, 7) - stats.t_p(2.0, 7)) < 1e-12


def test_text_functions(spark):
    assert one(spark, text.remove_accents(F.lit("Hòa Phát đ"))) == "Hoa Phat d"
    assert one(spark, text.remove_marks(F.lit("Hòa Phát đ"))) == "Hoa Phat đ"
    assert one(spark, text.sentences(F.lit("Một câu dài hơn. Hai câu dài hơn! Ba?"))) == ["Một câu dài hơn.", "Hai câu dài hơn!"]
    raw = "Tiêu đề &amp; <b>đậm</b>\nChia sẻ\nab\nNguồn: báo khác\n\n\nDòng hai   dài\nĐọc thêm: bài"
    assert one(spark, text.clean(F.lit(raw))) == "Tiêu đề & đậm Dòng hai dài"
    assert one(spark, text.clean(F.lit(None).cast("string"))) == "" and one(spark, text.clean(F.lit(""))) == ""
    assert one(spark, text.short_name(F.lit("CTCP Thép Hải"))) == "Thép Hải" and one(spark, text.short_name(F.lit("Thép"))) is None
    assert one(spark, text.token_match(F.lit("mua FPT, FPTS"), F.lit("FPT"))) and not one(spark, text.token_match(F.lit("fpt FPTS"), F.lit("FPT")))
    assert one(spark, text.full_text(F.lit("A tựa"), F.lit(None).cast("string"), F.lit("nội dung"))) == "A tựa. nội dung"


@pytest.mark.parametrize(("written", "read"), [("23/05/2026 - 07:28", "2026-05-23 07:28:00"), ("23-05-2026 - 07:28 PM", "2026-05-23 19:28:00"), ("12-05-2026 - 12:10 AM", "2026-05-12 00:10:00"), ("2026-05-23T07:28:00", "2026-05-23 07:28:00"), ("3/4/2026", "2026-04-03 00:00:00"), ("nothing", None)])
def test_day_first(spark, written, read):
    assert one(spark, F.date_format(day_first(F.lit(written)), "yyyy-MM-dd HH:mm:ss")) == read


def test_dictionary_matching():
    rows = [("FPT", "FPT", "ticker", 1.0, "fpt"), ("HPG", "Hòa Phát", "short_name", 0.85, "hoa phat"), ("HPG", "HPG", "ticker", 1.0, None)]
    assert Detector(rows).detect("Cổ phiếu Hoa Phat và FPTS") == {"HPG": 0.85}
    assert Detector(rows).detect("mua FPT, HPG; hòa phát") == {"FPT": 1.0, "HPG": 1.0}
    linker = Linker(rows)
    assert [m[2] for m in linker.mentions("HÒA PHÁT và Hòa Phátx, FPT.")] == ["HÒA PHÁT", "FPT"]
    got = contexts(["Đầu.", "Hòa Phát (HPG) tăng.", "Cuối."], linker, {"HPG"})
    assert got == [("HPG", "HPG", "ticker", 1.0, 1, "Đầu. Hòa Phát (HPG) tăng. Cuối.", 0.7)]
    assert contexts(["FPT tăng."], linker, {"HPG"})[0][0] == "FPT"
    assert relevance_weight(0.85, "x" * 79) == 0.595 and relevance_weight(0.05, "x" * 99) == 0.1


def test_any_number_of_aliases(spark, monkeypatch):
    """Aliases in several blocks link the same entities as in one, the two passes over them included."""
    from quayline.operators import dictionary

    names = [("FPT", "FPT", "ticker", 1.0, "fpt"), ("HPG", "Hòa Phát", "short_name", 0.85, "hoa phat"), ("HPG", "Hòa Phát Group", "company_name", 0.9, "x"), ("HPG", "HPG", "ticker", 1.0, None), ("VNM", "Sữa", "short_name", 0.5, "sua"), ("VNX", "Sữa", "short_name", 0.4, "sua")]
    aliases = spark.createDataFrame(names, "ticker string, alias string, alias_type string, weight double, alias_normalized string")
    texts = [("1", ["FPT lên.", "Hòa Phát Group và HPG tăng.", "Sữa đứng giá."], ["HPG"]), ("2", ["Sữa tăng.", "FPT giảm, FPT."], ["ABC"]), ("3", ["Không có gì."], []), ("4", None, None), ("5", ["Sữa và HPG."], [])]
    rows = spark.createDataFrame(texts, "article_id string, sentences array<string>, detected_tickers array<string>")
    one = sorted(map(tuple, dictionary.linked_entities(rows, aliases).collect()))
    monkeypatch.setattr(dictionary, "BLOCK", 2)
    assert sorted(map(tuple, dictionary.linked_entities(rows, aliases).collect())) == one and len(one) == 7


def test_window_encoding():
    rows = np.array([[0.01, 1, 0.2], [0.03, 1, -0.1], [0.02, 1, 0.0]])
    assert np.allclose(encode(rows, 3)[0], [-1.224745, 0, 0.2, 1.224745, 0, -0.1, 0, 0, 0], atol=1e-6)
    assert np.allclose(encode_by_field(rows, 3)[0], [-1.224745, 1.224745, 0, 0, 0, 0, 0.2, -0.1, 0], atol=1e-6)


def test_forecast_bounds():
    values = np.random.default_rng(0).normal(size=(60, 3))
    got = forecast(values, 59)
    assert got["n_analogs"] == 15 and max(got["nearest"]) + 5 - 1 <= 59 - 5 and got["distances"] == sorted(got["distances"])
    assert forecast(values[:20], 19) is None and forecast(values, 3) is None


def test_granger_finds_a_cause():
    rng = np.random.default_rng(1)
    cause, other = rng.normal(size=400), rng.normal(size=400)
    target = np.concatenate([[0.0], 0.8 * cause[:-1]]) + 0.3 * rng.normal(size=400)
    assert granger(target, other[:, None], cause, 2)["p_value"] < 1e-6
    assert granger(target, cause[:, None], other, 2)["p_value"] > 1e-3
    assert granger(target[:10], other[:10, None], cause[:10], 2)["status"] == "too_few_observations"
    assert var_causality(np.column_stack([target, other, cause]), 1)["p_value"] < 1e-6


def test_upsert(spark):
    old = spark.createDataFrame([(1, "raw", "a"), (2, "relevant", "b"), (3, "raw", "c")], "k int, status string, v string")
    new = spark.createDataFrame([(1, "review", "x"), (2, "raw", "y"), (4, "raw", None), (None, "raw", "z")], "k int, status string, v string")
    once = upsert(old, new, ["k"], {"status": raw_only})
    want = {(1, "review", "x"), (2, "relevant", "y"), (3, "raw", "c"), (4, "raw", None)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in upsert(once, new, ["k"], {"status": raw_only}).collect()} == want
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    assert {r.v for r in last_per_key(rows, ["k"], F.desc("seq")).collect()} == {"b", "c"}


def test_rebuild_and_write_days(spark, tmp_path):
    old = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 1)], "day string, v int")
    new = spark.createDataFrame([("2025-01-02", 2), ("2025-01-03", 2), ("2025-01-01", 9)], "day string, v int")
    assert {tuple(r) for r in rebuild(old, new, "day", "2025-01-02").collect()} == {("2025-01-01", 1), ("2025-01-02", 2), ("2025-01-03", 2)}
    path = str(tmp_path / "t")
    write_days(old, path, "day")
    write_days(new.where("day = '2025-01-02'"), path, "day")
    assert {(str(r.day), r.v) for r in spark.read.parquet(path).collect()} == {("2025-01-01", 1), ("2025-01-02", 2)}


def test_no_nan_leaves(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.5, 3)], "x double, k int")
    assert [r.x for r in without_nan(rows).orderBy("k").collect()] == [None, None, 1.5]


def test_schema_registry(spark):
    assert set(KEYS) == set(TABLES)
    assert all(set(KEYS[n]) <= set(empty(spark, n).columns) for n in TABLES)
    assert set(truncated(spark, "article_entities")) == {"article_entities", "entity_aspects", "entity_sentiments"}
    assert not exists(spark, "no_such_table")


def test_files(spark, tmp_path):
    path = tmp_path / "panel.csv"
    path.write_text("﻿date, ticker ,sentiment_score,news_count,volatility_5d\n2025-01-02, fpt ,0.5,1,0.1\nbad,FPT,1,1,1\n2025-01-03,HPG,x,0,\n,HPG,1,1,1\n", encoding="utf-8")
    rows = files.load_panel(spark, str(path), ["ticker", "date"], ["sentiment_score"], 0.0)
    assert sorted((r.ticker, str(r.date), r.sentiment_score, r.volatility) for r in rows.collect()) == [("FPT", "2025-01-02", 0.5, "0.1"), ("HPG", "2025-01-03", 0.0, None)]
    assert files.load_panel(spark, str(path), news_days_only=True).count() == 1
    with pytest.raises(ValueError, match="missing"):
        files.load_panel(spark, str(path), ["nope"])
    assert files.parse_tickers(" a, ,B") == ["A", "B"]


def test_pages():
    html = "<h1>Tựa bài</h1><div class='ads'><p>no</p></div><div class='detail-content'><p>" + "x" * 200 + "</p><script>bad()</script><p>" + "y" * 200 + "</p></div><time datetime='2025-01-02T03:04:05'></time>"
    got = pages.article(html)
    assert got["title"] == "Tựa bài" and got["content"] == "x" * 200 + "\n" + "y" * 200 and got["published"] == "2025-01-02T03:04:05"
    assert pages.article(None)["title"] == "" and pages.article("<p>")["content"] == ""
    page = "<a href='/tin-12.html#c'>Một bài viết rất dài</a><a href='/tin-12.html'>Một bài viết rất dài</a><a href='http://else.example/x-1.html'>Một bài viết rất dài</a><a href='/about'>Một bài viết rất dài</a>"
    assert pages.links(page, "https://tin.example/") == [("https://tin.example/tin-12.html", "Một bài viết rất dài")]


def test_predictions(spark):
    rows = spark.createDataFrame([("1", "giá tăng, vượt"), ("2", "giảm"), ("3", None)], "id string, model_input string")
    got = {r.id: r.sentiment_label for r in predict(rows).collect()}
    assert got == {"1": "positive", "2": "negative", "3": "neutral"}


def test_split_has_an_embargo(spark):
    days = [dt.date(2025, 1, k) for k in range(1, 11)]
    rows = spark.createDataFrame([(d, t) for d in days for t in "AB"], "date date, ticker string")
    train, test = chronological_split(rows, 0.7, 1)
    assert {r.date for r in train.collect()} == set(days[:6]) and {r.date for r in test.collect()} == set(days[7:])
    assert chronological_split(rows.where("date < '2025-01-05'"))[0].count() == 0


def test_streams(spark, tmp_path):
    schema = "ticker string, ts timestamp, sentiment_score double, confidence double"
    rows = [("A", dt.datetime(2025, 1, 1, 5), 0.8, 0.9), ("A", dt.datetime(2025, 1, 1, 6), 0.4, None), ("B", dt.datetime(2025, 1, 2), -0.5, 1.0)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = live_index(stream).writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.ticker, str(r.date)): (round(r.sentiment_index, 6), r.final_sentiment) for r in spark.table("live").collect()}
    assert got == {("A", "2025-01-01"): (0.56, "positive"), ("B", "2025-01-02"): (-0.5, "negative")}
    kind = "k int, seq int, v string"
    steps = [([(1, 1, "a"), (2, 1, "b")], {(1, "a"), (2, "b")}), ([(1, 2, "c")], {(1, "c"), (2, "b")}), ([(3, 1, "d")], {(1, "c"), (2, "b"), (3, "d")}), ([(3, 2, "e")], {(1, "c"), (2, "b"), (3, "e")})]
    for rows, want in steps:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
        changes = spark.readStream.schema(kind).parquet(str(tmp_path / "changes"))
        upsert_stream(changes, str(tmp_path / "state"), ["k"], "seq", str(tmp_path / "cp")).awaitTermination()
        assert {(r.k, r.v) for r in read_state(spark, str(tmp_path / "state")).collect()} == want
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("m")) == ["m2", "m3"]
    shutil.rmtree(tmp_path / "state")
    spark.createDataFrame([(9, 1, "z")], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
    with pytest.raises(Exception, match="no version"):
        upsert_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "changes")), str(tmp_path / "state"), ["k"], "seq", str(tmp_path / "cp")).awaitTermination()



