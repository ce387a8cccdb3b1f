"""Training-data operators: brute force, exact round trips, held-out accuracy and odd input."""

import base64
import random
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from quayline.llm import furniture, leaks, lookalikes, nearest, neardup, reading, screen, sentences, tokens

DATA = "/root/testdata/sf0.001"
LONG = "Một câu rất dài về thị trường. " * 20_000


def found(df):
    return {tuple(r) for r in df.collect()}


# --- text as read on screen -----------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b"), [("Ｔｈｅｐ １２", "Thep 12"), ("Вất ðộng", "Bất động"), ("ề", "ề"), ("ậ", "ậ"), ("a b　c\td", "a b c d"), ("th​u­ận", "thuận"), ("ﾎﾟｲﾝﾄ", "ポイント"), ("ⅼên Ⅿ", "lên M"), ("ﬁn…", "fin...")])
def test_fold(a, b):
    assert screen.fold(a) == b == screen.fold(screen.fold(a))


def test_fold_keeps_what_differs():
    for a, b in (("a", "A"), ("a", "á"), ("a b", "a  b"), ("x²", "x2"), ("đ", "d"), ("0", "O")):
        assert screen.fold(a) != screen.fold(b)
    assert screen.fold("") == "" and screen.words("Ａ-b_c 1") == ["a", "b", "c", "1"]


def test_unify_is_fold(spark):
    rng = random.Random(1)
    alphabet = "aeoưăđĐ đ̛̣́̀̂​ ａВсｐ…ﬁ\r\n\t한がﾎﾟกำท่\x01\x07🙂ḍ̇"
    texts = ["", *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(300)), "Thị trường " * 5000 + "ｘ"]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)] + [("n", None)], "key string, text string")
    got = {r.key: r.form for r in lookalikes.unify(df, ["key"]).collect()}
    assert "n" not in got and len(got) == len(texts)
    for k, t in enumerate(texts):
        assert unicodedata.normalize("NFC", got[str(k)]) == screen.fold(t), repr(t)


def test_same_on_screen(spark):
    rows = [("t", "1", "Hợp đồng"), ("t", "2", "Hợp ðồng"), ("t", "3", "Hợp đồng"), ("t", "3", "Hợp đồng"), ("t", "4", "hợp đồng"), ("u", "5", "Hợp ðồng"), ("t", "6", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "field string, key string, text string, FORM string")
    assert found(lookalikes.same_on_screen(df)) == {("t", "1", "2"), ("t", "2", "3")}
    assert lookalikes.same_on_screen(df.limit(0)).count() == 0


# --- sentences ------------------------------------------------------------------------------------


def units(text, model=None):
    out, done = [], 0
    for end in sentences.ends(text, model or sentences.learn([])):
        out.append(text[done:end].strip())
        done = end
    return out


def trained(*texts):
    return sentences.learn(list(texts))


@pytest.mark.parametrize(
    "expected",
    [
        ["Giá tăng 3.5% hôm nay.", "Xem tin.abc.example/q4 để biết thêm."],
        ["“Hàng đã kín. Giá giữ nguyên!”, giám đốc nói thêm.", "Câu sau."],
        ['Ông khẳng định: "Giá giữ nguyên."', "Câu sau đó."],
        ["Doanh thu tăng (Đơn hàng kín. Giá giữ.) so với năm ngoái.", "Câu sau."],
        ["公司扩建工厂。", "“出口恢复。新厂运转。”发言人说，预计回升。", "银行收紧贷款！"],
        ["「客は待つ。市場は鈍い。」と担当者は話した。", "株価は上昇した。"],
        ["สาขาเปิดใหม่ 33.1% จากปีก่อน", "สาขาสองปิด"],
        ["Tăng thật?!", "Liệu còn tăng?"],
        ["Sau kiểm toán... quỹ lương giảm mạnh.", "Câu sau đó."],
    ],
)
def test_units(expected):
    model = trained("Giá tăng mạnh hôm nay.\nCâu sau đó.\nLiệu còn tăng?")
    text = " ".join(expected) if expected[0].isascii() or not any("぀" <= c <= "鿿" for c in expected[0]) else "".join(expected)
    assert units(text, model) == expected


def test_units_at_lines_and_without_blanks():
    assert units("Tiêu đề\n\n Câu một dài.Câu hai dài.\r\n") == ["Tiêu đề", "Câu một dài.", "Câu hai dài."]
    assert sentences.ends(None, sentences.learn([])) == [] and sentences.ends("", sentences.learn([])) == [] and units(" \n​\n ") == []


def test_positions_count_invisible_characters():
    text = "A​b­c dài.  Câu hai.​"
    assert [text[e - 1] for e in sentences.ends(text, sentences.learn([]))] == [".", "."]


def test_abbreviations_are_learned():
    lines = [f"Chi nhánh TP. Lạc Viên số {k} mở cửa.\nĐội gồm xe, máy, v.v." for k in range(30)] + ["Đội gồm xe, máy, v.v. Ngày mai họp lại." for _ in range(20)]
    model = trained(*lines)
    assert units("Ở TP. Lạc Viên có kho, xe, v.v. Ngày mai họp.", model) == ["Ở TP. Lạc Viên có kho, xe, v.v.", "Ngày mai họp."]


@pytest.mark.parametrize(
    "expected",
    [
        ["ខ្ញុំទៅផ្សារ។", "គាត់នៅផ្ទះ។"],
        ["ຂ້ອຍໄປຕະຫຼາດ", "ລາວຢູ່ເຮືອນ"],
        ["ကျွန်တော်ဈေးသွားတယ်။", "သူအိမ်မှာရှိတယ်။"],
        ["ወደ ገበያ ሄድኩ።", "እሱ ቤት ነው።"],
        ["میں بازار گیا۔", "وہ گھر پر ہے۔"],
        ["Ես գնացի շուկա։", "Նա տանն է։"],
        ["ང་ཁྲོམ་ལ་ཕྱིན།", "ཁོ་ཁྱིམ་ལ་འདུག།"],
        ["मैं बाज़ार गया।", "वह घर पर है।"],
    ],
)
def test_units_of_other_scripts(expected):
    assert units(" ".join(expected)) == expected


def test_two_words_back_off_to_one():
    """The same word before a mark ends sentences after one word and none after another."""
    lines = [f"Dòng {k} kể về kho số hai.\nHọ ở nhà số. Mười {k} xe." for k in range(40)] + [f"Bài {k} nói đủ con số." for k in range(40)]
    model = trained(*lines)
    assert units("Tôi thấy con số. Mười người.", model) == ["Tôi thấy con số.", "Mười người."]
    assert units("Tôi ở nhà số. Mười người.", model) == ["Tôi ở nhà số. Mười người."]


def test_sentence_query(spark):
    rows = [("a", "Một câu. Hai câu.", None), ("a", "Một câu. Hai câu.", None), ("b", "", " "), ("c", None, LONG), (None, "x", "y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "id string, content string, sapo string, Content2 string")
    got = found(sentences.sentence_ends(df, "id", ["content", "sapo"]))
    assert {g for g in got if g[0] == "a"} == {("a", "content", 8), ("a", "content", 17)}
    assert not [g for g in got if g[0] == "b"] and len([g for g in got if g[0] == "c"]) == 20_000
    assert sentences.sentence_ends(df.limit(0), "id", ["content"]).count() == 0


# --- nearest time ---------------------------------------------------------------------------------


def test_nearest_like_brute_force(spark):
    rng = random.Random(3)
    bars = [(rng.choice("AAAB"), rng.randrange(100_000)) for _ in range(300)] + [("A", 500), ("A", 500), (None, 3), ("A", None)]
    asked = [(str(k), rng.choice("ABC"), rng.randrange(100_000)) for k in range(200)] + [("tie", "D", 50), ("edge", "E", 0), ("none", None, 5), ("none", "A", None)]
    bars += [("D", 40), ("D", 60), ("E", 600)]
    q = spark.createDataFrame(asked + asked[:5], "id string, entity string, us bigint")
    t = spark.createDataFrame([(*b, 1) for b in bars], "entity string, us bigint, US2 int")
    for bucket in (1200, 7000, 10**6):
        got = {(r.id, r.entity): (r.gap, r.bar) for r in nearest.nearest(q, t, 600, bucket).collect()}
        want = {}
        for key, entity, at in asked:
            near = [(abs(b - at), b) for e, b in bars if at is not None and b is not None and e == entity is not None and abs(b - at) <= 600]
            if near:
                want[key, entity] = min(near)
        assert got == want
    assert got["tie", "D"] == (10, 40) and got["edge", "E"] == (600, 600)
    assert nearest.nearest(q, t.limit(0), 600).count() == 0 and nearest.nearest(q.limit(0), t, 600).count() == 0


# --- near-duplicates ------------------------------------------------------------------------------


def texts(rng, n, vocabulary=3000, length=120):
    return [[f"w{rng.randrange(vocabulary)}" for _ in range(length)] for _ in range(n)]


def test_near_duplicates_like_brute_force(spark):
    rng = random.Random(7)
    base = texts(rng, 60)
    for k in range(40):
        copy = list(base[k])
        for _ in range(rng.choice([0, 1, 3, 6, 10, 15])):
            at = rng.randrange(len(copy))
            copy[at : at + rng.choice([0, 1])] = [f"n{rng.randrange(9999)}"]
        base.append(copy)
    rows = {f"d{k:03}": " ".join(w) for k, w in enumerate(base)} | {"e1": "", "e2": None, "s1": "hai từ", "u1": rowsafe(base[0]), "long": LONG}
    df = spark.createDataFrame([(k, t, "x") for k, t in rows.items()] + [("d000", rows["d000"], "x"), (None, "a b c d", "x")], "id string, text string, class_id string")
    sets = {k: set(zip(*(screen.words(t)[j:] for j in range(3)))) for k, t in rows.items() if t}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}
    got = found(neardup.expand(*neardup.near_duplicates(df, "id", "text")))
    assert got <= want and len(want) > 30
    sure = {(a, b) for a, b in want if len(sets[a] & sets[b]) >= 0.56 * len(sets[a] | sets[b])}
    assert sure <= got
    assert neardup.expand(*neardup.near_duplicates(df.limit(0), "id", "text")).count() == 0


@pytest.mark.parametrize(("one", "other"), [(1, 2), (2, 4), (3, 5), (4, 8)])
def test_bits_keep_pairs_of_short_texts(one, other):
    rng, s, n = random.Random(9), neardup.Settings(), 300
    words = [[f"w{rng.randrange(10**9)}" for _ in range(other + 2)] for _ in range(n)]
    rows = [(str(k), " ".join(w[: size + 2])) for k, w in enumerate(words) for size in (one, other)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["id", "text"])
    bits = np.concatenate([np.stack([out.column(f"bits{j}").to_numpy() for j in range(neardup.BIT_WORDS)], axis=1) for out in neardup._sketch(iter([batch]), s)])
    differ = np.cumsum([[int(x).bit_count() for x in row] for row in (bits[::2] ^ bits[1::2]).view(np.uint64)], axis=1)
    most = [64 * k - neardup.fewest(64 * k, (1 + s.threshold) / 2, s.drop) for k in range(1, neardup.BIT_WORDS + 1)]
    assert len(bits) == 2 * n and (differ > most).any(axis=1).sum() <= 1


def test_strict_near_duplicates(spark):
    rng = random.Random(8)
    base = texts(rng, 20)
    near = [[*w[:60], "mới", *w[61:]] for w in base]
    rows = [(f"a{k:02}", " ".join(w)) for k, w in enumerate(base)] + [(f"b{k:02}", " ".join(w)) for k, w in enumerate(near)]
    got = found(neardup.expand(*neardup.near_duplicates(spark.createDataFrame(rows, "id string, text string"), "id", "text", neardup.STRICT)))
    assert got == {(f"a{k:02}", f"b{k:02}") for k in range(20)}


def rowsafe(words):
    return " ".join(words).upper().replace(" ", "  ")


def test_bounds_of_the_posterior():
    s, steps = neardup.Settings(), range(64, 64 * neardup.BIT_WORDS + 1, 64)
    bounds = [neardup.fewest(n, (1 + s.threshold) / 2, s.drop) for n in steps]
    rng = np.random.default_rng(0)
    draws = rng.random((20_000, steps[-1])) < (1 + 0.6) / 2
    for n, least in zip(steps, bounds):
        assert (draws[:, :n].sum(axis=1) < least).mean() < 1e-3
    assert bounds == sorted(bounds) and bounds[-1] < steps[-1] * (1 + s.threshold) / 2


def test_hot_bands_are_cut_into_blocks(spark):
    """A hundred near-equal texts share nearly all bands; blocks of seven lose no pair."""
    rng = random.Random(12)
    base = texts(rng, 1)[0][:80]
    rows = []
    for k in range(100):
        words = list(base)
        words[k % 75] = f"đổi{k}"
        rows.append((f"{k:03}", " ".join(words)))
    df = spark.createDataFrame(rows, "id string, text string")
    members, links = neardup.near_duplicates(df, "id", "text", block=7)
    assert found(neardup.expand(members, links)) == {(f"{a:03}", f"{b:03}") for a in range(100) for b in range(a + 1, 100)}
    got = neardup.groups(members, links).collect()
    assert len({r.group_id for r in got}) == 1 and {r.links for r in got} == {99} and len(got) == 100


def test_components(spark):
    rng = random.Random(3)
    edges = {tuple(sorted(rng.sample(range(400), 2))) for _ in range(180)} | {(k, k + 1) for k in range(500, 640)} | {(700, k) for k in range(701, 760)}
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    want = {(x, top(x)) for e in edges for x in e}
    assert found(neardup.components(spark.createDataFrame(sorted(edges), "class_a bigint, class_b bigint"))) == want
    assert neardup.components(spark.createDataFrame([], "class_a bigint, class_b bigint")).count() == 0


# --- page furniture -------------------------------------------------------------------------------


def test_furniture(spark):
    line = "Chia sẻ bài 12"
    rows = [(f"a{k}", "c", f"Nội dung riêng {chr(97 + k)}\n{line.upper() if k % 2 else line}{k}") for k in range(8)]
    rows += [("a0", "c", rows[0][2]), ("n", None, line), ("x", "d", line), ("e", "c", None), ("z", "c", "\n 12 \n"), ("l", "c", LONG)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, cat string, content string, line int")
    got = found(furniture.furniture_lines(df, "id", "cat", "content"))
    assert got == {(f"a{k}", 2) for k in range(8)}
    clean = {r.id: r.text for r in furniture.without_furniture(df, "id", "cat", "content").collect()}
    assert clean["a3"] == "Nội dung riêng d" and clean["n"] == line and clean["e"] is None and len(clean) == 13
    assert furniture.furniture_lines(df, "id", "cat", "content", least=9).count() == 0
    assert furniture.furniture_lines(df.limit(0), "id", "cat", "content").count() == 0


def test_furniture_needs_its_share(spark):
    rows = [(f"a{k}", "c", "Thông báo" if k < 6 else f"bài {chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(210)]
    df = spark.createDataFrame(rows, "id string, cat string, content string")
    assert furniture.furniture_lines(df, "id", "cat", "content").count() == 0
    assert furniture.furniture_lines(df, "id", "cat", "content", share=6 / 210).count() == 6


# --- tokens ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_are_exact(public):
    encoder = tokens.Encoder(open(f"{tokens.TOKENIZERS}/byte_bpe_50k.json", "rb").read())
    rng = random.Random(2)
    some = ["", " ", "<|endoftext|>", "a" * 5000, " " * 300, "\x00\n\r\n", LONG[:5000], *("".join(rng.choice("abehinorst  ĐđệớZ09'\n.,€の中𝟙🙂") for _ in range(rng.randint(1, 60))) for _ in range(3000))]
    ids, counts = encoder.encode(some)
    at = 0
    for text, n in zip(some, counts):
        assert list(ids[at : at + n]) == public.encode_ordinary(text), repr(text)
        at += n


def test_tokens_query(spark, public):
    rows = [(1, "Xin chào"), (2, None), (3, ""), (1, "Xin chào"), (None, "x"), (5, LONG)]
    df = spark.createDataFrame([(*r, "q") for r in rows], "doc_id bigint, text string, IDS string")
    got = tokens.encode_texts(df, "doc_id", "text").collect()
    assert len(got) == 6
    by = {r.doc_id: list(r.ids) for r in got}
    assert by[2] == by[3] == [] and by[1] == public.encode_ordinary("Xin chào") and by[5] == public.encode_ordinary(LONG)
    assert tokens.encode_texts(df.limit(0), "doc_id", "text").count() == 0


# --- leaks ----------------------------------------------------------------------------------------


def test_leaks_like_brute_force(spark):
    rng = random.Random(11)
    items = {k: " ".join(w) for k, w in enumerate(texts(rng, 30, 400, 40), 1)}
    items[30] = items[1][: len(items[1]) // 2]
    docs = {}
    for k in range(300):
        words = texts(rng, 1, 400, rng.choice([5, 13, 17, 26, 60, 300]))[0]
        if rng.random() < 0.7:
            source = items[rng.randrange(1, 31)].split()
            n = rng.choice([11, 12, 13, 14, 20])
            at = rng.randrange(max(1, len(source) - n))
            put = rng.randrange(len(words) + 1)
            words[put:put] = [w.upper() + rng.choice(["", ",", "\n", ".​"]) for w in source[at : at + n]]
        docs[k] = " ".join(words)
    windows = lambda t: {tuple(w[j : j + 13]) for w in [screen.words(t)] for j in range(len(w) - 12)}
    known = {i: windows(t) for i, t in items.items()}
    want = {(d, i) for d, t in docs.items() for i, w in known.items() if windows(t) & w}
    rows = [(d, t, "x") for d, t in docs.items()] + [(0, docs[0], "x"), (900, None, "x"), (901, "", "x"), (None, docs[1], "x"), (902, LONG, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(*i, "en") for i in items.items()] + [(99, None, "en"), (98, "quá ngắn", "en")], "item_id bigint, text string, lang string")
    assert len(want) > 50 and found(leaks.find_leaks(df, bench)) == want
    assert leaks.find_leaks(df.limit(0), bench).count() == 0 and leaks.find_leaks(df, bench.limit(0)).count() == 0


def test_leaks_of_many_items(spark):
    """Fifty thousand items, one read of the documents; a document quotes every hundredth of them."""
    rng = random.Random(5)
    items = [(k, " ".join(f"w{rng.randrange(5000)}" for _ in range(14))) for k in range(50_000)]
    docs = [(k, f"đầu {items[k * 100][1]} cuối") for k in range(500)]
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id int, text string")
    assert found(leaks.find_leaks(df, bench)) == {(k, k * 100) for k in range(500)}


def test_chance_of_a_miss():
    inside, total = 9, 22
    assert (1 - inside / total) ** leaks.functions(26) <= leaks.MISS and leaks.functions(13) == 1


# --- reading level --------------------------------------------------------------------------------


def test_reading_level_on_held_out_documents(spark):
    documents, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = labels.where("doc_id % 3 = 0")
    levels = {r.doc_id: r.level for r in reading.reading_levels(documents, labels.where("doc_id % 3 <> 0")).collect()}
    rated = [(r.reading_level, levels[r.doc_id]) for r in held.collect() if r.doc_id in levels]
    assert len(rated) > 25
    assert np.mean([a == b for a, b in rated]) > 0.75 and np.mean([abs(a - b) <= 1 for a, b in rated]) > 0.95
    assert np.mean([(a == 4) == (b == 4) for a, b in rated]) > 0.9


def test_other_languages_in_latin_letters_have_no_level(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    foreign = ["Le gouvernement a annoncé hier une réforme des retraites qui devrait entrer en vigueur l'année prochaine.", "Die Bundesregierung hat gestern ein neues Gesetz zur Förderung erneuerbarer Energien beschlossen.", "Pemerintah mengumumkan kebijakan baru untuk meningkatkan ekspor hasil pertanian pada tahun depan."]
    more = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(foreign)], "doc_id bigint, text string")
    levels = {r.doc_id for r in reading.reading_levels(documents.select("doc_id", "text").unionByName(more), labels).collect()}
    assert len(levels) == 877 and min(levels) >= 0


def test_reading_odd_input(spark):
    rows = [(1, "Con mèo vui."), (2, "Phương sai có điều kiện của danh mục phái sinh."), (3, None), (4, ""), (5, "市场交投清淡"), (6, "... 🙂"), (1, "Con mèo vui."), (None, "x"), (7, LONG)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, level int")
    labels = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 4, "a"), (77, 3, "a"), (None, 2, "a"), (2, None, "b")], "doc_id bigint, reading_level int, rater string")
    got = {r.doc_id: r.level for r in reading.reading_levels(docs, labels).collect()}
    assert set(got) == {1, 2, 7} and got[2] > got[1]
    assert reading.reading_levels(docs, labels.limit(0)).count() == 0 and reading.reading_levels(docs.limit(0), labels).count() == 0


# --- queries --------------------------------------------------------------------------------------


def test_queries_run(spark):
    from quayline.llm.queries import queries

    columns = {
        "p1_found": ["article_id", "field", "end_pos"],
        "p2_found": ["field", "key_a", "key_b"],
        "p3_found": ["article_id", "ticker", "bar_us"],
        "p5_found": ["article_a", "article_b"],
        "p6_found": ["article_id", "line_no"],
        "p8_ids": ["doc_id", "ids"],
        "p9_found": ["doc_id", "item_id"],
        "p10_found": ["doc_id"],
    }
    for name, query in queries().items():
        df = query(spark, DATA)
        rows = df.collect()
        if name in columns:
            assert df.columns == columns[name]
            assert len(set(map(str, rows))) == len(rows)


