"""Text functions as column expressions; Arrow is used only for Unicode normal forms and HTML entities."""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode as a character class that Java and RE2 read alike.
WS = r"\t\n\x{0b}\f\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Where an article's own text ends, lines that are no text, and phrases cut to the line's end.
STOP_MARKERS = ("Từ Khóa:", "Từ Khóa", "CÙNG CHUYÊN MỤC", "Cùng chuyên mục", "Xem theo ngày", "Công ty Tin tức Lãnh đạo", "Link bài gốc", "Lấy link!", "Đọc thêm", "Tin liên quan")
NOISE_LINES = ("TIN MỚI", "Chia sẻ", "Copy link", "Lấy link!", "Link bài gốc")
BOILERPLATE = (f"Đọc thêm[{WS}]*:.*$", f"Tin liên quan[{WS}]*:.*$", f"Nguồn[{WS}]*:.*$", f"Copy link[{WS}]*$", f"Lấy link![{WS}]*$", f"Link bài gốc[{WS}]+.*$")


def _composed(t: str | None) -> str | None:
    return t if t is None or t.isascii() else unicodedata.normalize("NFC", t)


def _tidy(text: pa.Array) -> pa.Array:
    return pa.array([_composed(html.unescape(t) if t and "&" in t else t) for t in text.to_pylist()], pa.string())


def _nfd(text: pa.Array) -> pa.Array:
    return pc.utf8_normalize(text, form="NFD")


def _nfc(text: pa.Array) -> pa.Array:
    # Arrow's own composed form comes out decomposed
    return pa.array(list(map(_composed, text.to_pylist())), pa.string())


def tidy_unicode(c: Column) -> Column:
    """HTML entities as characters, in composed form."""
    return F.arrow_udf(_tidy, "string")(c)


def nfc(c: Column) -> Column:
    return F.arrow_udf(_nfc, "string")(c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+\\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, f"[{WS}]+", " "))


def collapse_lines(c: Column) -> Column:
    """The same within lines, without blank lines."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t\r\f\x{0b}]+", " "), f"\\n[{WS}]*\\n+", "\n"))


def normalize(c: Column, keep_newlines: bool = False) -> Column:
    """Entities, composed form, plain blanks; null becomes the empty text."""
    c = F.translate(tidy_unicode(F.coalesce(c, F.lit(""))), " ", " ")
    return collapse_lines(c) if keep_newlines else collapse(c)


def remove_marks(c: Column) -> Column:
    """Without combining marks, decomposed; letters with a stroke keep it."""
    return F.regexp_replace(F.arrow_udf(_nfd, "string")(c), r"\p{Mn}+", "")


def remove_accents(c: Column) -> Column:
    """Plain letters: without combining marks and with d for the stroked letter."""
    return nfc(F.translate(remove_marks(F.coalesce(c, F.lit(""))), "đĐ", "dD"))


def let(c: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(c), body), 1)


def truncate_at(c: Column, markers: tuple[str, ...] = STOP_MARKERS) -> Column:
    """Up to the first of the markers."""

    def cut(x: Column) -> Column:
        places = [F.nullif(F.instr(x, m), F.lit(0)) for m in markers]
        return F.substring(x, F.lit(1), F.coalesce(F.least(*places) - 1, F.length(x)))

    return strip(let(c, cut))


def without_noise_lines(c: Column, noise: tuple[str, ...] = NOISE_LINES) -> Column:
    """Lines of three characters or more that are no noise line."""
    lines = F.transform(F.split(c, "\n"), collapse)
    return F.array_join(F.filter(lines, lambda x: (F.length(x) > 2) & ~x.isin(*noise)), "\n")


def without_boilerplate(c: Column) -> Column:
    c = truncate_at(c)
    for pattern in BOILERPLATE:
        c = F.regexp_replace(c, f"(?imdu){pattern}", "")
    return collapse_lines(without_noise_lines(collapse_lines(c)))


def clean(c: Column) -> Column:
    """One line of plain text without tags and boilerplate."""
    tagless = F.regexp_replace(normalize(c, True), "<[^>]+>", " ")
    return collapse(without_boilerplate(collapse_lines(tagless)))


def match_form(c: Column) -> Column:
    """Clean text in lower-case ASCII letters, digits and a few signs."""
    return match_clean(clean(c))


def match_clean(c: Column) -> Column:
    """The same of a text that is clean already."""
    plain = F.lower(remove_accents(c))
    return collapse(F.regexp_replace(plain, f"[^a-z0-9{WS}\\-_/.]", " "))


def plain_lower(c: Column) -> Column:
    """Composed, lower case, single blanks."""
    return collapse(F.lower(nfc(F.coalesce(c, F.lit("")))))


def found_phrases(text: Column, toneless: Column, phrases: list[str]) -> Column:
    """Those of the phrases that occur in the text or, without tone marks, in the toneless text; sorted."""
    def bare(p: str) -> str:
        return "".join(ch for ch in unicodedata.normalize("NFD", p.lower()) if unicodedata.category(ch) != "Mn")

    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(re.sub(r"\s+", " ", p.lower())).alias("a"), F.lit(bare(p)).alias("b")) for p in sorted(set(phrases))])
    return F.transform(F.filter(pairs, lambda x: F.contains(text, x.a) | F.contains(toneless, x.b)), lambda x: x.p)


def sentences(c: Column, least: int = 10) -> Column:
    """Split after a final mark and white space; pieces of ``least`` characters or more, cleaned."""
    parts = F.split(c, f"(?<=[.!?。])[{WS}]+")
    return F.filter(F.transform(parts, strip), lambda x: F.length(x) >= least)


def full_text(*parts: Column) -> Column:
    """Cleaned parts that are not empty, joined as sentences."""
    return F.array_join(F.filter(F.array(*map(clean, parts)), lambda x: x != ""), ". ")


def token_match(text: Column, token: Column) -> Column:
    """Whether an upper-case token stands by itself."""
    return F.regexp_like(text, F.concat(F.lit("(?<![A-Z0-9])\\Q"), token, F.lit("\\E(?![A-Z0-9])")))


# Legal forms in company names.
LEGAL_FORMS = (r"\bCông\s+ty\s+Cổ\s+phần\b", r"\bCong\s+ty\s+Co\s+phan\b", r"\bCTCP\b", r"\bCT\.?\s*CP\b", r"\bJoint\s+Stock\s+Company\b", r"\bJSC\b", r"\bCo\.\s*Ltd\.?\b", r"\bLimited\b", r"\bCorporation\b", r"\bGroup\b")


def short_name(c: Column) -> Column:
    """Company name without legal forms; null where nothing changes or is left."""
    short = F.regexp_replace(c, "(?iuU)" + "|".join(LEGAL_FORMS), "")
    short = collapse(F.regexp_replace(short, "^[ \\-–—]+|[ \\-–—]+\\z", ""))
    return let(short, lambda x: F.when((x != "") & (x != c), x))
