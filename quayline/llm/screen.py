"""Text as it is read on screen.

Characters that look the same become the same, invisible ones vanish, every kind of blank becomes a
plain blank. The tables are derived from Unicode properties by rule; only letters that merely look
like another letter have to be listed. ``fold`` is the row-local form that the word-based operators
use; ``unify`` in :mod:`quayline.llm.lookalikes` is the relational operator over the same tables.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections.abc import Iterator

# Letters of other scripts (and rare Latin ones) drawn like a common Latin letter.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ѕ": "S", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѵ": "V", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ү": "y", "ґ": "r", "г": "r",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "Ϝ": "F",
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "υ": "u", "ϲ": "c", "ϳ": "j", "ϱ": "p",
    "Տ": "S", "Օ": "O", "Լ": "L", "Ս": "U", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "յ": "j", "ք": "p",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ı": "i", "ɪ": "i", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʏ": "y",
    "ð": "đ", "Ð": "Đ", "Ɖ": "Đ",
    "‐": "-", "‑": "-", "‒": "-", "−": "-", "﹣": "-", "ꓸ": ".", "․": ".", "∶": ":", "ː": ":", "ǃ": "!", "⁄": "/", "∕": "/", "∣": "|", "ǀ": "|", "‚": ",", "‹": "<", "›": ">",
}
# Compatibility forms whose glyph is that of the plain character.
SAME_GLYPH = {"<wide>", "<narrow>", "<font>", "<noBreak>"}
#: Marks of compatibility forms of several letters: Roman numerals, ligatures, digraphs, the ellipsis.
COMPAT_BLOCKS = ((0x0132, 0x0133), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x2024, 0x2026), (0x2160, 0x217F), (0xFB00, 0xFB06))
BLANK = " "
#: Beyond the last assigned character that has a form of its own or is invisible.
LAST = 0xE0200


def codes() -> Iterator[int]:
    """Code points of the planes with assigned characters, without surrogates, private use and planes that are empty."""
    return itertools.chain(range(0xD800), range(0xF900, 0x33480), range(0xE0000, LAST))


def _invisible(ch: str) -> bool:
    code = ord(ch)
    return (
        unicodedata.category(ch) == "Cf"
        or (unicodedata.category(ch) == "Cc" and ch not in "\t\n\x0b\x0c\r\x85")
        or 0xFE00 <= code <= 0xFE0F
        or 0xE0100 <= code <= 0xE01EF
        or code in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0)
    )


def _one(ch: str) -> str:
    """The fully decomposed screen form of one character."""
    if _invisible(ch):
        return ""
    if ch in "\n  \x85\x0b\x0c":
        return "\n"
    if ch in "\t\r" or unicodedata.category(ch) == "Zs":
        return BLANK
    out = ch
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag in SAME_GLYPH or (tag == "<compat>" and any(a <= ord(ch) <= b for a, b in COMPAT_BLOCKS)):
        out = "".join(chr(int(x, 16)) for x in rest.split())
    out = unicodedata.normalize("NFD", out)
    out = "".join(LOOKALIKES.get(x, x) for x in out)
    return out if out in (ch, BLANK) else unicodedata.normalize("NFD", "".join(_one(x) if x != ch else x for x in out))


@functools.cache
def decompositions() -> dict[int, str]:
    """Code point -> decomposed screen form, of all that change; Hangul syllables are composed alike already.

    The size is that of the Unicode repertoire, not of the data: some 6,000 rows.
    """
    table = {}
    for code in codes():
        if 0xAC00 <= code <= 0xD7A3:
            continue
        ch = chr(code)
        if unicodedata.category(ch) == "Cn":
            continue
        out = _one(ch)
        if out != ch:
            table[code] = out
    return table


@functools.cache
def compositions() -> dict[str, str]:
    """Decomposed cluster -> its one composed character."""
    table = {}
    for code in codes():
        ch = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or not unicodedata.decomposition(ch):
            continue
        full = unicodedata.normalize("NFD", ch)
        if full != ch and len(full) > 1 and unicodedata.normalize("NFC", full) == ch:
            table[full] = ch
    return table


@functools.cache
def unstable() -> list[tuple[int, int]]:
    """Ranges of code points whose screen form differs from themselves even where no mark follows."""
    codes = [c for c, out in decompositions().items() if unicodedata.normalize("NFC", out) != chr(c)]
    ranges: list[list[int]] = []
    for c in sorted(codes):
        if c in (0x0A, 0x20):
            continue
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return [tuple(r) for r in ranges]


@functools.cache
def _suspect() -> frozenset[str]:
    return frozenset(chr(c) for a, b in unstable() for c in range(a, b + 1))


@functools.cache
def _table() -> dict[int, str]:
    return {c: unicodedata.normalize("NFC", out) for c, out in decompositions().items()}


def fold(text: str) -> str:
    """The one screen form of a text. Idempotent; the empty text stays empty."""
    if text.isascii() and text.isprintable():
        return text
    if "\r\n" in text:
        text = text.replace("\r\n", "\n")
    if _suspect().isdisjoint(set(text)):
        return text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
    return unicodedata.normalize("NFC", text.translate(_table()))


@functools.cache
def _words() -> re.Pattern[str]:
    return re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits as read on screen, in lower case."""
    return _words().findall(fold(text).lower())


def one_to_one() -> tuple[dict[int, str], frozenset[str]]:
    """Per-character forms that keep positions, and the invisible characters."""
    table = _table()
    hidden = frozenset(chr(c) for c, out in table.items() if out == "")
    return {c: out for c, out in table.items() if len(out) == 1}, hidden

