"""Sentence units of texts in any language, by a hidden-event n-gram model.

Between words lie slots that may hold a hidden boundary event: runs of final marks of any script with
the quotes and brackets closing there, in scripts without sentence marks (Thai, Lao) the blanks between
two letters, and line ends. The model scores the words about a slot: how often the word before it, and
the two words before it, end a line of the corpus against how often they stand before a mark inside
lines (two words back off to one, one to its shape), and how often the word after it begins lines
against how often it occurs inside. Line ends are the boundaries that need no guessing, so the whole
corpus trains the model without labels. What the definition of a unit says of a slot (a line end, an
ideographic full stop, a blank between Thai letters, a small letter after a mark) is its prior, of
``SURE`` log odds. A forward-backward pass over all slots of a line gives the posterior of each event,
where two boundaries about a single word are as likely as lines of one word are; a slot is a boundary
at 0.5 or more.

Texts are read once: their slots and the n-grams they count are written, the counts are summed, and the
slots are scored in whole batches. Speech in quotes and remarks in brackets belong to the sentence
around them: slots inside matched pairs are none; speech that opens a unit goes on to the words that
report it. Words whose every count is under a share of ``SHARE`` of its kind are scored by their shape
alone, which bounds the model that is sent to the tasks; the model keeps all counts of a word or none.

Null, empty and blank texts have no units; repeated rows give their units once; positions count code
points of the text as stored, invisible characters included.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import screen
from .arrow import WordHashes, batches, lists, narrow

SHARE = 1e-5
#: Weight of a word's shape, and of one word where two are counted, in observations.
PRIOR, BACK = 2.0, 10.0
#: Log odds of what the definition settles.
SURE = 40.0

#: Marks that end sentences, by Unicode's property; the Burmese one that is a comma is none.
_ENDING = frozenset(c for c in map(chr, range(0xFFFF)) if regex.match(r"\p{STerm}", c) and c != "၊") | frozenset("…།༎")
_PLAIN = frozenset(".…")
_LOUD = frozenset(c for c in _ENDING if set(unicodedata.normalize("NFKC", c)) <= set("!?")) | {"؟"}
_MARKS = re.escape("".join(sorted(_ENDING)))
_BARE = "฀-๏๚-๿຀-໏ໜ-໿"
_SLOT = re.compile(rf"(?P<mark>[{_MARKS}]+)|(?P<blank>(?<=[{_BARE}])[^\S\n]+(?=[{_BARE}]))")
_PAIRS = {"(": ")", "[": "]", "{": "}", "“": "”", "「": "」", "『": "』", "«": "»", "《": "》", "【": "】", "„": "”", "〈": "〉"}
_CLOSERS = set(_PAIRS.values()) | {'"'}
_CLOSING = "".join(_CLOSERS) + " "
_BRACKETS = set("([{【")
_ANY_PAIR = re.compile('["' + "".join(re.escape(x) for x in {**_PAIRS, **{v: v for v in _PAIRS.values()}}) + "]")
_RUN = r"[^\W_](?:[^\W_]|[\u0300-\u036f])*"
_WORD_AFTER = re.compile(rf"{_RUN}(?:[.&'’-]{_RUN})*")
_UPPER = re.escape("".join(c for c in map(chr, range(0x3000)) if c.isupper()))
#: Words with a capital after a word and a blank.
_INNER = re.compile(rf"[{_UPPER}](?<=[^.!?…。:\"“「(\s]\s.)(?:[^\W_]|[\u0300-\u036f])*")
_INSIDE = frozenset(".&'’-")
_GOES_ON = set(",;:、-–—/%)]}>=+*~|&")
# kinds of slots
BLANK, DOT, DOTS, SHOUT, FULL, CLOSE, LINE = range(7)
# kinds of n-grams: before the final mark of a line, before one inside, first of a line, inside with a
# capital; the first two for two words; lines and lines of one word
END, MID, FIRST, INNER, END2, MID2, LINES, LONE = range(8)
_MASK = (1 << 64) - 16
#: A slot as it is written: place of the unit's last character, kind, whether one word or less lies between it and
#: the slot before, log odds by definition (NaN: by the model), shape of the word before, what is known of the next
#: word (NaN: by the model), hashes of the word before, of the two before, of the word after.
SLOT = np.dtype([("pos", "<i4"), ("kind", "i1"), ("lone", "i1"), ("lean", "<f4"), ("shape", "<f4"), ("fixed", "<f4"), ("left", "<i8"), ("left2", "<i8"), ("right", "<i8")])
_HASHES = WordHashes()


class View:
    """A text with positions: look-alikes made plain, invisible characters left out."""

    def __init__(self, text: str) -> None:
        table, hidden = _maps()
        self.shown = text.translate(table)
        self.places: list[int] | None = None
        if len(self.shown) != len(text):
            self.places = [k for k, ch in enumerate(text) if ch not in hidden]

    def place(self, k: int) -> int:
        """0-based place in the stored text."""
        return k if self.places is None else self.places[k]


@functools.cache
def _maps() -> tuple[dict[int, str | None], frozenset[str]]:
    single, hidden = screen.one_to_one()
    table: dict[int, str | None] = {c: out for c, out in single.items() if not unicodedata.combining(out)}
    table.update({ord(ch): None for ch in hidden})
    return table, hidden


def _plain(word: str) -> str:
    return word if word.isascii() else unicodedata.normalize("NFC", word)


def _back(line: str, end: int) -> int:
    """Where the word that ends before ``end`` begins; ``end`` where there is none."""
    at = end
    while at:
        ch = line[at - 1]
        if not (ch.isalnum() or "\u0300" <= ch <= "\u036f" or (ch in _INSIDE and at < end and at > 1 and line[at - 2].isalnum())):
            break
        at -= 1
    while at < end and not line[at].isalnum():
        at += 1
    return at


def before(line: str, end: int) -> tuple[str, int]:
    """What stands before a mark: a word, # for a number, or a sign such as %; and where it begins."""
    at = _back(line, end)
    if at == end:
        return line[end - 1 : end].strip(), max(0, end - 1)
    word = line[at:end]
    return (_plain(word) if any(map(str.isalpha, word)) else "#"), at


def shape(word: str) -> float:
    """Probability that a mark after a word of this shape ends a sentence."""
    if not word or word == "#":
        return 0.5
    if not word[0].isalnum():
        return 0.9
    if len(word) == 1 and word.isalpha():
        return 0.05
    if "." in word:
        return 0.2
    if word.isupper() and len(word) <= 3:
        return 0.3
    if word[0].isupper() and len(word) <= 3:
        return 0.4
    return 0.9


def _named(word: str) -> int:
    """Hash of a word, its lower four bits free for a kind."""
    return _HASHES[word] & _MASK


def _named2(line: str, at: int, word: str) -> int:
    """Hash of the word before ``at`` and the one that follows it; 0 where there is none before."""
    end = at
    while end and line[end - 1] == " ":
        end -= 1
    first = before(line, end)[0] if end and end < at else ""
    return (_HASHES[first] * 0x9E3779B97F4A7C15 ^ _HASHES[word]) & _MASK if first else 0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def enclosed(line: str) -> list[tuple[int, int]]:
    """Outermost matched pairs of quotes or brackets, as places of opener and closer."""
    stack: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []
    for m in _ANY_PAIR.finditer(line):
        ch, at = m.group(), m.start()
        if ch == '"':
            opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if opened is None:
                stack.append(('"', at))
                continue
        elif ch in _PAIRS:
            stack.append((_PAIRS[ch], at))
            continue
        else:
            opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == ch), None)
            if opened is None:
                continue
        found.append((stack[opened][1], at))
        del stack[opened:]
    found.sort()
    out: list[tuple[int, int]] = []
    for a, b in found:
        if not out or a > out[-1][1]:
            out.append((a, b))
    return out


def _opens_unit(line: str, at: int) -> bool:
    ahead = line[:at].rstrip()
    while ahead and ahead[-1] in _CLOSERS:
        ahead = ahead[:-1].rstrip()
    return not ahead or ahead[-1] in _ENDING


def slots(line: str, at: int, view: View, out: list[tuple], seen: set[int]) -> None:
    """Adds the slots inside a line that begins at ``at``, from left to right, and the n-grams before those that are open."""
    pairs = enclosed(line) if _ANY_PAIR.search(line) else []
    last = len(line.rstrip())
    k, done, word_at = 0, 0, 0
    for m in _SLOT.finditer(line):
        start, end = m.span()
        if start < done:
            continue
        while k < len(pairs) and pairs[k][1] < start:
            k += 1
        inside = k < len(pairs) and pairs[k][0] < start
        if m.lastgroup == "blank":
            if not inside:
                out.append((view.place(at + start - 1) + 1, BLANK, 0, SURE, 0, 0, 0, 0, 0))
            continue
        mark = m.group()
        kind = DOT if mark == "." else FULL if not _PLAIN.issuperset(mark) and not (_PLAIN | _LOUD).issuperset(mark) else SHOUT if not _PLAIN.issuperset(mark) else DOTS
        if inside:
            opener, closer = pairs[k]
            if line[end:closer].strip() and any(c not in _CLOSERS for c in line[end:closer]):
                continue
            if (line[opener] in _BRACKETS) != _opens_unit(line, opener):
                continue  # a remark inside a sentence, or speech before the words that report it
            end, kind = closer + 1, CLOSE
        while end < last and line[end] in _CLOSERS and not any(a == end for a, _ in pairs[k : k + 2]):
            end += 1
        if end >= last:
            break
        done = end
        rest = end
        while line[rest].isspace():
            rest += 1
        spaced, ch = rest > end, line[rest]
        if kind == DOT and not spaced and ch.isdigit() and line[start - 1 : start].isdigit():
            continue  # within a number or a date
        lean = np.nan
        if ch in _GOES_ON or ch.islower() or (not spaced and unicodedata.category(ch) in ("Mn", "Mc")):
            lean = -SURE
        elif not spaced and kind == DOT and (ch.isdigit() or not line[start - 1 : start].strip()):
            lean = -SURE
        elif kind == CLOSE and ch in "とっ":
            lean = -SURE
        elif kind in (FULL, CLOSE):
            lean = SURE
        elif kind == SHOUT and not ch.isascii() and unicodedata.category(ch) == "Lo":
            lean = SURE
        lone = kind == DOT and line.find(" ", word_at, start) < 0
        word_at = rest
        left, fixed, form, h1, h2, h3 = "", 0.0, 0.0, 0, 0, 0
        if kind in (DOT, DOTS) and lean != SURE:
            left, begin = before(line, start)
            if left:
                h1, h2 = _named(left), _named2(line, begin, left)
                seen.add(h1 | MID)
                if h2:
                    seen.add(h2 | MID2)
        if lean != lean:
            form = shape(left)
            w = _WORD_AFTER.match(line, rest)
            word = w.group() if w else ch
            if word[0].isalpha():
                fixed, h3 = np.nan, _named(_plain(word))
            else:
                fixed = 2.0 if word[0] in '"“「『«' else -1.0
        out.append((view.place(at + end - 1) + 1, kind, lone, lean, form, fixed, _signed(h1), _signed(h2), _signed(h3)))


def lines(shown: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in shown.split("\n"):
        if line and not line.isspace():
            yield at, line
        at += len(line) + 1


def slotted(text: str) -> tuple[np.ndarray, list[int]]:
    """All slots of a text, and its n-grams, each once: a text that repeats itself counts no more than others."""
    view, out, seen = View(text), [], set()
    for at, line in lines(view.shown):
        slots(line, at, view, out, seen)
        body = line.rstrip()
        out.append((view.place(at + len(body) - 1) + 1, LINE, 0, SURE, 0, 0, 0, 0, 0))
        tail = body.rstrip(_CLOSING)
        if tail[-1:] in _PLAIN:
            end = len(tail.rstrip(".…"))
            word, begin = before(tail, end) if end else ("", 0)
            if word:
                seen.add(_named(word) | END)
                if pair := _named2(tail, begin, word):
                    seen.add(pair | END2)
            seen.add((1 << 32) | LINES)
            if " " not in body.strip():
                seen.add((1 << 32) | LONE)
        if w := _WORD_AFTER.match(line, len(line) - len(line.lstrip())):
            seen.add(_named(_plain(w.group())) | FIRST)
        for word in _INNER.findall(line):
            seen.add(_named(_plain(word)) | INNER)
    return np.array(out, SLOT), [_signed(x) for x in seen]


class Model:
    """Counts of words by hash, and the scores they give; sums of counts keep their shares whatever the size."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
        order = np.argsort(words)
        self.words = np.concatenate([words[order], [np.iinfo(np.int64).max]])
        self.counts = np.concatenate([counts[order].astype(float), np.zeros((1, LONE + 1))])
        self.totals = np.maximum(1.0, totals)
        # of the boundaries after an ordinary word, the share that ends a line
        ends, mids = self.counts[:, END], self.counts[:, MID]
        usual = ends >= 3
        self.rate = max(0.02, ends[usual].sum() / (ends + mids)[usual].sum()) if usual.any() else 0.3
        # how likely a unit of a single word is
        self.lone = float(np.clip((totals[LONE] + 1) / (totals[LINES] + 20), 0.01, 0.5))

    def of(self, words: np.ndarray, *kinds: int) -> tuple[np.ndarray, ...]:
        at = np.searchsorted(self.words, words)
        hit = (self.words[at] == words) & (words != 0)
        return tuple(np.where(hit, self.counts[at, k], 0.0) for k in kinds)

    def scores(self, s: np.ndarray) -> np.ndarray:
        """Log odds of a boundary in each slot, neighbours aside."""
        out = s["lean"].astype(float)
        own = np.flatnonzero(np.isnan(out))
        if not len(own):
            return out
        s = s[own]
        end, mid = self.of(s["left"], END, MID)
        p = (np.minimum(end + mid, end / self.rate) + PRIOR * s["shape"]) / (end + mid + PRIOR)
        end, mid = self.of(s["left2"], END2, MID2)
        # two words are rare: that they never end a line may be chance, so their ends count two deviations more
        likely = end + 2 * np.sqrt(end + 1)
        p = (np.minimum(end + mid, likely / self.rate) + BACK * p) / (end + mid + BACK)
        p = np.clip(p, 0.002, 0.998)
        first, inner = self.of(s["right"], FIRST, INNER)
        ratio = np.where(first + inner >= 5, np.log((first + 1) / (inner + 1) * self.totals[INNER] / self.totals[FIRST]), 0.5)
        right = np.where(np.isnan(s["fixed"]), np.clip(ratio, -2.5, 2.5), s["fixed"])
        # an ellipsis inside a sentence is followed by a small letter, which is settled already
        scored = np.log(p / (1 - p)) + 0.7 * right + np.where(s["kind"] == DOTS, 1.5, 0.0)
        out[own] = np.where(s["kind"] == SHOUT, 4.0 + 0.5 * right, scored)
        return out

    def boundaries(self, s: np.ndarray) -> np.ndarray:
        """Which slots of whole texts are boundaries: forward-backward by line, all lines of a length at once."""
        odds = np.exp(np.clip(self.scores(s), -SURE, SURE))
        lone = np.where(s["lone"] != 0, self.lone, 1.0)
        stop = np.flatnonzero(s["kind"] == LINE) + 1
        start = np.concatenate([[0], stop[:-1]])
        out = np.zeros(len(s), bool)
        sizes = stop - start
        for size in np.unique(sizes):
            at = start[sizes == size][:, None] + np.arange(size)
            out[at] = self.posteriors(odds[at], lone[at]) >= 0.5
        return out

    @staticmethod
    def posteriors(odds: np.ndarray, lone: np.ndarray) -> np.ndarray:
        """Forward-backward over two states, none and boundary; one row a line, which begins after a boundary."""
        n, size = odds.shape
        ahead, out = np.empty((size, 2, n)), np.empty((n, size))
        none, cut = np.zeros(n), np.ones(n)
        for k in range(size):
            none, cut = none + cut, (none + cut * lone[:, k]) * odds[:, k]
            total = none + cut
            none, cut = none / total, cut / total
            ahead[k] = none, cut
        none, cut = np.ones(n), np.ones(n)
        for k in range(size - 1, -1, -1):
            a, b = ahead[k, 0] * none, ahead[k, 1] * cut
            out[:, k] = b / (a + b)
            none, cut = none + odds[:, k] * cut, none + odds[:, k] * lone[:, k] * cut
            total = none + cut
            none, cut = none / total, cut / total
        return out


def learn(texts: list[str]) -> Model:
    """The model of a few texts, without Spark."""
    keys, n = np.unique(np.concatenate([np.empty(0, np.int64), *[np.array(slotted(t)[1], np.int64) for t in texts if t]]), return_counts=True)
    words, place = np.unique(keys & ~np.int64(15), return_inverse=True)
    counts = np.zeros((len(words), LONE + 1))
    counts[place, keys & 15] = n
    return Model(words, counts, counts.sum(axis=0))


def ends(text: str | None, model: Model) -> list[int]:
    """1-based places of the last character of each unit that is not blank."""
    s = slotted(text)[0] if text else np.empty(0, SLOT)
    return s["pos"][model.boundaries(s)].tolist() if len(s) else []


def _slotted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, 1000):
        found = [slotted(t) for t in batch.column(2).to_pylist()]
        grams = np.concatenate([np.empty(0, np.int64), *[np.array(g, np.int64) for _, g in found]])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s, _ in found], pa.binary()), lists(grams, [len(g) for _, g in found])], ["id", "field", "slots", "grams"])


def train(grams: DataFrame, share: float = SHARE) -> Model:
    """The model of all n-grams (arrays, one column). What reaches the driver is bounded by ``1 / share`` words a kind."""
    key = F.col("g")
    counts = grams.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    kind, kinds = key.bitwiseAND(F.lit(15)).cast("int"), range(LONE + 1)
    totals = counts.groupBy(kind.alias("kind")).agg(F.sum("n").alias("total"))
    shares = counts.withColumn("kind", kind).join(F.broadcast(totals), "kind")
    words = shares.groupBy(key.bitwiseAND(F.lit(-16)).alias("word")).agg(F.max(F.col("n") / F.col("total")).alias("most"), *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in kinds])
    kept = words.where(F.col("most") >= share).drop("most").toArrow()
    sums = {r.kind: r.total for r in totals.collect()}
    return Model(kept.column("word").to_numpy(), np.column_stack([kept.column(f"n{k}").to_numpy() for k in kinds]), np.array([sums.get(k, 0) for k in kinds], float))


def _find(it: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in batches(it, 4000):
        data = batch.column(2).to_pylist()
        s = np.frombuffer(b"".join(data), SLOT)
        text = np.repeat(np.arange(len(data)), [len(d) // SLOT.itemsize for d in data])
        cut = np.flatnonzero(model.boundaries(s)) if len(s) else np.empty(0, np.int64)
        row = pa.array(text[cut])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(s["pos"][cut])], ["id", "field", "end_pos"])


def sentence_ends(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(id, field, end_pos) of every sentence unit of the named text columns."""
    rows = narrow(records, key, *fields)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("text")) for f in fields])).alias("f")
    texts = rows.select(F.col(f"`{key}`").cast("string").alias("id"), pairs).select("id", "f.field", "f.text").where("id is not null and text <> ''")
    found = written(texts.mapInArrow(_slotted, "id string, field string, slots binary, grams array<bigint>"))
    sent = records.sparkSession.sparkContext.broadcast(train(found.select("grams")))
    return found.select("id", "field", "slots").mapInArrow(functools.partial(_find, sent=sent), "id string, field string, end_pos int").distinct()
