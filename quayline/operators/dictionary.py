"""Dictionary joins: which aliases a text mentions, and where.

All aliases are searched for at once by an automaton, so a text is read once whatever the size of the
dictionary; no pairs of texts and aliases are made. The dictionary goes to the tasks in blocks of
bounded size.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from typing import ClassVar

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Aliases in one pass over the texts.
BLOCK = 50_000
_SPACE = re.compile(r"\s+")


def lowered(text: str | None) -> str:
    return _SPACE.sub(" ", unicodedata.normalize("NFC", text or "").lower().strip())


def toneless(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")


def _automaton(words: dict[str, list]) -> ahocorasick.Automaton | None:
    words = {w: v for w, v in words.items() if w}
    if not words:
        return None
    out = ahocorasick.Automaton()
    for word, values in words.items():
        out.add_word(word, (len(word), values))
    out.make_automaton()
    return out


def _blocks(aliases: DataFrame) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    for r in aliases.select("ticker", "alias", "alias_type", "weight", "alias_normalized").dropna(subset=["ticker", "alias"]).toLocalIterator():
        block.append(tuple(r))
        if len(block) == BLOCK:
            yield block
            block = []
    yield block


class _Held:
    """A block of aliases on its way to the tasks; what searches for them is made once a worker."""

    made: ClassVar[dict[str, object]] = {}

    def __init__(self, spark: SparkSession, rows: list[tuple], make: type) -> None:
        self.sent, self.make, self.key = spark.sparkContext.broadcast(rows), make, uuid.uuid4().hex

    def value(self):
        if self.key not in self.made:
            if len(self.made) > 3:
                self.made.clear()
            self.made[self.key] = self.make(self.sent.value)
        return self.made[self.key]


class Detector:
    """Tickers that a text mentions, with the best weight of the aliases found."""

    def __init__(self, rows: list[tuple]) -> None:
        tokens: dict[str, list] = {}
        toned: dict[str, list] = {}
        bare: dict[str, list] = {}
        for ticker, alias, kind, weight, normal in rows:
            ticker, weight = ticker.upper(), float(weight or 1.0)
            if kind == "ticker" or alias.upper() == ticker:
                tokens.setdefault(ticker, []).append((ticker, weight))
            else:
                toned.setdefault(lowered(normal or alias), []).append((ticker, weight))
                bare.setdefault(toneless(lowered(alias)), []).append((ticker, weight))
        self.tokens, self.toned, self.bare = map(_automaton, (tokens, toned, bare))

    def detect(self, text: str) -> dict[str, float]:
        best: dict[str, float] = {}
        low = lowered(text)
        for automaton, where in ((self.tokens, text), (self.toned, low), (self.bare, toneless(low))):
            if automaton is None:
                continue
            for end, (length, hits) in automaton.iter(where):
                if automaton is self.tokens and (_joins(where, end - length) or _joins(where, end + 1)):
                    continue
                for ticker, weight in hits:
                    if weight > best.get(ticker, -1.0):
                        best[ticker] = weight
        return best


def _joins(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (("A" <= text[at] <= "Z") or ("0" <= text[at] <= "9"))


def detected_tickers(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, ticker, weight) of texts (id, text); null texts mention nothing."""
    out = None
    for rows in _blocks(aliases):
        held = _Held(texts.sparkSession, rows, Detector)

        def run(it: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            detector = held.value()
            for batch in it:
                found = [(k, t, w) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text for t, w in detector.detect(text).items()]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64())], ["id", "ticker", "weight"])

        part = texts.select("id", "text").mapInArrow(run, "id string, ticker string, weight double")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id", "ticker").agg({"weight": "max"}).withColumnRenamed("max(weight)", "weight")


class Linker:
    """Mentions of aliases as whole words; upper-case aliases as tokens, others whatever their case."""

    def __init__(self, rows: list[tuple]) -> None:
        exact: dict[str, list] = {}
        folded: dict[str, list] = {}
        for ticker, alias, kind, weight, _ in rows:
            alias = alias.strip()
            into = exact if kind == "ticker" or alias.isupper() else folded
            into.setdefault(alias if into is exact else alias.lower(), []).append((ticker, alias, kind, float(weight or 1.0)))
        self.exact, self.folded = _automaton(exact), _automaton(folded)

    def mentions(self, sentence: str) -> list[tuple[int, str, str, str, str | None, float]]:
        """(start, ticker, text, alias, kind, weight), longer aliases first."""
        low = sentence.lower()
        if len(low) != len(sentence):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in sentence)
        out = []
        for automaton, where in ((self.exact, sentence), (self.folded, low)):
            if automaton is None:
                continue
            for end, (length, hits) in automaton.iter(where):
                start = end - length + 1
                if automaton is self.exact:
                    if _joins(where, start - 1) or _joins(where, end + 1):
                        continue
                elif _wordy(where, start - 1) or _wordy(where, end + 1):
                    continue
                out += [(start, ticker, sentence[start : end + 1], alias, kind, weight) for ticker, alias, kind, weight in hits]
        out.sort(key=lambda m: (-len(m[3]), m[3], m[0]))
        return out


def _wordy(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


SCHEMA = "article_id string, ticker string, entity_text string, alias_type string, alias_weight double, sentence_index int, context string, relevance_weight double"


def relevance_weight(weight: float, context: str) -> float:
    return round(min(max(weight * (0.7 if len(context) < 80 else 1.0), 0.1), 1.0), 3)


def contexts(sentences: list[str], linker: Linker, restrict: set[str], window: int = 1) -> list[tuple]:
    """One row per (ticker, sentence) with the sentences around it.

    Only tickers in ``restrict`` count, unless that leaves no mention at all. Of several aliases in a
    sentence the shortest wins, as in a sequence of updates of one key.
    """
    found = [(k, m) for k, s in enumerate(sentences) for m in linker.mentions(s)]
    chosen = [(k, m) for k, m in found if m[1] in restrict] if restrict else found
    rows: dict[tuple[str, int], tuple] = {}
    for k, (_, ticker, text, _, kind, weight) in chosen or found:
        context = " ".join(sentences[max(0, k - window) : k + window + 1])
        rows[ticker, k] = (ticker, text, kind, weight, k, context, relevance_weight(weight, context))
    return list(rows.values())


_MENTIONS = "article_id string, sentence_index int, start int, ticker string, entity_text string, alias string, alias_type string, alias_weight double, context string, own boolean"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def linked_entities(articles: DataFrame, aliases: DataFrame) -> DataFrame:
    """Entity rows of articles (article_id, sentences, detected_tickers); one row per article is taken for granted.

    Aliases of one block are decided upon where the text is; of several, the mentions of all blocks are
    brought together by article before the rule of the two passes is applied.
    """
    rows = articles.select("article_id", "sentences", "detected_tickers")
    blocks = _blocks(aliases)
    first, second = next(blocks), next(blocks, None)
    if not second:
        held = _Held(articles.sparkSession, first, Linker)

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            linker = held.value()
            for batch in it:
                yield _batch([(a, *row) for a, s, t in zip(*(c.to_pylist() for c in batch.columns)) for row in contexts(s or [], linker, set(t or []))], SCHEMA)

        return rows.mapInArrow(run, SCHEMA)
    parts = [rows.mapInArrow(_mentions(_Held(articles.sparkSession, block, Linker)), _MENTIONS) for block in itertools.chain([first, second], blocks)]
    found = functools.reduce(DataFrame.unionByName, parts)
    any_own = F.max("own").over(Window.partitionBy("article_id"))
    chosen = found.withColumn("any_own", any_own).where("own or not any_own")
    # of several aliases in a sentence the shortest, as in ``contexts``
    best = chosen.groupBy("article_id", "ticker", "sentence_index").agg(F.max(F.struct(-F.length("alias"), "alias", "start", "entity_text", "alias_type", "alias_weight", "context")).alias("b"))
    short = F.when(F.length("b.context") < 80, 0.7).otherwise(1.0)
    weight = F.bround(F.least(F.greatest(F.col("b.alias_weight") * short, F.lit(0.1)), F.lit(1.0)), 3)
    return best.select("article_id", "ticker", "b.entity_text", "b.alias_type", "b.alias_weight", "sentence_index", "b.context", weight.alias("relevance_weight"))


def _mentions(held: _Held, window: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = held.value()
        for batch in it:
            out = []
            for article, sentences, tickers in zip(*(c.to_pylist() for c in batch.columns)):
                for k, sentence in enumerate(sentences or []):
                    found = linker.mentions(sentence)
                    context = " ".join(sentences[max(0, k - window) : k + window + 1]) if found else ""
                    out += [(article, k, start, ticker, text, alias, kind, weight, context, ticker in (tickers or [])) for start, ticker, text, alias, kind, weight in found]
            yield _batch(out, _MENTIONS)

    return run
