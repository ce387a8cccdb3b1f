"""Exact byte-level BPE ids by dynamic programming over prefixes.

Every prefix of a piece has one encoding, so it has one last token. An automaton over the vocabulary
gives all tokens that end at a position; the right one is the token whose predecessor (the last token
of the prefix before it) is compatible with it, that is, the two tokens side by side would not be
merged otherwise. Back-pointers then give the ids. The time is linear in the text, whatever it holds.

Pieces (the pre-tokenizer's matches) are encoded once per worker and remembered; the memo only saves
time and is emptied at a fixed size. Null and empty texts have an empty list; special tokens are not
recognised in texts. One row per row, nothing is shuffled.
"""

from __future__ import annotations

import array
import functools
import json
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .arrow import batches, lists, narrow

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokenizer pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 1_000_000


def _byte_letters() -> dict[str, int]:
    """The letters by which the vocabulary file writes bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """The vocabulary of one file and the memo of its pieces."""

    def __init__(self, data: bytes) -> None:
        model = json.loads(data)["model"]
        letters, vocab = _byte_letters(), model["vocab"]
        self.length = [0] * (max(vocab.values()) + 1)
        self.parts: list[tuple[int, int] | None] = [None] * len(self.length)
        self.rank = [0] * len(self.length)
        self.joined: dict[int, int] = {}
        for text, token in vocab.items():
            if all(c in letters for c in text):
                self.length[token] = len(text)
        for rank, merge in enumerate(model["merges"], 1):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, token = vocab[left], vocab[right], vocab[left + right]
            self.joined[a << 20 | b] = token
            if self.parts[token] is None:
                self.parts[token], self.rank[token] = (a, b), rank
        self.automaton = ahocorasick.Automaton()
        usable = {token for token in vocab.values() if self.parts[token] or self.length[token] == 1}
        for text, token in vocab.items():
            if token in usable:
                raw = "".join(chr(letters[c]) for c in text)
                self.automaton.add_word(raw, (len(raw), token))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PATTERN)
        self.fits: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.starts, self.counts = array.array("i"), array.array("q"), array.array("i")
        if len(self.fits) > MEMO:
            self.fits.clear()

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` side by side are encoded as just these two tokens.

        Both are taken apart again, latest merge first. Whenever the two tokens that touch could have
        merged before the later of the two came to be, the border would have vanished.
        """
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # merges ranked below ``before`` have run already while a and b stood side by side
        before = len(self.rank) + 1
        while True:
            union = self.joined.get(a << 20 | b)
            if union is not None and self.rank[union] < before:
                return False
            # of equal rank, the left one is made first, so the right one is taken apart first
            if self.rank[a] > self.rank[b]:
                before, a = self.rank[a], self.parts[a][1]
            elif self.parts[b] is not None:
                before, b = self.rank[b] + 1, self.parts[b][0]
            else:
                return True

    def piece(self, text: str) -> list[int]:
        raw = text.encode().decode("latin-1")
        last = [-1] * (len(raw) + 1)
        for end, (length, token) in self.automaton.iter(raw):
            end += 1
            if last[end] < 0 and (length == end or self.compatible(last[end - length], token)):
                last[end] = token
        out, at = [], len(raw)
        while at:
            out.append(last[at])
            at -= self.length[last[at]]
        return out[::-1]

    def index(self, text: str) -> int:
        ids = self.piece(text)
        k = self.memo[text] = len(self.starts)
        self.starts.append(len(self.flat))
        self.counts.append(len(ids))
        self.flat.extend(ids)
        return k

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        if len(self.flat) > 8 * MEMO or len(self.memo) > MEMO:
            self.clear()
        found = [self.pieces.findall(t) if t else [] for t in texts]
        flat: list[str] = [p for own in found for p in own]
        for p in set(flat).difference(self.memo):
            self.index(p)
        which = np.fromiter(map(self.memo.__getitem__, flat), np.int64, len(flat))
        counts = np.frombuffer(self.counts, np.int32)[which] if len(which) else np.empty(0, np.int32)
        total = int(counts.sum())
        ids = np.empty(0, np.int32)
        if total:
            ends = np.cumsum(counts)
            at = np.repeat(np.frombuffer(self.starts, np.int64)[which] - (ends - counts), counts) + np.arange(total)
            ids = np.frombuffer(self.flat, np.int32)[at]
        border = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum([len(x) for x in found], dtype=np.int64) if found else np.empty(0, np.int64)
        return ids, np.diff(np.concatenate([[0], border[ends]]))


_ENCODERS: dict[str, Encoder] = {}


def _encode(it: Iterator[pa.RecordBatch], sent, key: str) -> Iterator[pa.RecordBatch]:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(sent.value)
    for batch in batches(it, 1000):
        ids, counts = _ENCODERS[key].encode(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(ids, counts)], ["id", "ids"])


def encode_texts(records: DataFrame, key: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids) of every row. The vocabulary file is read by the driver alone and sent to the workers."""
    data = Path(folder, f"{tokenizer}.json").read_bytes()
    sent = records.sparkSession.sparkContext.broadcast(data)
    kind = narrow(records, key).schema[0].dataType.simpleString()
    run = functools.partial(_encode, sent=sent, key=xxhash.xxh64_hexdigest(data))
    return narrow(records, key, text).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", key)
