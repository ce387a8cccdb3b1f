"""Evaluation texts that leak into training text.

Containment search in the manner of an LSH ensemble. The short side (13-word passages of the test
items) is the query; the long side is cut into overlapping segments that are partitioned by their
size. Each size class has as many MinHash functions as make the chance of missing a contained
passage smaller than ``MISS``. A segment whose minimum under any function is a shingle of a passage
is a candidate, and candidates are verified exactly, word by word.

Segments start at every 13th word and hold 26 words, so each 13-word passage of a document lies
within one segment. The documents are read once whatever the number of items: what the tasks get of
the items is two bits a shingle, in a map of at most ``MOST_BITS`` bits that is put together in the
engine. Passages all of whose shingles are in the map are joined with the passages of the items, word
by word; a map that is full only lets more of them through. Nothing else of the items leaves the
cluster, and documents are not shuffled.

Nulls, empty and very short texts (under 13 words) have no passages and no cases; repeated rows give
one row; an item or document id of null is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import screen
from .arrow import WordHashes, batches, lists, narrow, shingles

PASSAGE = 13
SHINGLE = 5
MISS = 1e-6
#: Upper bound of a size class in words: a tail no longer than a passage, and a whole segment.
SIZES = (PASSAGE, 2 * PASSAGE)
#: Bits of the map of shingles: 64 for each of them, within these bounds (64 MB at most).
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 29

_HASHES = WordHashes()


def functions(words: int) -> int:
    """MinHash functions for segments of at most ``words`` words."""
    inside, total = PASSAGE - SHINGLE + 1, words - SHINGLE + 1
    return 1 if inside >= total else math.ceil(math.log(MISS) / math.log(1 - inside / total))


class Sieve:
    """The shingles of the test items, two bits each: by the upper and the lower part of the hash."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.shift = np.uint64(64 - (int(words.size) * 64).bit_length() + 1)
        self.low = np.uint64(int(words.size) * 64 - 1)
        odd = np.random.default_rng(13).integers(1, 2**63, functions(SIZES[-1]), dtype=np.uint64) | np.uint64(1)
        self.factors = [(a, np.uint64(pow(int(a), -1, 2**64))) for a in odd]

    def _bit(self, slot: np.ndarray) -> np.ndarray:
        return (self.words[(slot >> np.uint64(6)).view(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0

    def known(self, values: np.ndarray) -> np.ndarray:
        """Whether both bits of a shingle are set, the second one looked up only where the first is."""
        hit = self._bit(values >> self.shift)
        where = np.flatnonzero(hit)
        hit[where] = self._bit(values[where] & self.low)
        return hit

    def candidates(self, found: list[np.ndarray]) -> list[list[int]]:
        """Per document (its word hashes) the first words of the segments that may hold a passage."""
        pad = ~np.uint64(0)
        parts, where = [], []
        for d, words in enumerate(found):
            if len(words) < PASSAGE:
                continue
            own = shingles(words, SHINGLE)
            parts.append(own)
            fill = -len(own) % PASSAGE
            if fill:
                parts.append(np.full(fill, pad))
            where += [(d, k) for k in range(0, len(own), PASSAGE)]
        out: list[list[int]] = [[] for _ in found]
        if not parts:
            return out
        flat = np.concatenate(parts)
        inside = PASSAGE - SHINGLE + 1
        doc = np.array([w[0] for w in where])
        single = np.ones(len(where), bool)  # the last segment of a document has no successor
        single[:-1] = doc[1:] != doc[:-1]
        grid = flat.reshape(-1, PASSAGE)
        hit = np.zeros(len(where), bool)
        for words in SIZES:
            own = np.flatnonzero(single if words == PASSAGE else ~single)
            if not len(own):
                continue
            # a tail may hold up to 13 shingles, of 17 words
            count = functions(words if words > PASSAGE else PASSAGE + SHINGLE - 1)
            for a, back in self.factors[:count]:
                own = own[~hit[own]]
                low = grid[own] * a
                if words == PASSAGE:
                    low[grid[own] == pad] = pad
                least = low.min(axis=1)
                if words > PASSAGE:
                    after = grid[own + 1][:, :inside]
                    nxt = after * a
                    nxt[after == pad] = pad
                    least = np.minimum(least, nxt.min(axis=1))
                hit[own] = self.known(least * back)
        for k in np.flatnonzero(hit):
            out[where[k][0]].append(where[k][1])
        return out

    def search(self, texts: list[str | None]) -> list[list[str]]:
        """Per text its passages all of whose shingles are known, of the candidate segments."""
        said = [screen.words(t) if t else [] for t in texts]
        hashed = [_HASHES.of(w) for w in said]
        out: list[list[str]] = [[] for _ in texts]
        inside = PASSAGE - SHINGLE + 1
        for d, starts in enumerate(self.candidates(hashed)):
            for start in starts:
                near = self.known(shingles(hashed[d][start : start + 2 * PASSAGE - 1], SHINGLE))
                run = np.concatenate([[0], np.cumsum(near)])
                for k in np.flatnonzero(run[inside:] - run[:-inside] == inside):
                    out[d].append(" ".join(said[d][start + k : start + k + PASSAGE]))
        return out


def _passages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, 500):
        items, passages, hashes = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = screen.words(text)
            own = shingles(_HASHES.of(found), SHINGLE).view(np.int64)
            for k in range(len(found) - PASSAGE + 1):
                items.append(item)
                passages.append(" ".join(found[k : k + PASSAGE]))
                hashes.append(own[k : k + PASSAGE - SHINGLE + 1])
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(passages, pa.string()), lists(flat, map(len, hashes))], ["item_id", "passage", "shingles"])


def sieve(passages: DataFrame) -> Sieve:
    """The map of all shingles of the passages; the bits of a word are joined before anything is sent."""
    own = passages.select(F.explode("shingles").alias("h"))
    total = own.agg(F.approx_count_distinct("h").alias("n")).first().n
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (64 * total).bit_length()))
    slot = F.explode(F.array(F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1)), F.col("h").bitwiseAND(F.lit(bits - 1)))).alias("slot")
    own, slot = own.select(slot), F.col("slot")
    masks = own.select(F.shiftright(slot, 6).alias("at"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("at").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[masks.column("at").to_numpy()] = masks.column("mask").to_numpy().view(np.uint64)
    return Sieve(words)


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id) of each document with 13 or more consecutive words of a test item."""
    items = narrow(benchmark, "item_id", "text").dropna().withColumn("item_id", F.col("item_id").cast("bigint"))
    passages = written(items.mapInArrow(_passages, "item_id bigint, passage string, shingles array<bigint>"))
    sent = documents.sparkSession.sparkContext.broadcast(sieve(passages))
    docs = narrow(documents, "doc_id", "text").where("doc_id is not null and text is not null and length(text) > 24")

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches(it, 500):
            found = [(d, p) for d, own in zip(batch.column(0).to_pylist(), held.search(batch.column(1).to_pylist())) for p in dict.fromkeys(own)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], ["doc_id", "passage"])

    # the planner knows the size of the passages and broadcasts them only if the session allows that
    return docs.mapInArrow(search, "doc_id bigint, passage string").join(passages.select("item_id", "passage"), "passage").select("doc_id", "item_id").distinct()
