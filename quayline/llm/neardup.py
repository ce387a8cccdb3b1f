"""Near-duplicate texts by Bayesian pruning of candidate pairs (BayesLSH).

Texts become sets of word shingles. Exact copies (equal sets) form classes, and only one
representative of each takes part in the search, so a hot group of copies costs one row a task. Banded
MinHash keys give candidate pairs; for each, MinHash values are compared step by step, and the pair is
dropped once the posterior probability (uniform prior) that its similarity reaches the threshold falls
below ``Settings.drop``. What is compared of a value is one bit of its hash, 64 values a step; bits of
a pair agree at a rate of (1 + similarity) / 2. The test is part of the join of the bands, so dropped
pairs are never written. What is left is verified exactly on the shingle sets.

Of the band rows only those that meet another class go on. A band that many classes share is cut into
blocks of ``BLOCK`` classes, and each pair of blocks is a join key of its own, so that its comparisons
are spread over tasks; no pair is left out. The values compared are those the bands are made of: that
a pair shares a band can only raise its agreement, so no more links are dropped than ``drop`` says.

Null and empty texts and texts with fewer words than a shingle have no shingles and belong to no
pair. Rows that repeat an id are one record (the texts of repeats are taken to be equal; of unequal
ones the row with the smallest class id counts). Class ids are 64-bit hashes of the shingle set.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from . import screen
from .arrow import MEMO, WordHashes, batches, lists, narrow, shingles


@dataclass(frozen=True)
class Settings:
    """Shingle length, similarity threshold and the shape of the search.

    With 5 rows a band, 128 bands find a pair of similarity 0.5 with probability 0.983, of 0.55 with
    0.9989, of 0.6 with 0.99997; unlike pairs of similarity 0.1 become candidates with probability 0.0013.
    """

    words: int = 3
    threshold: float = 0.5
    rows: int = 5
    bands: int = 128
    drop: float = 1e-5


#: For stages on word shingles in general: five words, similarity 0.8.
STRICT = Settings(words=5, threshold=0.8, rows=8, bands=64)
#: Classes of one band that one task compares with each other or with as many others.
BLOCK = 4096

_HASHES = WordHashes()


@functools.cache
def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingles(_HASHES.of(screen.words(text)), size)) if text else np.empty(0, np.uint64)


def minhash(own: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of a set that is not empty, by affine maps of 32-bit hashes."""
    a, b = _factors(n)
    short = (own >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    step = max(1, 100_000 // n)
    room = np.empty((min(step, len(short)), n), np.uint32)
    for k in range(0, len(short), step):  # in pieces that stay in the cache
        part = short[k : k + step, None]
        values = room[: len(part)]
        np.multiply(part, a, out=values)
        values += b
        np.minimum(out, values.min(axis=0), out=out)
    return out


#: Bits of MinHash values that a class carries: so many words of 64.
BIT_WORDS = 8


#: Names of the columns of bits.
WORDS = [f"bits{j}" for j in range(BIT_WORDS)]


def low_bits(values: np.ndarray) -> np.ndarray:
    """One bit of a hash of each value and its place, packed into words of 64.

    Bits of the values themselves will not do: those of a small set are maps of few elements, and an odd
    factor leaves the lowest bit as it was, so that the bits of all functions would agree together.
    """
    x = values.astype(np.uint64) + (np.arange(1, len(values) + 1, dtype=np.uint64) << np.uint64(32))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.packbits((x >> np.uint64(63)).astype(np.uint8)).view(np.int64)


def fewest(n: int, p: float, drop: float) -> int:
    """Least number of agreements among ``n`` at which P(rate >= p) is ``drop`` or more.

    With a uniform prior of the rate, P(rate >= p | m of n agree) is P(Binomial(n + 1, p) <= m).
    """
    logs = np.cumsum([0.0] + [np.log((n + 1 - k) / (k + 1)) for k in range(n + 1)])
    pmf = np.exp(logs + np.arange(n + 2) * np.log(p) + np.arange(n + 1, -1, -1) * np.log1p(-p))
    return int(np.argmax(np.cumsum(pmf) >= drop))


def close_bits(s: Settings) -> str:
    """Condition on the bits of two classes, word after word; bits of a pair agree at a rate of (1 + similarity) / 2."""
    tests = []
    for k in range(1, BIT_WORDS + 1):
        differ = " + ".join(f"bit_count(a{j} ^ b{j})" for j in range(k))
        tests.append(f"{differ} <= {64 * k - fewest(64 * k, (1 + s.threshold) / 2, s.drop)}")
    return " and ".join(tests)


def _sketch(it: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    compared = 64 * BIT_WORDS
    n = max(s.rows * s.bands, compared)
    mult = np.random.default_rng(7).integers(1, 2**63, s.rows, dtype=np.uint64) | np.uint64(1)
    seen: set[int] = set()  # copies met before in this task need no bands
    for batch in batches(it, 1000):
        ids, classes, bits, keys, sizes = [], [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = shingle_set(text, s.words)
            if not len(own):
                continue
            name = _class_id(own)
            ids.append(key)
            classes.append(name)
            if name in seen:
                sizes.append(0)
                bits.append(None)
                continue
            if len(seen) >= MEMO:
                seen.clear()
            seen.add(name)
            low = minhash(own, n)
            mixed = (low[: s.rows * s.bands].reshape(s.bands, s.rows).astype(np.uint64) * mult).sum(axis=1, dtype=np.uint64)
            mixed ^= mixed >> np.uint64(31)
            keys.append(((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            sizes.append(s.bands)
            bits.append(low_bits(low[:compared]))
        flat = np.concatenate(keys) if keys else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(classes, pa.int64()), *[pa.array([None if b is None else b[j] for b in bits], pa.int64()) for j in range(BIT_WORDS)], lists(flat, sizes)],
            ["id", "class_id", *WORDS, "bands"],
        )


def _verify(it: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, 2000):
        keep = []
        a, b = (batch.column(c).to_pylist() for c in (2, 3))
        for k in range(batch.num_rows):
            x, y = np.frombuffer(a[k], np.uint64), np.frombuffer(b[k], np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= s.threshold * (len(x) + len(y) - both):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["class_a", "class_b"])


def _class_id(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes()) - 2**63


def _sets(it: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, 1000):
        own = [x for x in (shingle_set(t, s.words) for t in batch.column(0).to_pylist()) if len(x)]
        yield pa.RecordBatch.from_arrays([pa.array([_class_id(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], ["class_id", "shingles"])


def candidates(sketched: DataFrame, s: Settings, block: int = BLOCK) -> DataFrame:
    """(class_a, class_b), class_a < class_b, of classes that share a band and whose bits are close enough."""
    classes = sketched.where("bits0 is not null").groupBy("class_id").agg(F.max(F.struct(*WORDS)).alias("row")).select("class_id", "row.*")
    # the number of the band in the upper half of the key
    keyed = sketched.where("bits0 is not null").select("class_id", F.posexplode("bands").alias("at", "low"))
    key = F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(F.col("low").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    banded = keyed.select(key.alias("band"), "class_id").repartition("band").dropDuplicates(["band", "class_id"])
    own = Window.partitionBy("band")
    place = F.row_number().over(own.orderBy("class_id")) - 1
    several = banded.select("band", "class_id", place.alias("k"), F.count("*").over(own).alias("n")).where("n > 1")
    met = written(several.join(classes.hint("merge"), "class_id"))
    i, last = F.floor(F.col("k") / block).cast("int"), F.floor((F.col("n") - 1) / block).cast("int")
    side = lambda x: [F.col("class_id").alias(f"class_{x}"), *[F.col(w).alias(f"{x}{j}") for j, w in enumerate(WORDS)]]
    a = met.select("band", i.alias("i"), F.explode(F.sequence(i, last)).alias("j"), *side("a"))
    b = met.select("band", F.explode(F.sequence(F.lit(0), i)).alias("i"), i.alias("j"), *side("b"))
    # exploded rows are taken to be as few as what they come from
    return a.hint("merge").join(b, ["band", "i", "j"]).where("class_a < class_b").where(close_bits(s)).select("class_a", "class_b").distinct()


def near_duplicates(records: DataFrame, key: str, text: str, settings: Settings = Settings(), block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Membership (id, class_id) of all records with shingles, and the linked class pairs (class_a < class_b)."""
    s = settings
    rows = narrow(records, key, text).toDF("id", "text").where("id is not null and text is not null")
    rows = rows.withColumn("id", F.col("id").cast("string"))
    sketched = written(rows.mapInArrow(functools.partial(_sketch, s=s), f"id string, class_id bigint, {', '.join(f'{w} bigint' for w in WORDS)}, bands array<int>"))
    members = sketched.groupBy("id").agg(F.min("class_id").alias("class_id"))
    likely = written(candidates(sketched, s, block))
    # the shingle sets are made anew, only for classes of likely pairs; the planner knows how many these are
    wanted = likely.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).distinct()
    chosen = written(sketched.groupBy("class_id").agg(F.min("id").alias("id")).join(wanted, "class_id"))
    texts = rows.join(chosen, "id").select("text")
    sets = texts.mapInArrow(functools.partial(_sets, s=s), "class_id bigint, shingles binary").dropDuplicates(["class_id"])
    both = likely.join(sets.toDF("class_a", "set_a").hint("merge"), "class_a").join(sets.toDF("class_b", "set_b").hint("merge"), "class_b")
    links = both.select("class_a", "class_b", "set_a", "set_b").mapInArrow(functools.partial(_verify, s=s), "class_a bigint, class_b bigint")
    return members, links


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(class_id, root): the smallest class id of each connected component, of all classes with a link.

    Edges are turned by large and small stars in turn until nothing changes: every node hands its larger
    neighbours, then its smaller ones, to the smallest of them. The number of turns grows with the
    logarithm of the largest component; each writes its edges, so a lost executor costs one turn.
    """
    edges = written(links.toDF("u", "v").where("u <> v").distinct())
    total = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour to the smallest one of the node, itself included
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour, and the node, to the smallest one
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = written(small)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if total == now:
            break
        total = now
    else:
        raise RuntimeError("components did not settle")
    return edges.toDF("class_id", "root").unionByName(edges.select(F.col("v").alias("class_id"), F.col("v").alias("root")).distinct())


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class_id, group_id, links): one row per record with shingles, its group and its number of linked classes.

    A record without a link to another class is in the group of its own class, with its copies.
    """
    links = written(links)
    count = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    roots = components(links)
    out = members.join(roots, "class_id", "left").join(count, "class_id", "left")
    return out.select("id", "class_id", F.coalesce("root", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs of records (a < b): those within a class and those of linked classes."""
    a, b = (members.toDF(x, f"class_{x}").hint("merge") for x in "ab")
    same = a.join(b, F.col("class_a") == F.col("class_b")).where("a < b").select("a", "b")
    other = links.join(a, "class_a").join(b, "class_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return same.unionByName(other)
