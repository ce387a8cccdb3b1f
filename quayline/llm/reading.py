"""Reading level of documents by regularised ordinal regression.

A proportional-odds model over lexical diversity, word rarity (against counts of the whole corpus),
the graded vocabulary (the mean level of the labelled documents that use a word), connectives, a
clause-depth proxy and lengths, fitted to the labelled documents. Word counts are kept by hash bucket,
so what is sent to the tasks has a fixed size (``BUCKETS`` numbers) whatever the corpus; the model is
fitted on at most ``LABELLED`` labelled documents, chosen by the hash of their id. Counting and
scoring cover every document. Texts are read once; what is needed of them, three bytes a word, is
written, and nothing but counts, labelled documents and levels is shuffled.

Words are blank-separated, without what is no letter or digit in them. Documents not written mainly
in Latin letters, those whose words the labelled documents hardly use (another language in Latin
letters), and null or wordless texts, have no level and no row;
repeated rows of one id give one row (the larger level, if their texts differ). Ratings of one document are averaged;
labels without document and nulls are passed over. Without labels of at least two levels there is
nothing to fit and no row.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import screen
from .arrow import MEMO, batches, narrow

BUCKETS = 1 << 18
#: Buckets of one row of what is sent to the driver.
PAGE = 1 << 10
LABELLED = 6000
LEVELS = 4
#: Ridge per labelled document: light on the graded vocabulary, heavy on the shape of the text, which
#: goes along with the level in most documents but must not outvote the words in short ones.
RIDGE_WORDS, RIDGE_SHAPE = 0.001, 0.2
#: A text of which labelled documents use fewer words than this share, or than half the share of the least
#: covered labelled document (itself aside), is of another language that is written in Latin letters.
FOREIGN = 0.5
#: Weight of the overall mean in a word's grade, in documents.
SMOOTH = 2.0

# Connectives of Vietnamese and English.
CONNECTIVES = """và hoặc nhưng vì nên khi nếu dù song tuy do bởi để nhằm mà rằng thì đồng thời trong sau trước khiến bất chấp
and or but because so when if although though while whereas whereby since unless until that which hence thus insofar moreover however""".split()
_LINKS = frozenset(CONNECTIVES)
_CLAUSES = ",;:("
_ENDS = ".!?…。"
FEATURES = ("grade", "graded_high", "graded_low", "rarity", "rare", "diversity", "connectives", "clauses", "sentence_length", "word_length", "length")
#: How many of them, at the front, come from the graded vocabulary.
GRADED = 3


class Words(dict):
    """Blank-separated token -> its place in the lists of what is known of it.

    A token's word is what is left of its letters and digits, its bucket the hash of that; tokens
    without any have bucket -1. The memo only saves time and is emptied at a fixed size.
    """

    def __init__(self) -> None:
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.bucket, self.link, self.chars, self.other = array("i"), array("b"), array("i"), array("i")

    def __missing__(self, token: str) -> int:
        word = "".join(screen._words().findall(token))
        place = self[token] = len(self.bucket)
        self.bucket.append(xxhash.xxh64_intdigest(word) >> 46 if word else -1)
        self.link.append(word in _LINKS)
        self.chars.append(len(word))
        self.other.append(sum(map(_is_other, word)))
        return place

    def known(self) -> tuple[np.ndarray, ...]:
        return tuple(np.frombuffer(x, t) for x, t in ((self.bucket, np.int32), (self.link, np.int8), (self.chars, np.int32), (self.other, np.int32)))


def _is_other(ch: str) -> bool:
    """A letter of a script other than Latin."""
    code = ord(ch)
    return code > 0x24F and not (0x1E00 <= code <= 0x1EFF or 0x300 <= code <= 0x36F) and ch.isalpha()


_WORDS = Words()


@dataclass
class Text:
    """What the features need of a text: word buckets and the shape of its sentences."""

    buckets: np.ndarray
    kinds: int
    shape: tuple[float, float, float, float]


def parse(text: str | None) -> Text | None:
    """None for a text without words or one that is not mainly in Latin letters."""
    if not text:
        return None
    if len(_WORDS) > MEMO:
        _WORDS.reset()
    shown = screen.fold(text)
    tokens = shown.lower().split()
    places = np.fromiter(map(_WORDS.__getitem__, tokens), np.int64, len(tokens))
    buckets, links, chars, other = (x[places] for x in _WORDS.known())
    total = int(chars.sum(dtype=np.int64))
    if not total or 2 * int(other.sum(dtype=np.int64)) >= total:
        return None
    buckets = buckets[buckets >= 0]
    n = len(buckets)
    link = int(links.sum(dtype=np.int64))
    sentences = max(1, sum(map(shown.count, _ENDS)))
    clauses = sum(map(shown.count, _CLAUSES))
    return Text(buckets, len(set(tokens)), (link / n, (clauses + link) / sentences, float(np.log1p(n / sentences)), total / n))


class Lexicon:
    """Corpus counts and grades by word bucket."""

    def __init__(self, counts: np.ndarray) -> None:
        total = max(1, counts.sum())
        self.rarity = (-np.log((counts + 0.5) / (total + 0.5 * BUCKETS))).astype(np.float32)
        self.sums = np.zeros(BUCKETS, np.float32)
        self.docs = np.zeros(BUCKETS, np.float32)
        self.mean = 0.0
        self.foreign = 0.0

    def grade(self, sums: np.ndarray, docs: np.ndarray, mean: float) -> None:
        self.sums, self.docs, self.mean = sums.astype(np.float32), docs.astype(np.float32), mean

    def covered(self, texts: list[Text], own: int = 0) -> np.ndarray:
        """Share of each text's words that labelled documents use; ``own``: how many of these are the text itself."""
        n = np.array([len(t.buckets) for t in texts])
        known = self.docs[np.concatenate([t.buckets for t in texts])] > own
        return np.add.reduceat(known.astype(np.float64), np.concatenate([[0], np.cumsum(n)[:-1]])) / n

    def features(self, texts: list[Text], own_levels: np.ndarray | None = None) -> np.ndarray:
        """One row per text. ``own_levels``: what these labelled texts themselves put into the grades."""
        n = np.array([len(t.buckets) for t in texts])
        at = np.concatenate([[0], np.cumsum(n)[:-1]])
        flat = np.concatenate([t.buckets for t in texts])
        sums, docs = self.sums[flat], self.docs[flat]
        if own_levels is not None:
            sums, docs = sums - np.repeat(own_levels, n), docs - 1
        grade = (sums + SMOOTH * self.mean) / (docs + SMOOTH)
        rarity = self.rarity[flat]
        means = [np.add.reduceat(x.astype(np.float64), at) / n for x in (grade, grade > self.mean + 0.75, grade < self.mean - 0.75, rarity, rarity > 10)]
        kinds = np.array([t.kinds for t in texts])
        shape = np.array([t.shape for t in texts])
        return np.column_stack([*means, kinds / np.sqrt(n), shape, np.log1p(n)])


class Ordinal:
    """P(level > k) = sigmoid(x w - c_k), with a ridge on w, fitted by Newton steps with halving."""

    def __init__(self, x: np.ndarray, levels: np.ndarray) -> None:
        self.center, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.clip((x - self.center) / self.scale, -5, 5)
        over = levels[:, None] > np.arange(1, LEVELS)[None, :]
        over = over.astype(float)
        share = np.clip(over.mean(axis=0), 0.01, 0.99)
        p, m = z.shape[1], LEVELS - 1
        self.theta = np.concatenate([np.zeros(p), -np.log(share / (1 - share))])
        design = np.concatenate([np.repeat(z, m, axis=0), -np.tile(np.eye(m), (len(z), 1))], axis=1)
        y = over.ravel()
        ridge = np.concatenate([np.where(np.arange(p) < GRADED, RIDGE_WORDS, RIDGE_SHAPE) * len(z), np.full(m, 1e-3)])

        def loss(theta: np.ndarray) -> float:
            s = design @ theta
            return float(np.logaddexp(0, s).sum() - y @ s + 0.5 * (ridge * theta**2).sum())

        now = loss(self.theta)
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(design @ self.theta, -30, 30)))
            gradient = design.T @ (q - y) + ridge * self.theta
            hessian = (design * (q * (1 - q))[:, None]).T @ design + np.diag(ridge)
            step = np.linalg.solve(hessian, gradient)
            size = 1.0
            while size > 1e-4 and (then := loss(self.theta - size * step)) > now:
                size /= 2
            if size <= 1e-4 or now - then < 1e-7 * abs(now):
                break
            self.theta, now = self.theta - size * step, then
        self.theta[p:] = np.sort(self.theta[p:])

    def levels(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.center) / self.scale, -5, 5)
        p = z.shape[1]
        return 1 + ((z @ self.theta[:p])[:, None] > self.theta[None, p:]).sum(axis=1)


def packed(buckets: np.ndarray) -> bytes:
    """Three bytes a bucket, in order."""
    return buckets.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<i4").ravel()


SHAPE = ("links", "clauses", "sentence", "word")
PARSED = f"doc_id bigint, buckets binary, kinds int, {', '.join(f'{n} double' for n in SHAPE)}"


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, 500):
        found = [(key, t) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (t := parse(text)) is not None]
        cols = [pa.array([k for k, _ in found], pa.int64()), pa.array([packed(t.buckets) for _, t in found], pa.binary()), pa.array([t.kinds for _, t in found], pa.int32())]
        cols += [pa.array([t.shape[j] for _, t in found], pa.float64()) for j in range(len(SHAPE))]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "buckets", "kinds", *SHAPE])


def _texts(batch: pa.RecordBatch) -> list[Text]:
    """The texts of rows of ``PARSED``, without their ids."""
    data, kinds, *shape = (c.to_pylist() for c in batch.columns)
    return [Text(unpacked(d), k, s) for d, k, s in zip(data, kinds, zip(*shape))]


def _tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches(it, 500):
        if batch.num_rows:
            counts += np.bincount(unpacked(b"".join(batch.column(0).to_pylist())), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used].astype(float))], ["bucket", "n"])


def _levels(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of levels and number of the documents that use a bucket."""
    sums, docs = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for batch in batches(it, 500):
        for data, level in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.unique(unpacked(data))
            sums[own] += level
            docs[own] += 1
    used = np.flatnonzero(docs)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums[used]), pa.array(docs[used])], ["bucket", "s", "d"])


def _pages(it: Iterator[pa.RecordBatch], names: int) -> Iterator[pa.RecordBatch]:
    for batch in it:
        cells = batch.column(1)
        flat, page = cells.flatten(), np.repeat(np.arange(batch.num_rows), pc.list_value_length(cells).to_numpy())
        out = np.zeros((batch.num_rows, names, PAGE))
        for j in range(names):
            out[page, j, flat.field(0).to_numpy() % PAGE] = flat.field(j + 1).to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in out], pa.binary())], ["page", "data"])


def by_bucket(parts: DataFrame, *names: str) -> list[np.ndarray]:
    """Sums by bucket, one array a name: ``BUCKETS`` numbers, however many rows there are."""
    sums = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
    cells = sums.groupBy(F.floor(F.col("bucket") / PAGE).cast("int").alias("page")).agg(F.collect_list(F.struct("bucket", *names)).alias("cells"))
    whole = np.zeros((len(names), BUCKETS // PAGE, PAGE))
    got = cells.mapInArrow(functools.partial(_pages, names=len(names)), "page int, data binary").toArrow()
    for page, data in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
        whole[:, page] = np.frombuffer(data).reshape(len(names), PAGE)
    return list(whole.reshape(len(names), BUCKETS))


def _featured(it: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    lexicon = sent.value
    for batch in batches(it, 500):
        if batch.num_rows:
            levels = batch.column(batch.num_columns - 1).to_numpy()
            texts = _texts(batch.drop_columns(["level"]))
            yield pa.RecordBatch.from_arrays([pa.array(levels), pa.array(lexicon.covered(texts, 1)), *map(pa.array, lexicon.features(texts, levels).T)], ["level", "covered", *FEATURES])


def _grade(it: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    lexicon, model = sent.value
    for batch in batches(it, 500):
        texts = _texts(batch.drop_columns(["doc_id"])) if batch.num_rows else []
        levels = model.levels(lexicon.features(texts)) if texts else np.empty(0)
        own = np.flatnonzero(lexicon.covered(texts) >= lexicon.foreign) if texts else np.empty(0, int)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(levels[own].astype(np.int32))], ["doc_id", "level"])


def fit(parsed: DataFrame, labels: DataFrame) -> tuple[Lexicon, Ordinal] | None:
    """The lexicon of all documents and the model of the labelled ones.

    The driver gets sums by bucket and the features of the labelled documents, no text.
    """
    lexicon = Lexicon(by_bucket(parsed.select("buckets").mapInArrow(_tally, "bucket int, n double"), "n")[0])
    rated = narrow(labels, "doc_id", "reading_level").dropna().groupBy("doc_id").agg(F.avg("reading_level").alias("level"))
    rated = rated.orderBy(F.xxhash64("doc_id")).limit(LABELLED)
    known = written(parsed.join(F.broadcast(rated), "doc_id").dropDuplicates(["doc_id"]))
    about = known.agg(F.avg("level").alias("mean"), F.count_distinct(F.round("level")).alias("kinds")).first()
    if about.kinds < 2:
        return None
    lexicon.grade(*by_bucket(known.select("buckets", "level").mapInArrow(_levels, "bucket int, s double, d double"), "s", "d"), about.mean)
    sent = parsed.sparkSession.sparkContext.broadcast(lexicon)
    columns = known.select("buckets", "kinds", *SHAPE, "level")
    rows = columns.mapInArrow(functools.partial(_featured, sent=sent), f"level double, covered double, {', '.join(f'{n} double' for n in FEATURES)}").toArrow()
    levels, covered, *features = (c.to_numpy() for c in rows.columns)
    lexicon.foreign = min(FOREIGN, 0.5 * float(covered.min()))
    order = np.lexsort([*features, levels])  # the same sums whatever the order of the rows
    return lexicon, Ordinal(np.column_stack(features)[order], np.round(levels + 1e-9)[order])


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, level) of every document in Latin script."""
    rows = narrow(documents, "doc_id", "text").where("doc_id is not null and text <> ''")
    parsed = written(rows.mapInArrow(_parse, PARSED))
    fitted = fit(parsed, labels)
    if fitted is None:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, level int")
    sent = documents.sparkSession.sparkContext.broadcast(fitted)
    return parsed.mapInArrow(functools.partial(_grade, sent=sent), "doc_id bigint, level int").groupBy("doc_id").agg(F.max("level").alias("level"))
