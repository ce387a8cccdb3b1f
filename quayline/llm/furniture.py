"""Lines that one source repeats in many of its documents.

Lines are compared as read on screen, without letter case, blanks and digits, by a 64-bit hash. The
distinct documents of each (source, line) are counted in two steps (first distinct triples, combined
before the shuffle), so one hot source or line is spread over all tasks. A line is furniture if it
occurs in at least ``least`` documents and at least the share ``share`` of the source's documents;
the documents are then rebuilt without such lines.

Rows that repeat a document id are one document. Null and empty texts have no lines but count as
documents; documents without source have no furniture; lines without any letter or mark left are
never furniture and stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import screen
from .arrow import batches, narrow

LEAST = 6
SHARE = 0.03
_ASIDE = re.compile(r"[\s\d]+")


def line_key(line: str) -> int | None:
    """Hash of what counts of a line; None if nothing does."""
    left = _ASIDE.sub("", screen.fold(line).lower())
    return xxhash.xxh64_intdigest(left) - 2**63 if left else None


def _lines(it: Iterator[pa.RecordBatch], memo: int = 200_000) -> Iterator[pa.RecordBatch]:
    known: dict[str, int | None] = {}
    for batch in batches(it):
        docs, sources, numbers, keys = [], [], [], []
        for doc, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            for number, line in enumerate(text.split("\n"), 1):
                if line not in known:
                    if len(known) >= memo:
                        known.clear()
                    known[line] = line_key(line)
                if (key := known[line]) is not None:
                    docs.append(doc)
                    sources.append(source)
                    numbers.append(number)
                    keys.append(key)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array(sources, pa.string()), pa.array(numbers, pa.int32()), pa.array(np.array(keys, np.int64))], ["id", "source", "line_no", "line"])


def furniture_lines(records: DataFrame, key: str, source: str, text: str, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(id, line_no) of each line that is furniture of its source."""
    rows = narrow(records, key, source, text).toDF("id", "source", "text").where("id is not null and source is not null")
    rows = rows.withColumn("id", F.col("id").cast("string")).withColumn("source", F.col("source").cast("string"))
    lines = written(rows.where("text is not null").mapInArrow(_lines, "id string, source string, line_no int, line bigint").distinct())
    sizes = rows.select("source", "id").distinct().groupBy("source").agg(F.count("*").alias("documents"))
    counts = lines.select("source", "line", "id").distinct().groupBy("source", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    frequent = counts.join(sizes, "source").where(F.col("n") >= F.col("documents") * share - 1e-9).select("source", "line")
    return lines.join(frequent, ["source", "line"]).select("id", "line_no").distinct()


def _rebuild(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it):
        out = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text is not None and gone:
                drop = set(gone)
                text = "\n".join(x for k, x in enumerate(text.split("\n"), 1) if k not in drop)
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "text"])


def without_furniture(records: DataFrame, key: str, source: str, text: str, **limits: float) -> DataFrame:
    """(id, text): each distinct text of a document without furniture lines; null texts stay null.

    Texts are shuffled once, by id; copies are told by a hash of the text, and what is found joins the
    rows where they are.
    """
    found = furniture_lines(records, key, source, text, **limits).groupBy("id").agg(F.collect_set("line_no").alias("gone"))
    rows = narrow(records, key, text).toDF("id", "text").where("id is not null").withColumn("id", F.col("id").cast("string"))
    rows = rows.withColumn("hash", F.xxhash64("text", F.md5("text"))).repartition("id").dropDuplicates(["id", "hash"])
    return rows.select("id", "text").join(found, "id", "left").mapInArrow(_rebuild, "id string, text string")
