"""Brings visually identical texts to one form, relationally.

A text is cut into stable runs and unstable clusters (a character whose screen form differs from it,
or any character with combining marks). Clusters are exploded to positioned code points and joined
with the broadcast table of decompositions, look-alikes and combining classes; the marks of each
starter are ordered by class, the cluster is recomposed by a second broadcast table, and the string
is rebuilt by position. Both tables have the size of Unicode, not of the data. All of it happens
within the partition of the record: texts are shuffled once, exploded rows never.

Null texts have no form and no row, the empty text stays empty, repeated rows count once. Clusters
that Unicode composes only in part stay decomposed, in canonical order, so the form is still unique.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import columns, written
from . import screen

_CUT = "\x01"


#: One character of each stable run that the pattern tells apart; other stable characters pass as
#: unstable, which changes nothing but the work. Few runs keep the pattern fast.
ANCHORS = "\n a¡®àñĩơưạ“„、「。あア中가าאبनё"


def _pattern() -> str:
    """A cluster that may change: a character outside the stable runs, or any one with marks."""
    edges = [(0x1F, 0x1F), *[(a, b) for a, b in screen.unstable() if b > 0x1F], (screen.LAST, screen.LAST)]
    runs = [(a[1] + 1, b[0] - 1) for a, b in zip(edges, edges[1:])]
    stable = "\\n" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs if any(a <= ord(c) <= b for c in ANCHORS))
    return f"(?s)[^{stable}]\\p{{M}}*|[{stable}&&[^\\p{{M}}]]\\p{{M}}+|\\p{{M}}{{2,}}"


def _decompositions(spark: SparkSession) -> DataFrame:
    """Every character that is mapped or combines: its code points with their combining classes."""
    table = {chr(c): out for c, out in screen.decompositions().items()}
    for code in screen.codes():
        ch = chr(code)
        if unicodedata.combining(ch):
            table.setdefault(ch, ch)
    rows = [(ch, [(x, unicodedata.combining(x)) for x in out]) for ch, out in table.items()]
    return spark.createDataFrame(rows, "ch string, points array<struct<cp:string,class:int>>")


def _compositions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(screen.compositions().items()), "cluster string, composed string")


def unify(records: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, raw, form) of each distinct record: fingerprint of the text as stored, and its screen form."""
    spark = records.sparkSession
    rows = columns(records, *keys, text).where(F.col(text).isNotNull()).repartition(*keys).dropDuplicates([*keys, text])
    rows = rows.withColumn("raw", F.md5(text))
    by = [*keys, "raw"]
    clean = F.regexp_replace(F.translate(F.regexp_replace(F.col(text), "\r\n", "\n"), _CUT, ""), _pattern(), f"{_CUT}$0{_CUT}")
    pieces = rows.select(*by, F.posexplode(F.split(clean, _CUT)).alias("pos", "piece"))
    odd = F.col("pos") % 2 == 1
    points = pieces.select(*by, "pos", F.posexplode(F.when(odd, F.split("piece", "")).otherwise(F.array("piece"))).alias("at", "ch"))
    points = points.withColumn("ch_key", F.when(odd, F.col("ch")))
    mapped = points.join(F.broadcast(_decompositions(spark).withColumnRenamed("ch", "ch_key")), "ch_key", "left")
    itself = F.array(F.struct(F.col("ch").alias("cp"), F.lit(0).alias("class")))
    mapped = mapped.withColumn("points", F.coalesce("points", itself))
    grouped = mapped.groupBy(*by, "pos").agg(F.array_sort(F.collect_list(F.struct("at", "points"))).alias("own"))
    flat = F.flatten(F.transform("own", lambda x: x.points))
    # the number of the starter that a code point belongs to, then marks by class, then by place
    numbered = F.expr("transform(flat, (x, i) -> struct(size(filter(slice(flat, 1, i + 1), y -> y.class = 0)) as starter, x.class as class, i as i, x.cp as cp))")
    ordered = grouped.withColumn("flat", flat).withColumn("marks", F.array_sort(numbered))
    starters = F.expr("transform(array_distinct(transform(marks, m -> m.starter)), s -> array_join(transform(filter(marks, m -> m.starter = s), m -> m.cp), ''))")
    clusters = ordered.select(*by, "pos", F.posexplode_outer(starters).alias("k", "cluster"))
    clusters = clusters.withColumn("cluster_key", F.when(odd, F.col("cluster")))
    composed = clusters.join(F.broadcast(_compositions(spark).withColumnRenamed("cluster", "cluster_key")), "cluster_key", "left")
    composed = composed.withColumn("part", F.coalesce("composed", "cluster", F.lit("")))
    rebuilt = composed.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "k", "part"))).alias("parts"))
    return rebuilt.select(*by, F.array_join(F.transform("parts", lambda x: x.part), "").alias("form"))


def same_on_screen(records: DataFrame, field: str = "field", key: str = "key", text: str = "text") -> DataFrame:
    """(field, key_a, key_b), key_a < key_b: records whose texts look the same but differ in characters.

    The forms are made once and written as two fingerprints a record; forms of a single class of equal
    characters take no part. A record meets only records of other classes of its form: the pairs made
    are those returned.
    """
    forms = written(unify(records, [field, key], text).select(F.col(field).alias("field"), F.col(key).alias("key"), F.unhex("raw").alias("raw"), F.unhex(F.md5("form")).alias("form")))
    several = forms.groupBy("field", "form").agg(F.min("raw").alias("least"), F.max("raw").alias("most")).where("least <> most").select("field", "form")
    odd = written(forms.join(several.hint("merge"), ["field", "form"]))
    a = odd.select("field", "form", F.col("raw").alias("raw_a"), F.col("key").alias("a"))
    b = odd.select("field", "form", F.col("raw").alias("raw_b"), F.col("key").alias("b"))
    return a.join(b.hint("merge"), ["field", "form"]).where("a < b and raw_a <> raw_b").select("field", F.col("a").alias("key_a"), F.col("b").alias("key_b")).distinct()
