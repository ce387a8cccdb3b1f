"""Live versions of the daily index and of event counts, with watermarks for late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import label, weighted_score
from ..operators.upsert import last_per_key, upsert


def stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def live_index(scores: DataFrame, late: str = "7 days") -> DataFrame:
    """Index per calendar day (UTC) and ticker of a stream of scores (ticker, ts, sentiment_score, confidence)."""
    days = scores.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "ticker")
    out = days.agg(weighted_score().alias("sentiment_index"), F.count("*").alias("article_count"))
    return out.select(F.to_date("window.start").alias("date"), "ticker", "sentiment_index", label(F.col("sentiment_index")).alias("final_sentiment"), "article_count")


def live_counts(events: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events and their total value per window and type."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


#: Parts of a table by hash of the key; a batch rewrites those it touches. Fixed for the life of a table.
PARTS = 64


def _paths(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions of a table, oldest first."""
    place, files = _paths(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    numbers = sorted(int(n[1:]) for n in names if n.startswith("m") and n[1:].isdigit())
    return [n for n in numbers if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/m{n}/_SUCCESS"))]


def _parts(spark: SparkSession, path: str, number: int) -> dict[int, str]:
    """Where each part of a version lies."""
    return {r.part: r.place for r in spark.read.parquet(f"{path}/m{number}").collect()}


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The last whole version of a table that ``upsert_stream`` keeps; None before its first batch."""
    numbers = _versions(spark, path)
    return spark.read.parquet(*_parts(spark, path, numbers[-1]).values()) if numbers else None


def upsert_stream(changes: DataFrame, path: str, keys: list[str], order: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Keeps the latest row per key in a Parquet table; a batch that is run twice leaves the same table.

    A batch rewrites the parts (by hash of the key) of the keys it brings and then writes a list of where
    all parts lie, which makes the version whole; so a lost task or a restart never leaves half a table,
    and work goes with what a batch touches. The version before must be there, or the batch fails.
    Versions older than the one before are removed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        fresh = last_per_key(batch, keys, F.desc_nulls_last(order)).withColumn("_part", part).cache()
        earlier = [n for n in _versions(spark, path) if n < number]
        if number and not earlier:
            raise RuntimeError(f"batch {number} finds no version of {path} to go on from")
        known = _parts(spark, path, earlier[-1]) if earlier else {}
        touched = [r["_part"] for r in fresh.select("_part").distinct().collect()]
        old = [known[p] for p in touched if p in known]
        merged = upsert(spark.read.parquet(*old), fresh.drop("_part"), keys).withColumn("_part", part) if old else fresh
        merged.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{path}/v{number}")
        known |= {p: f"{path}/v{number}/_part={p}" for p in touched}
        spark.createDataFrame(sorted(known.items()), "part int, place string").coalesce(1).write.mode("overwrite").parquet(f"{path}/m{number}")
        fresh.unpersist()
        for gone in earlier[:-1]:
            used = {*known.values(), *_parts(spark, path, earlier[-1]).values()}
            for place in [*(set(_parts(spark, path, gone).values()) - used), f"{path}/m{gone}"]:
                where, files = _paths(spark, place)
                files.delete(where, True)

    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_memory(rows: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """All that is there now, as a table in memory; for tests and small results."""
    query = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return rows.sparkSession.table(name)
