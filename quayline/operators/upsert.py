"""Keyed writes: upsert, range rebuild, status updates and resumable appends over Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rule = Callable[[Column, Column], Column]


def last_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key by ``order``, as if the rows were written one after another."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], rules: dict[str, Rule] | None = None) -> DataFrame:
    """Rows of ``existing`` replaced by ``incoming`` of the same key, and the new ones; keys unique on both sides.

    ``rules`` tell for a column what to keep of the (old, new) value of a key that both have. Rows of
    ``incoming`` with a null in the key are dropped. The result is the same however often it is applied.
    """
    rules = rules or {}
    new = incoming.dropna(subset=keys).select(*existing.columns)
    values = [c for c in existing.columns if c not in keys]
    old_row = existing.select(*keys, F.struct(*[F.col(v) for v in values]).alias("_old"))
    new_row = new.select(*keys, F.struct(*[F.col(v) for v in values]).alias("_new"))
    both = old_row.join(new_row, keys, "full_outer")
    pick = lambda v: F.when(F.col("_new").isNull(), F.col("_old")[v]).when(F.col("_old").isNull() | F.lit(v not in rules), F.col("_new")[v]).otherwise(rules[v](F.col("_old")[v], F.col("_new")[v]) if v in rules else F.col("_new")[v])
    return both.select(*keys, *[pick(v).alias(v) for v in values]).select(*existing.columns)


def raw_only(old: Column, new: Column) -> Column:
    """A status is taken over only where the present one is still raw."""
    return F.when(old == "raw", new).otherwise(old)


def rebuild(existing: DataFrame, fresh: DataFrame, day: str, start: str) -> DataFrame:
    """Rows before ``start`` as they are, rows from ``start`` on from ``fresh``."""
    return existing.where(F.col(day) < start).unionByName(fresh.where(F.col(day) >= start).select(*existing.columns))


def write_days(rows: DataFrame, path: str, day: str) -> None:
    """Overwrites only the days that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key is not done yet; restartable and idempotent."""
    return work.join(done.select(*keys), keys, "left_anti")


def without_nan(rows: DataFrame) -> DataFrame:
    """NaN and infinite values as nulls."""
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    return rows.select(*[F.when(~bad(F.col(c)), F.col(c)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in rows.dtypes])
