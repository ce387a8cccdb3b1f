"""Pairs records of two tables by nearest time within a tolerance.

Both sides are hash-partitioned by (entity, time bucket) into Arrow groups, so a hot entity is spread
over its buckets. A record of the query side goes to each bucket that its tolerance touches, at most
two. Inside a group DuckDB runs a backward and a forward ASOF join, the nearer candidate within the
tolerance is kept (of two equally near ones the earlier), and the copies of a record are reduced to
the nearest. The number of groups follows the number of rows, so a group stays of bounded size.

Records with a null key, entity or time have no partner and no row; repeated rows count once.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import columns, parallelism

#: Length of a bucket; at least twice the tolerance.
BUCKET_US = 6 * 3600 * 1_000_000
GROUP_ROWS = 250_000

_NEAREST = """
with back as (select q.id, q.entity, q.us, t.us as bar from q asof join t on q.entity = t.entity and q.us >= t.us),
ahead as (select q.id, q.entity, q.us, t.us as bar from q asof join t on q.entity = t.entity and q.us <= t.us)
select id, entity, min({{'gap': abs(bar - us), 'bar': bar}}) as best
from (select * from back union all select * from ahead)
where abs(bar - us) <= {tolerance}
group by id, entity
"""


def _match(left: pa.Table, right: pa.Table, tolerance: int) -> pa.Table:
    schema = pa.schema([("id", pa.string()), ("entity", pa.string()), ("gap", pa.int64()), ("bar", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    import duckdb

    with duckdb.connect(config={"threads": 1}) as con:
        con.register("q", left.select(["id", "entity", "us"]))
        con.register("t", right.select(["entity", "us"]))
        found = con.execute(f"select id, entity, best.gap as gap, best.bar as bar from ({_NEAREST.format(tolerance=int(tolerance))})").to_arrow_table()
    return found.cast(schema)


def nearest(queries: DataFrame, targets: DataFrame, tolerance_us: int, bucket_us: int = BUCKET_US) -> DataFrame:
    """queries (id, entity, us), targets (entity, us), times in microseconds -> (id, entity, gap, bar)."""
    spark = queries.sparkSession
    bucket_us = max(bucket_us, 2 * tolerance_us)
    queries, targets = columns(queries, "id", "entity", "us"), columns(targets, "entity", "us")
    targets = targets.where("entity is not null and us is not null")
    queries = queries.where("id is not null and entity is not null and us is not null").distinct()
    groups = max(parallelism(spark), math.ceil((targets.count() + queries.count()) / GROUP_ROWS))
    block = lambda c: F.floor(c / F.lit(bucket_us)).cast("long")
    low, high = block(F.col("us") - tolerance_us), block(F.col("us") + tolerance_us)
    spread = lambda df: df.withColumn("g", F.pmod(F.xxhash64("entity", "bucket"), F.lit(groups)).cast("int"))
    left = spread(queries.withColumn("bucket", F.explode(F.array_distinct(F.array(low, high))))).select("g", "id", "entity", "us")
    right = spread(targets.withColumn("bucket", block(F.col("us")))).select("g", "entity", "us")

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        return _match(a, b, tolerance_us)

    found = left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(match, "id string, entity string, gap bigint, bar bigint")
    return found.groupBy("id", "entity").agg(F.min(F.struct("gap", "bar")).alias("best")).select("id", "entity", "best.gap", "best.bar")

