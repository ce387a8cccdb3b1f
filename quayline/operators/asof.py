"""Forward as-of join.

Both sides are merged by entity and time and the next target is carried back over the queries: one
sort, instead of a join of all pairs. Series are cut into buckets of time, so an entity that holds
much of the data is spread; what lies beyond a bucket is found over one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward(queries: DataFrame, targets: DataFrame, entity: str, query_time: str, target_time: str, bucket: int, values: list[str] | None = None) -> DataFrame:
    """Each query with the target of its entity at the smallest time at or after its own.

    Times are integers, ``bucket`` is the length of a bucket in their unit. Adds ``target_time`` and
    ``values`` to the queries; queries without such a target, or with a null entity or time, have
    nulls. Of targets with equal times the largest by ``values`` counts.
    """
    values = values or []
    payload = F.struct(F.col(target_time).alias("t"), *values)
    known = targets.where(F.col(entity).isNotNull() & F.col(target_time).isNotNull())
    hits = known.groupBy(F.col(entity).alias("_e"), F.col(target_time).cast("long").alias("_at")).agg(F.max(payload).alias("_hit"))
    asked = queries.select(F.col(entity).alias("_e"), F.col(query_time).cast("long").alias("_at"), F.struct(*queries.columns).alias("_ask"))
    merged = asked.unionByName(hits, allowMissingColumns=True).withColumn("_b", F.floor(F.col("_at") / bucket))
    back = Window.partitionBy("_e", "_b").orderBy(F.desc("_at"), F.col("_hit").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = merged.withColumn("_next", F.last("_hit", ignorenulls=True).over(back)).where("_ask is not null")
    # the first target of each bucket, carried back to the buckets before it
    firsts = hits.groupBy("_e", F.floor(F.col("_at") / bucket).alias("_b")).agg(F.min_by("_hit", "_at").alias("_far"))
    open_ends = near.where("_next is null").select("_e", "_b").distinct()
    line = open_ends.unionByName(firsts, allowMissingColumns=True)
    beyond = Window.partitionBy("_e").orderBy(F.desc("_b"), F.col("_far").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    far = line.withColumn("_far_next", F.last("_far", ignorenulls=True).over(beyond)).where("_far is null").select("_e", "_b", "_far_next")
    out = near.join(far, ["_e", "_b"], "left").withColumn("_next", F.coalesce("_next", "_far_next"))
    known_key = F.col("_e").isNotNull() & F.col("_at").isNotNull()
    return out.select("_ask.*", F.when(known_key, F.col("_next.t")).alias(target_time), *[F.when(known_key, F.col("_next")[v]).alias(v) for v in values])
