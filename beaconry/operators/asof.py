"""Point-in-time joins: the newest feature row at or before a spine time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions.dates import ntz
from beaconry.operators.ordering import range_slices


def asof_join(spine: DataFrame, features: DataFrame, entity: list[str], spine_ts: str,
              feature_ts: str, columns: list[str], slices: int | None = None) -> DataFrame:
    """Left join each spine row to the newest feature row with ``ts <= spine_ts``.

    Spine and features are stacked and cut into slices along (entity, time), so
    an entity that owns a third of the rows spreads over a third of the slices.
    Within a slice a running ``last`` finds the feature row. A slice boundary
    splits at most one entity, so what must be carried into a slice is a single
    row: the newest feature row of all earlier slices. That carry table has one
    row per slice. Feature rows that tie on time are ordered by their values.
    """
    left = spine.select(
        *[F.col(e) for e in entity], F.col(spine_ts).alias("_ts"), F.lit(1).alias("_kind"),
        F.struct(*spine.columns).alias("_row"))
    right = features.select(
        *[F.col(e) for e in entity], F.col(feature_ts).alias("_ts"), F.lit(0).alias("_kind"),
        F.struct(*[F.col(e) for e in entity],
                 F.struct(*columns).alias("value")).alias("_feature"))
    stacked = left.unionByName(right, allowMissingColumns=True)
    keys = [F.col(e) for e in entity]
    sliced = range_slices(
        stacked, keys + [F.col("_ts"), F.col("_kind"), F.col("_feature")], slices)

    running = W.partitionBy("_slice").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = (sliced.groupBy("_slice")
             .agg(F.max_by("_feature", F.when(F.col("_kind") == 0, F.col("_pos"))).alias("_tail"))
             .select("_slice", F.last("_tail", ignorenulls=True).over(earlier).alias("_carry")))

    joined = (sliced.withColumn("_near", F.last("_feature", ignorenulls=True).over(running))
              .filter(F.col("_kind") == 1)
              .join(F.broadcast(carry), "_slice")
              .withColumn("_hit", F.coalesce("_near", "_carry")))
    same = F.lit(True)
    for e in entity:
        same = same & (F.col(f"_hit.{e}") == F.col(e))
    return joined.select(
        *[F.col(f"_row.{c}").alias(c) for c in spine.columns],
        *[F.when(same, F.col(f"_hit.value.{c}")).alias(c) for c in columns])


def latest_features(features: DataFrame, entity: list[str], feature_ts: str,
                    as_of: datetime, columns: list[str]) -> DataFrame:
    """Newest row per entity at ``as_of``: one aggregate with map-side combine."""
    newest = (features.filter(F.col(feature_ts) <= ntz(as_of))
              .groupBy(*entity)
              .agg(F.max(F.struct(F.col(feature_ts).alias("_at"), *columns)).alias("_v")))
    return newest.select(*entity, *[F.col(f"_v.{c}").alias(c) for c in columns])
