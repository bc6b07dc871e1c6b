"""Feature views and models registered under name and version."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.sources.tables import write_version


@dataclass(frozen=True)
class FeatureView:
    name: str
    version: str
    entity: str
    timestamp_column: str | None
    refresh: str
    frame: DataFrame


def register_views(views: list[FeatureView], root: str) -> DataFrame:
    """Write each view once per version; one metadata row per view with its size."""
    rows = []
    for view in views:
        stored = write_version(view.frame, f"{root}/{view.name}", view.version)
        rows.append(stored.agg(F.count("*").alias("rows"), F.count_distinct(view.entity).alias("entities")).select(
            F.lit(view.name).alias("view_name"), F.lit(view.version).alias("version"),
            F.lit(view.entity).alias("entity"), F.lit(view.timestamp_column).cast("string").alias("timestamp_column"),
            F.lit(view.refresh).alias("refresh"), "rows", "entities"))
    return reduce(DataFrame.unionByName, rows)
