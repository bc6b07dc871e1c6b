"""Distinct counts over time from sketches that are kept per day and merged.

A sketch has a fixed size whatever it has seen, so months of a large table are read
from a few kilobytes a day and group; a day that comes again replaces its sketches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def error_bound(precision: int, sigmas: float = 4.0) -> float:
    """Relative error that an estimate keeps within, ``sigmas`` standard errors."""
    return sigmas * 1.04 / math.sqrt(1 << precision)


def write_day_sketches(rows: DataFrame, path: str, time: str, groups: list[str], value: str,
                       precision: int = 12) -> None:
    """One sketch of ``value`` per day and group, in one partition a day.

    The days in ``rows`` replace what is stored of them, all other days stay. Rows
    without a time are kept under day NULL; NULL values are not counted.
    """
    daily = rows.groupBy(F.to_date(time).alias("day"), *groups).agg(
        F.hll_sketch_agg(value, precision).alias("sketch"), F.count("*").alias("n_rows"))
    daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_day_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches: ``day``, the groups, ``sketch`` and ``n_rows``."""
    return spark.read.parquet(path)


def merged_counts(daily: DataFrame, by: list[Column | str]) -> DataFrame:
    """``distinct_estimate`` and ``n_rows`` of coarser groups, from the daily sketches alone."""
    return daily.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"), F.sum("n_rows").alias("n_rows"))
