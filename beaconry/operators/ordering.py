"""Total orders without a single-task window.

Rows are range-partitioned on the sort key, so one hot key spreads over many
slices. Range bounds are sampled and may differ when a stage is run again, so
the sliced rows are checkpointed once: a lost executor then re-reads the same
slices instead of cutting new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.session import shared_root


#: Rows of a slice beyond which there are more slices than shuffle partitions.
SLICE_ROWS = 2_000_000


def slice_count(df: DataFrame, slices: int | None) -> int:
    """Shuffle partitions of the session, or more where slices would outgrow SLICE_ROWS."""
    if slices:
        return slices
    least = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return max(int(least) if least.isdigit() else 1, -(-df.count() // SLICE_ROWS))


def range_slices(df: DataFrame, order: list[Column], slices: int | None = None) -> DataFrame:
    """Sorted slices in ``_slice`` (ascending) with the row's place in ``_pos``.

    Rows that tie on the order follow by a hash of their whole content, and rows
    alike in every column by their place in the task's sorted rows. A task that
    runs again thus cuts its rows the same way, and alike rows still spread.
    """
    shared_root(df.sparkSession)
    slices = slice_count(df, slices)
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    tied = (hashed.sortWithinPartitions(*order, "_hash")
            .withColumn("_tie", F.monotonically_increasing_id()))
    total = [*order, F.col("_hash"), F.col("_tie")]
    # The id is (partition << 33) + position within the partition.
    row_id = F.col("_row_id")
    return (tied.repartitionByRange(slices, *total)
            .sortWithinPartitions(*total)
            .withColumn("_row_id", F.monotonically_increasing_id())
            .withColumn("_slice", F.shiftright(row_id, 33))
            .withColumn("_pos", row_id.bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_row_id", "_hash", "_tie")
            .checkpoint())


def global_row_number(df: DataFrame, order: list[Column], name: str,
                      slices: int | None = None) -> DataFrame:
    """1-based position in a total order: slice offset + place within the slice.

    The offset table has one row per slice, whatever the data size.
    """
    sliced = range_slices(df, order, slices)
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
               .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (sliced.join(F.broadcast(offsets), "_slice")
            .withColumn(name, F.col("_before") + F.col("_pos") + 1)
            .drop("_slice", "_pos", "_before"))


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group; Spark cuts each task to ``n`` before the shuffle."""
    return (df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
            .filter(F.col("_rn") <= n).drop("_rn"))
