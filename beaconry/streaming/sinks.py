"""Checkpointed runs and sinks that survive a retried batch.

A batch always writes the folder of its own id with overwrite, so running it
again after a failure replaces its rows instead of adding them twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Callable[[DataFrame, int], None]


def batch_folders(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> Step:
    """Each micro-batch to ``path/batch=<id>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_available(stream: DataFrame, step: Step, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has arrived, then stop; the checkpoint remembers it."""
    started = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).foreachBatch(step).start())
    started.awaitTermination()


def start_windows(rows: DataFrame, path: str) -> DataFrame:
    """Empty folders for ``closing_windows``, so that they can be read before any batch."""
    none = rows.sparkSession.createDataFrame([], rows.schema)
    none.write.mode("ignore").parquet(f"{path}/final/batch=-1")
    for slot in (0, 1):
        none.withColumn("_at", F.lit(-1).cast("long")).write.mode("ignore").parquet(f"{path}/open/slot={slot}")
    return rows


def _closed(day: str, held: DataFrame, late_days: int) -> Column:
    """Days that no later batch can change: the watermark has passed the end of each."""
    newest = held.agg(F.max(day)).scalar()
    return F.coalesce(F.col(day) < F.date_sub(newest, late_days), F.lit(False))


def closing_windows(path: str, keys: list[str], day: str, late_days: int = 1) -> Step:
    """Updates of one-day windows: a day is written to ``final`` once, when it closes.

    Days that may still change are held in one of two slots, written in turn, so a batch
    reads the slot of the batch before and overwrites its own: running it again gives the
    same rows. A batch reads its updates and the open days, never the history; what is
    stored is the final days and the days of two batches. Rows without a day stay open.
    ``late_days``: whole days that cover the lateness of the watermark.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.parquet(f"{path}/open/slot={(batch_id - 1) % 2}")
        still = before.filter(~_closed(day, before, late_days))
        both = still.unionByName(batch.withColumn("_at", F.lit(batch_id).cast("long")))
        columns = [c for c in batch.columns if c not in keys]
        newest = both.groupBy(*keys).agg(F.max_by(F.struct(*columns), "_at").alias("_v")).select(*keys, "_v.*")
        mine = f"{path}/open/slot={batch_id % 2}"
        newest.withColumn("_at", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(mine)
        held = spark.read.parquet(mine)
        (held.filter(_closed(day, held, late_days)).drop("_at")
         .write.mode("overwrite").parquet(f"{path}/final/batch={batch_id}"))

    return write


def all_windows(spark: SparkSession, path: str, day: str, late_days: int = 1) -> DataFrame:
    """The final days and the newest state of the open ones."""
    slots = spark.read.parquet(f"{path}/open")
    held = slots.filter(F.col("_at") == slots.agg(F.max("_at")).scalar()).drop("_at", "slot")
    still = held.filter(~_closed(day, held, late_days))
    return spark.read.parquet(f"{path}/final").drop("batch").unionByName(still)
