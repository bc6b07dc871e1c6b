"""Bitmap index of attribute values: which rows hold a value, 32,768 ids to a bitmap.

Filters become unions and intersections of bitmaps, which are computed before any
row is ranked and are far smaller than the rows they stand for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_bitmaps(rows: DataFrame, key: str, attributes: dict[str, Column]) -> DataFrame:
    """``(attribute, value, bucket, bits)`` of every value of each attribute, as text.

    Tasks set bits before anything is shuffled, so a value that a third of the rows
    hold crosses as one bitmap per task and bucket. Null values and rows without a
    key have no bit.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), c.cast("string").alias("value")) for n, c in attributes.items()])
    held = (rows.select(F.col(key).cast("long").alias("_id"), F.explode(pairs).alias("_p")).select("_id", "_p.*")
            .filter("_id IS NOT NULL AND value IS NOT NULL"))
    return held.groupBy("attribute", "value", F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def store_bitmaps(bitmaps: DataFrame, path: str) -> DataFrame:
    """Clustered by attribute and value, so a filter reads its values' row groups only."""
    bitmaps.repartition("attribute", "bucket").sortWithinPartitions("attribute", "value").write.partitionBy("attribute").parquet(path)
    return bitmaps.sparkSession.read.parquet(path)


def matching(bitmaps: DataFrame, conditions: dict[str, list[str]]) -> DataFrame:
    """``(bucket, bits)``: rows that hold one of the listed values of every attribute."""
    wanted = [(F.col("attribute") == a) & F.col("value").isin(values) for a, values in conditions.items()]
    any_of = wanted[0]
    for w in wanted[1:]:
        any_of = any_of | w
    each = bitmaps.filter(any_of).groupBy("attribute", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return (each.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == len(conditions)).select("bucket", "bits"))


def holds(bits: Column, key: Column) -> Column:
    """Whether the key's bit is set in the bitmap of its bucket."""
    position = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), position % 8)), F.lit(2)) == 1


def restrict(rows: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """Rows whose key is set in ``allowed``."""
    own = F.col(key).cast("long")
    marked = rows.withColumn("_bucket", F.bitmap_bucket_number(own))
    return (marked.join(allowed.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")), "_bucket")
            .filter(holds(F.col("_bits"), own)).drop("_bucket", "_bits"))


def size_of(allowed: DataFrame) -> DataFrame:
    """How many rows a filter lets through, without reading any (one row)."""
    return allowed.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
