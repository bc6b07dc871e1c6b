"""Shards through fixed virtual slots.

Records are hashed into a fixed number of slots; bytes and rows are summed per
slot (that table has one row per slot whatever the data size), and a versioned
slot-to-shard map says where a slot lives. Rebalancing edits the map, never the
hash: a record moves only when its slot does. A place inside the shard is the
number of rows of the shard's earlier slots plus the place inside the slot, so
no task ever orders a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.session import scratch_path, shared_root

#: Virtual slots; fixed for the life of a dataset.
SLOTS = 8192
#: Copies of one row that a task deals out at a time.
RUN = 4096


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """Version 0: slots dealt out in turn."""
    return np.arange(slots) % shards


def rebalance(placed: np.ndarray, loads: np.ndarray, shards: int,
              tolerance: float = 1e-4) -> np.ndarray:
    """An edited map whose shards carry nearly equal loads.

    While the fullest and emptiest shard differ by more than ``tolerance`` of the
    mean, the slot or the exchange of two slots that halves a difference best moves
    over: between the fullest shard and any other, or, where none helps, between any
    other and the emptiest. Every edit lowers the sum of squares, so it ends.
    """
    placed = placed.copy()
    totals = np.bincount(placed, weights=loads, minlength=shards)
    mean = max(totals.mean(), 1.0)
    for _ in range(4 * len(placed)):
        order = np.argsort(totals, kind="stable").tolist()
        if totals[order[-1]] - totals[order[0]] <= tolerance * mean:
            break
        for full, lean in [(order[-1], x) for x in order[:-1]] + [(x, order[0]) for x in order[-2:0:-1]]:
            edit = _edit(placed, loads, full, lean, totals[full] - totals[lean])
            if edit is not None:
                break
        else:
            break
        slot, back, moved = edit
        placed[slot] = lean
        if back is not None:
            placed[back] = full
        totals[full] -= moved
        totals[lean] += moved
    return placed


def _edit(placed: np.ndarray, loads: np.ndarray, full: int, lean: int, gap: float) -> tuple | None:
    """``(slot, slot to give back or None, bytes moved)``: nearest to half the gap of two shards."""
    mine, theirs = (np.flatnonzero((placed == k) & (loads > 0)) for k in (full, lean))
    if not len(mine) or gap <= 0:
        return None
    give = np.concatenate([loads[mine], (loads[mine][:, None] - loads[theirs]).ravel()])
    useful = np.where((give > 0) & (give < gap), np.abs(give - gap / 2), np.inf)
    best = int(useful.argmin())
    if useful[best] == np.inf:
        return None
    if best < len(mine):
        return mine[best], None, give[best]
    i, j = divmod(best - len(mine), len(theirs))
    return mine[i], theirs[j], give[best]


def grow(placed: np.ndarray, loads: np.ndarray, shards: int) -> np.ndarray:
    """One more shard: slots leave the fullest shards for it; no other slot moves."""
    placed = placed.copy()
    totals = np.append(np.bincount(placed, weights=loads, minlength=shards), 0.0)
    goal = totals.sum() / (shards + 1)
    while totals[shards] < goal:
        full = int(totals[:shards].argmax())
        mine = np.flatnonzero((placed == full) & (loads > 0) & (loads <= goal - totals[shards] + 1))
        if not len(mine):
            break
        slot = mine[loads[mine].argmax()]
        placed[slot] = shards
        totals[full] -= loads[slot]
        totals[shards] += loads[slot]
    return placed


def store_map(spark: SparkSession, folder: str, version: int, placed: np.ndarray) -> None:
    """Write one version of the map; a version is never overwritten."""
    rows = list(enumerate(placed.tolist()))
    (spark.createDataFrame(rows, "virtual_slot int, shard int")
     .coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}"))


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """``(virtual_slot, shard)`` of a stored version; as many rows as slots."""
    return spark.read.parquet(f"{folder}/version={version}")


def slot_records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)``; size is the UTF-8 bytes plus 8.

    A null text has no bytes and checksum 0. The slot hashes id, checksum and the
    number of the copy, so rows with equal or null ids spread out, repeated rows too.
    Copies have nothing to tell them apart: they are counted per task before the
    shuffle and dealt out again in runs of RUN, so that no task holds a hot row's copies.
    """
    shared_root(df.sparkSession)
    text = F.encode(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "UTF-8")
    counted = (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("_bytes"))
               .select("doc_id", (F.octet_length("_bytes") + F.lit(8)).cast("long").alias("size"),
                       F.crc32("_bytes").alias("text_crc32"))
               .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
               .checkpoint())  # both parts below read it; the texts are read once
    rare = counted.filter(F.col("copies") <= RUN).withColumn("first", F.lit(0).cast("long"))
    often = (counted.filter(F.col("copies") > RUN)
             .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
             .repartition("doc_id", "text_crc32", "first"))
    last = F.least(F.col("first") + RUN, "copies") - 1
    # The first copy has the slot that a row without copies has.
    hashed = F.when(F.col("copy") == 0, F.xxhash64("doc_id", "text_crc32")).otherwise(
        F.xxhash64("doc_id", "text_crc32", "copy"))
    return (rare.unionByName(often).withColumn("copy", F.explode(F.sequence("first", last)))
            .select("doc_id", "size", "text_crc32",
                    F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot")))


def shard_records(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """All records with shard and place: the law of equal bytes.

    ``(doc_id, size, text_crc32, virtual_slot, shard, slot)``; ``slot`` counts
    from 0 without gaps inside each shard. Map versions 0 (dealt out in turn)
    and 1 (edited by the summed bytes) are stored below ``folder``. Repeated rows
    and rows with null ids each get a place; an empty table gives no rows. A
    single record larger than its fair share stays whole.
    """
    spark = df.sparkSession
    shared_root(spark)
    folder = folder or scratch_path(spark, "slot-map")
    records = slot_records(df, id_col, text_col, slots).checkpoint()
    summed = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    loads, rows = np.zeros(slots), np.zeros(slots, dtype=np.int64)
    loads[summed["virtual_slot"]] = summed["bytes"]
    rows[summed["virtual_slot"]] = summed["rows"]
    placed = first_map(shards, slots)
    store_map(spark, folder, 0, placed)
    placed = rebalance(placed, loads, shards)
    store_map(spark, folder, 1, placed)
    base = np.zeros(slots, dtype=np.int64)
    for shard in range(shards):
        mine = np.flatnonzero(placed == shard)
        base[mine] = np.cumsum(rows[mine]) - rows[mine]
    bases = spark.createDataFrame(list(enumerate(base.tolist())), "virtual_slot int, _base long")
    # Both tables have one row per slot: a fixed size.
    where = load_map(spark, folder, 1).join(F.broadcast(bases), "virtual_slot")
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (records.withColumn("_nth", F.row_number().over(inside) - 1)
            .join(F.broadcast(where), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "virtual_slot", "shard",
                    (F.col("_base") + F.col("_nth")).alias("slot")))
