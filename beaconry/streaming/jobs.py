"""Streaming jobs: ingest, curation, spend, drift windows, findings, features, search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from beaconry.functions.dates import bucket
from beaconry.operators.search import build_index, lengths
from beaconry.sources.tables import replace_table
from beaconry.streaming.sinks import all_windows, batch_folders, closing_windows, run_available, start_windows

LATENESS = "1 hour"


def limited(reader: DataStreamReader, files_per_batch: int | None) -> DataStreamReader:
    """All new files in one batch (None), or at most so many; by bytes: ``maxBytesPerTrigger``."""
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files below ``path``; an inbox without any file yet is made first."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    reader = limited(spark.readStream.schema(schema), files_per_batch)
    return reader.option("recursiveFileLookup", True).parquet(path)


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New ``*.txt`` files of an inbox, line by line."""
    spark.createDataFrame([], "value string").write.mode("ignore").text(path)
    return limited(spark.readStream, files_per_batch).option("pathGlobFilter", "*.txt").text(path)


def ready(rows: DataFrame, table: str) -> DataFrame:
    """An empty first folder of ``table``, so that it can be read before any batch."""
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("ignore").parquet(f"{table}/batch=-1")
    return rows


def event_time(stream: DataFrame, ts: str, lateness: str = LATENESS) -> DataFrame:
    """Watermarks need a zoned timestamp: the clock time of ``ts`` read as UTC, whatever
    the session zone, in ``event_time``."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))
    return stream.withColumn("event_time", F.timestamp_micros(micros)).withWatermark("event_time", lateness)


def window_day(window: str) -> Column:
    """Date of a one-day window of ``event_time``."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(f"{window}.start")) / 86400).cast("int"))


def land_files(spark: SparkSession, inbox: str, table: str, checkpoint: str, loaded_at: Column,
               files_per_batch: int | None = None) -> DataFrame:
    """New JSON files into the landing table, each file once."""
    lines = line_stream(spark, inbox, files_per_batch)
    rows = lines.select("value", F.col("_metadata.file_name").alias("source_file"))
    ready(rows.withColumn("loaded_at", loaded_at), table)
    run_available(rows, batch_folders(table, lambda b: b.withColumn("loaded_at", loaded_at)), checkpoint)
    return spark.read.parquet(table).select(F.parse_json("value").alias("payload"), "source_file", "loaded_at")


def curate_files(spark: SparkSession, inbox: str, table: str, checkpoint: str,
                 curate: Callable[[DataFrame], DataFrame], files_per_batch: int | None = None) -> DataFrame:
    """Landing to a typed table inside the stream (no state)."""
    raw = line_stream(spark, inbox, files_per_batch).select(F.parse_json("value").alias("payload"))
    run_available(ready(curate(raw), table), batch_folders(table), checkpoint)
    return spark.read.parquet(table).drop("batch")


def append_events(spark: SparkSession, inbox: str, schema: StructType, key: str, ts: str, table: str,
                  checkpoint: str) -> DataFrame:
    """Row-level append; an event repeated within the lateness is kept once."""
    rows = event_time(file_stream(spark, inbox, schema), ts).dropDuplicatesWithinWatermark([key])
    run_available(ready(rows.drop("event_time"), table), batch_folders(table), checkpoint)
    return spark.read.parquet(table).drop("batch")


def daily_spend(spark: SparkSession, inbox: str, schema: StructType, user: str, ts: str, amount: str,
                table: str, checkpoint: str) -> DataFrame:
    """Running spend per user and day; a day is final once the watermark has passed it."""
    rows = event_time(file_stream(spark, inbox, schema), ts)
    spend = (rows.groupBy(user, F.window("event_time", "1 day").alias("w")).agg(F.sum(amount).alias("spend"))
             .select(user, window_day("w").alias("day"), "spend"))
    run_available(start_windows(spend, table), closing_windows(table, [user, "day"], "day"), checkpoint, "update")
    return all_windows(spark, table, "day")


def limit_status(daily: DataFrame, user: str, monthly_limit: float, daily_limit: float) -> DataFrame:
    """Month totals and limit flags from the running day totals."""
    return daily.groupBy(user, bucket("month", F.col("day")).alias("month")).agg(
        F.sum("spend").alias("month_spend"), F.max("spend").alias("largest_day")).withColumns({
            "over_month": F.col("month_spend") > monthly_limit,
            "over_day": F.col("largest_day") > daily_limit})


def window_means(spark: SparkSession, inbox: str, schema: StructType, ts: str, value: str, table: str,
                 checkpoint: str) -> DataFrame:
    """Mean and count per one-day tumbling window."""
    rows = event_time(file_stream(spark, inbox, schema), ts)
    means = (rows.groupBy(F.window("event_time", "1 day").alias("w")).agg(
        F.avg(value).alias("mean_value"), F.count("*").alias("n"))
        .select(window_day("w").alias("window_start"), "mean_value", "n"))
    run_available(start_windows(means, table), closing_windows(table, ["window_start"], "window_start"), checkpoint, "update")
    return all_windows(spark, table, "window_start")


def refresh_findings(spark: SparkSession, inbox: str, schema: StructType, rollup: Callable[[DataFrame], DataFrame],
                     findings: Callable[[DataFrame], DataFrame], store: str, out: str, checkpoint: str) -> DataFrame:
    """Each trigger adds the batch's rollup and recomputes the findings from all rollups.

    Findings of trigger n go to their own folder; readers take the newest.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        batch_folders(store, rollup)(batch, batch_id)
        findings(spark.read.parquet(store)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_available(file_stream(spark, inbox, schema), step, checkpoint)
    rows = spark.read.parquet(out)
    return rows.filter(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def daily_feature_facts(spark: SparkSession, inbox: str, schema: StructType, key: str, ts: str, amount: str,
                        table: str, checkpoint: str) -> DataFrame:
    """Facts per (entity, day), added batch by batch; feature views read these few rows."""
    def per_day(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key, F.to_date(ts).alias("day")).agg(
            F.count("*").alias("n"), F.sum(amount).alias("amount"))

    rows = file_stream(spark, inbox, schema)
    ready(per_day(spark.createDataFrame([], schema)), table)
    run_available(rows, batch_folders(table, per_day), checkpoint)
    return (spark.read.parquet(table).groupBy(key, "day")
            .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount")))


def refresh_index(spark: SparkSession, inbox: str, schema: StructType, key: str, text: str, root: str,
                  checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Postings and statistics of the newest version of every document.

    A batch writes its documents' postings, their lengths, and a tombstone for
    each that an earlier batch has already brought; nothing older is rewritten.
    Readers drop postings that are older than their document's newest tombstone.
    Postings are clustered by term, so a query reads its terms' row groups. Of
    several versions in one batch the greatest text stays; documents without a key
    can't be replaced and all stay.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        known = F.col(key).isNotNull()
        # Texts are grouped for the keys that come several times in this batch, others stay where they are.
        repeated = replace_table(batch.filter(known).groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key),
                                 f"{root}/repeated/batch={batch_id}")
        fresh = (batch.select(key, text).join(repeated, key, "left_anti")
                 .unionByName(batch.join(repeated, key, "left_semi").groupBy(key).agg(F.max(text).alias(text))))
        earlier = spark.read.parquet(f"{root}/lengths").filter(F.col("batch") < batch_id)
        newest = earlier.filter(known).groupBy(key).agg(F.max_by("doc_len", "batch").alias("doc_len"))
        gone = newest.join(fresh.filter(known).select(key), key)
        batch_folders(f"{root}/tombstones")(gone, batch_id)
        batch_folders(f"{root}/lengths", lambda b: lengths(b, key, text))(fresh, batch_id)
        batch_folders(f"{root}/postings", lambda b: build_index(b, key, text, by_term=True).sortWithinPartitions("term"))(fresh, batch_id)

    rows = file_stream(spark, inbox, schema)
    none = spark.createDataFrame([], schema)
    ready(build_index(none, key, text), f"{root}/postings")
    ready(lengths(none, key, text), f"{root}/lengths")
    ready(lengths(none, key, text), f"{root}/tombstones")
    run_available(rows, step, checkpoint)
    dead = spark.read.parquet(f"{root}/tombstones")
    last = dead.groupBy(F.col(key).alias("_key")).agg(F.max("batch").alias("_batch"))
    postings = spark.read.parquet(f"{root}/postings")
    live = postings.join(last, (postings[key] == last["_key"]) & (postings["batch"] < last["_batch"]), "left_anti").drop("batch")
    # What came less what was replaced.
    both = spark.read.parquet(f"{root}/lengths").select("doc_len", F.lit(1).alias("one")).unionByName(
        dead.select("doc_len", F.lit(-1).alias("one")))
    total = both.agg(F.sum("one").alias("n"), F.sum(F.col("one") * F.col("doc_len")).alias("words"),
                     F.sum(F.when(F.col("doc_len").isNotNull(), F.col("one"))).alias("with_text"))
    return live, total.select("n", (F.col("words") / F.col("with_text")).alias("mean"))
