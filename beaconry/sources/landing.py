"""JSON landing area: write documents, load them verbatim, curate typed tables.

The curate functions are plain DataFrame → DataFrame and serve batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGES = ("array<struct<message_id: string, turn_no: bigint, role: string, content: string, "
            "model: string, created_at: timestamp_ntz>>")
FEEDBACK = "array<struct<message_id: string, rating: bigint, comment: string, created_at: timestamp_ntz>>"


def thread_documents(messages: DataFrame, feedback: DataFrame) -> DataFrame:
    """One JSON document per thread with nested messages[] and feedback[].

    ``messages``: thread_id, customer_id, channel, app_version, started_at plus the
    fields of a message; ``feedback``: thread_id plus the fields of a rating. A
    thread without ratings carries an empty array; NULL fields are left out.
    """
    head = ["thread_id", "customer_id", "channel", "app_version", "started_at"]
    turns = messages.groupBy(*head).agg(F.array_sort(F.collect_list(F.struct(
        "turn_no", "message_id", "role", "content", "model", "created_at"))).alias("messages"))
    ratings = feedback.groupBy("thread_id").agg(F.array_sort(F.collect_list(F.struct(
        "message_id", "rating", "created_at"))).alias("feedback"))
    whole = turns.join(ratings, "thread_id", "left").withColumn(
        "feedback", F.coalesce("feedback", F.array()))
    return whole.select(F.to_json(F.struct(*head, "messages", "feedback")).alias("payload"))


def write_json_lines(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    documents.select("payload").write.mode(mode).text(path)


def with_landing_columns(lines: DataFrame, loaded_at: Column) -> DataFrame:
    """payload as VARIANT, source file name and load time, nothing else touched."""
    return lines.select(F.parse_json("value").alias("payload"),
                        F.col("_metadata.file_name").alias("source_file"), loaded_at.alias("loaded_at"))


def load_landing(spark: SparkSession, path: str, pattern: str = "*.txt",
                 loaded_at: Column | None = None) -> DataFrame:
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    return with_landing_columns(lines, loaded_at if loaded_at is not None else F.current_timestamp())


def _field(name: str, kind: str) -> Column:
    return F.try_variant_get("payload", f"$.{name}", kind).alias(name)


def curate_threads(raw: DataFrame) -> DataFrame:
    return raw.select(_field("thread_id", "string"), _field("customer_id", "bigint"), _field("channel", "string"),
                      _field("app_version", "string"), _field("started_at", "timestamp_ntz"))


def curate_messages(raw: DataFrame) -> DataFrame:
    """One row per message; a thread without messages yields no row."""
    return (raw.select(_field("thread_id", "string"), F.explode(_field("messages", MESSAGES)).alias("m"))
            .select("m.message_id", "thread_id", "m.turn_no", "m.role", "m.content", "m.model", "m.created_at"))


def curate_feedback(raw: DataFrame) -> DataFrame:
    """One row per rating; ``comment`` is NULL because no document carries it."""
    return (raw.select(_field("thread_id", "string"), F.explode(_field("feedback", FEEDBACK)).alias("f"))
            .select("f.message_id", "thread_id", "f.rating", "f.comment", "f.created_at"))
