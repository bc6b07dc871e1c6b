"""Sources, sinks and table writes (groups A and J8-J9)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import ntz
from beaconry.functions.text import HTML_PASSES, html_to_text
from beaconry.operators.registry import FeatureView, register_views
from beaconry.plans import models as md
from beaconry.plans.feature_queries import CALENDAR_SQL, calendar, rfm
from beaconry.plans.metric_queries import THUMBS_SQL
from beaconry.plans.registry import query
from beaconry.session import Tables, scratch_path, values
from beaconry.sources import files, landing, tables

START = datetime(2024, 1, 1)


def app_messages(t: Tables) -> DataFrame:
    """Conversation turns with the fields of an app event."""
    conv = F.col("conv_id")
    channel = F.get(F.array(F.lit("web_chat"), F.lit("in_app"), F.lit("mobile")), F.pmod(conv, F.lit(3)).cast("int"))
    started = ntz(START) + F.make_dt_interval(mins=conv.cast("int"))
    ident = F.concat(F.lit("m"), conv.cast("string"), F.lit("-"), F.col("turn").cast("string"))
    return t.conversations.select(
        F.concat(F.lit("t"), conv.cast("string")).alias("thread_id"), conv.alias("customer_id"), channel.alias("channel"),
        F.lit("4.2.0").alias("app_version"), started.alias("started_at"), ident.alias("message_id"),
        F.col("turn").alias("turn_no"), "role", F.col("text").alias("content"),
        F.when(F.col("role") == "assistant", "small-model").alias("model"),
        (started + F.make_dt_interval(secs=(F.col("turn") * 20).cast("int"))).alias("created_at"))


def app_feedback(t: Tables) -> DataFrame:
    started = ntz(START) + F.make_dt_interval(mins=F.col("conv_id").cast("int"))
    return md.thumbs(t).select(
        F.concat(F.lit("t"), F.col("conv_id").cast("string")).alias("thread_id"),
        F.concat(F.lit("m"), F.col("conv_id").cast("string"), F.lit("-1")).alias("message_id"),
        F.col("rating").cast("long").alias("rating"), (started + F.expr("INTERVAL 30 SECONDS")).alias("created_at"))


def app_documents(t: Tables) -> DataFrame:
    return landing.thread_documents(app_messages(t), app_feedback(t))


def landed(t: Tables) -> DataFrame:
    """Documents written to the landing area and loaded back verbatim."""
    path = scratch_path(t.spark, "landing")
    landing.write_json_lines(app_documents(t), path)
    return landing.load_landing(t.spark, path, loaded_at=ntz(START))


@query("landing_threads", "A1 A2 A4 J1 J4 J8 J9", """
SELECT DISTINCT 't' || conv_id AS thread_id, conv_id AS customer_id, (['web_chat', 'in_app', 'mobile'])[conv_id % 3 + 1] AS channel,
 '4.2.0' AS app_version, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * conv_id AS started_at FROM conversations""")
def landing_threads(t):
    return landing.curate_threads(landed(t))


@query("landing_messages", "A2 J8 J9 D9", """
SELECT 'm' || conv_id || '-' || turn AS message_id, 't' || conv_id AS thread_id, turn AS turn_no, role, text AS content,
 CASE WHEN role = 'assistant' THEN 'small-model' END AS model,
 TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * conv_id + INTERVAL 1 SECOND * (turn * 20) AS created_at FROM conversations""")
def landing_messages(t):
    return landing.curate_messages(landed(t))


@query("landing_feedback", "J9 D9 J1", f"""
WITH {THUMBS_SQL} SELECT 'm' || conv_id || '-1' AS message_id, 't' || conv_id AS thread_id, rating::BIGINT AS rating, NULL::VARCHAR AS comment,
 TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * conv_id + INTERVAL 30 SECOND AS created_at FROM ratings""")
def landing_feedback(t):
    return landing.curate_feedback(landed(t))


@query("landing_staged_equals_persisted", "A6 A10", """
SELECT count(*) AS staged, count(*) AS persisted, 0::BIGINT AS different FROM conversations""")
def landing_staged_equals_persisted(t):
    """Messages curated straight off the files against those of a persisted landing table."""
    path = scratch_path(t.spark, "staged")
    landing.write_json_lines(app_documents(t), path)
    staged = landing.curate_messages(landing.load_landing(t.spark, path, loaded_at=ntz(START)))
    stored = tables.replace_table(landing.load_landing(t.spark, path, loaded_at=ntz(START)), scratch_path(t.spark, "raw"))
    persisted = landing.curate_messages(stored)
    both = (staged.select("message_id", F.xxhash64(*staged.columns).alias("h"), F.lit(1).alias("s"), F.lit(0).alias("p"))
            .unionByName(persisted.select("message_id", F.xxhash64(*persisted.columns).alias("h"), F.lit(0).alias("s"), F.lit(1).alias("p"))))
    per = both.groupBy("message_id", "h").agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
    return per.agg(F.sum("s").alias("staged"), F.sum("p").alias("persisted"),
                   F.count_if(F.col("s") != F.col("p")).alias("different"))


@query("landing_file_listing", "A7")
def landing_file_listing(t):
    path = scratch_path(t.spark, "listing")
    landing.write_json_lines(app_documents(t), path)
    return files.list_files(t.spark, path, "part-*").select("file_name", "size")


@query("transcript_lines", "A3 A4", """
WITH l AS (SELECT conv_id // 100 AS f, conv_id, turn, unnest(range(0, len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM conversations)
SELECT 'file_no=' || f AS folder, row_number() OVER (PARTITION BY f ORDER BY conv_id, turn, i) AS row_num, line FROM l""")
def transcript_lines(t):
    """Dialogue files of a hundred calls each, written as text and read back line by line."""
    path = scratch_path(t.spark, "transcripts")
    said = t.conversations.select(F.floor(F.col("conv_id") / 100).alias("file_no"), "conv_id", "turn", F.col("text").alias("value"))
    (said.repartition("file_no").sortWithinPartitions("file_no", "conv_id", "turn").select("file_no", "value")
     .write.partitionBy("file_no").text(path))
    return files.read_lines(t.spark, path, "*.txt").drop("file_name")


@query("manifest_csv", "A5", """
SELECT c_custkey AS call_id, c_name || ', "' || c_mktsegment || '"' AS brand, DATE '2024-01-01' + (c_custkey % 300)::INT AS call_date FROM customer""")
def manifest_csv(t):
    """Values with commas and quotes survive the round trip."""
    path = scratch_path(t.spark, "manifest")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("c_custkey", F.lit(300)).cast("int"))
    files.write_manifest(t.customer.select(
        F.col("c_custkey").alias("call_id"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("brand"), day.alias("call_date")), path)
    return files.read_manifest(t.spark, path, "call_id bigint, brand string, call_date date", strict=True)


@query("manifest_csv_tolerant", "A5", """
SELECT s_suppkey AS call_id, s_name AS brand, NULL::DATE AS call_date FROM supplier""")
def manifest_csv_tolerant(t):
    """Lines that end after two of three values load with NULL for the rest."""
    path = scratch_path(t.spark, "manifest")
    files.write_manifest(t.supplier.select(F.col("s_suppkey").alias("call_id"), F.col("s_name").alias("brand")), path)
    return files.read_manifest(t.spark, path, "call_id bigint, brand string, call_date date")


def html_sql(column: str) -> str:
    def literal(value: str) -> str:
        escaped = value.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n")
        return f"E'{escaped}'"

    for pattern, replacement in HTML_PASSES:
        column = f"regexp_replace({column}, {literal(pattern)}, {literal(replacement)}, 'g')"
    return column


@query("page_text", "A8", f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def page_text(t):
    return t.pages.select("page_id", html_to_text(F.col("html")).alias("text"))


@query("table_append", "A12 H1", """
SELECT c_custkey, 'base' AS origin FROM customer UNION ALL SELECT s_suppkey, 'added' FROM supplier""")
def table_append(t):
    path = scratch_path(t.spark, "append")
    tables.replace_table(t.customer.select("c_custkey", F.lit("base").alias("origin")), path)
    return tables.append_rows(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.lit("added").alias("origin")), path)


@query("table_delete_rows", "A13", "SELECT event_id, event_type FROM events WHERE NOT (event_type = 'error' OR value > 100)")
def table_delete_rows(t):
    rows = t.events.select("event_id", "event_type", "value")
    gone = (F.col("event_type") == "error") | (F.col("value") > 100)
    return tables.delete_rows(rows, gone, scratch_path(t.spark, "kept")).drop("value")


@query("table_inline_values_join", "A16 D1", """
WITH r(event_type, weight) AS (VALUES ('signup', 5), ('purchase', 3), ('click', 1))
SELECT event_type, weight, n, n * weight AS points FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) JOIN r USING (event_type)""")
def table_inline_values_join(t):
    weights = values(t.spark, [("signup", 5), ("purchase", 3), ("click", 1)], "event_type, weight")
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.join(weights, "event_type").select("event_type", "weight", "n", (F.col("n") * F.col("weight")).alias("points"))


@query("table_saved_scores", "A10 A15 A17", """
SELECT o_custkey AS c_custkey, count(*) AS orders FROM orders GROUP BY 1""")
def table_saved_scores(t):
    """A catalog table, stored once and read by name instead of computing again."""
    scored = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    path = scratch_path(t.spark, "scores")
    return tables.save_table(scored, f"saved_{path[-12:]}", path)


@query("dataset_version", "L8", """
SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1""")
def dataset_version(t):
    """The second write of a version does not change the first."""
    root = scratch_path(t.spark, "dataset")
    tables.write_version(t.customer, root, "v1")
    again = tables.write_version(t.customer.filter("c_acctbal > 0"), root, "v1")
    return again.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("feature_view_registry", "L1", """
WITH """ + CALENDAR_SQL + """ SELECT 'rfm' AS view_name, 'v1' AS version, 'c_custkey' AS entity, 'as_of_ts' AS timestamp_column, count(*) AS rows, count(DISTINCT o_custkey) AS entities FROM grid
UNION ALL SELECT 'static', 'v1', 'c_custkey', NULL, count(*), count(DISTINCT c_custkey) FROM customer""")
def feature_view_registry(t):
    """Registered views, written under name and version, with their size."""
    views = [
        FeatureView("rfm", "v1", "c_custkey", "as_of_ts", "1 day", rfm(t, calendar(t))),
        FeatureView("static", "v1", "c_custkey", None, "1 day", t.customer.select("c_custkey", "c_acctbal"))]
    return register_views(views, scratch_path(t.spark, "views")).drop("refresh")
