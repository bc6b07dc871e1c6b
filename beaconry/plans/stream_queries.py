"""Streams fed from files in several batches; each must equal its batch twin (group Q)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import ntz, sunday_zero_weekday
from beaconry.operators.search import search_index
from beaconry.operators.series import detect_anomalies
from beaconry.plans.ingest_queries import START, app_documents
from beaconry.plans.registry import ORACLES, query
from beaconry.plans.series_queries import ROUND_FOUND
from beaconry.plans.text_queries import QUERY
from beaconry.session import Tables, rounded, scratch_path
from beaconry.sources import landing
from beaconry.streaming import jobs


def arrivals(t: Tables, df: DataFrame, ts: str, job: Callable[[str], DataFrame], parts: int = 4,
             overlap: timedelta = timedelta(0)) -> DataFrame:
    """Result of ``job`` on an inbox that fills slice by slice, oldest first.

    The job runs again after each slice and goes on from its checkpoint. A slice
    is written by as many tasks as it has; ``overlap`` sends the rows just
    before a slice a second time. Rows without a time come with the last slice.
    """
    inbox = scratch_path(t.spark, "inbox")
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if span["lo"] is None:  # no time at all: everything arrives at once
        df.write.mode("append").parquet(inbox)
        return job(inbox)
    step = (span["hi"] - span["lo"]) / parts
    out = None
    for i in range(parts):
        arrived = F.col(ts) >= ntz(span["lo"] + step * i - (overlap if i else timedelta(0)))
        if i < parts - 1:
            arrived &= F.col(ts) < ntz(span["lo"] + step * (i + 1))
        else:
            arrived |= F.col(ts).isNull()
        df.filter(arrived).write.mode("append").parquet(inbox)
        out = job(inbox)
    return out


def json_arrivals(t: Tables, job: Callable[[str], DataFrame], parts: int = 3) -> DataFrame:
    inbox, out = scratch_path(t.spark, "inbox"), None
    for i in range(parts):
        some = app_documents(t).filter(F.pmod(F.xxhash64("payload"), F.lit(parts)) == i)
        landing.write_json_lines(some, inbox, "append")
        out = job(inbox)
    return out


def places(t: Tables, name: str) -> tuple[str, str]:
    root = scratch_path(t.spark, name)
    return f"{root}/table", f"{root}/checkpoint"


@query("stream_landing_files", "A9 Q1", """
SELECT 't' || conv_id AS thread_id, count(*) AS messages FROM conversations GROUP BY 1""")
def stream_landing_files(t):
    table, checkpoint = places(t, "land")
    raw = json_arrivals(t, lambda inbox: jobs.land_files(t.spark, inbox, table, checkpoint, ntz(START)))
    return landing.curate_messages(raw).groupBy("thread_id").agg(F.count("*").alias("messages"))


@query("stream_curated_messages", "Q2 J9", ORACLES["landing_messages"])
def stream_curated_messages(t):
    table, checkpoint = places(t, "curated")
    return json_arrivals(t, lambda inbox: jobs.curate_files(t.spark, inbox, table, checkpoint, landing.curate_messages))


@query("stream_events_deduplicated", "Q8", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def stream_events_deduplicated(t):
    """Each slice brings the last half hour of the one before again; the table holds every event once."""
    table, checkpoint = places(t, "events")
    return arrivals(t, t.events, "ts", lambda inbox: jobs.append_events(
        t.spark, inbox, t.events.schema, "event_id", "ts", table, checkpoint), overlap=timedelta(minutes=30))


@query("stream_spend_against_limits", "Q7 O7", """
WITH d AS (SELECT user_id, ts::DATE AS day, sum(value) AS s FROM events GROUP BY ALL)
SELECT user_id, date_trunc('month', day)::DATE AS month, round(sum(s), 2) AS month_spend, round(max(s), 2) AS largest_day,
 sum(s) > 3600 AS over_month, max(s) > 400 AS over_day FROM d GROUP BY ALL""")
def stream_spend_against_limits(t):
    table, checkpoint = places(t, "spend")
    daily = arrivals(t, t.events, "ts", lambda inbox: jobs.daily_spend(
        t.spark, inbox, t.events.schema, "user_id", "ts", "value", table, checkpoint))
    return rounded(jobs.limit_status(daily, "user_id", 3600, 400), {"month_spend": 2, "largest_day": 2})


@query("stream_daily_windows", "Q6 M15", """
SELECT ts::DATE AS window_start, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1""")
def stream_daily_windows(t):
    table, checkpoint = places(t, "windows")
    out = arrivals(t, t.events, "ts", lambda inbox: jobs.window_means(
        t.spark, inbox, t.events.schema, "ts", "value", table, checkpoint))
    return rounded(out, {"mean_value": 6})


@query("stream_findings_refreshed", "Q3 M12", ORACLES["anomaly_many_series"])
def stream_findings_refreshed(t):
    """Hourly recomputation: the last refresh equals the batch findings."""
    def rollup(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(
            F.count_if(F.col("event_type") == "error").alias("errors"), F.count("*").alias("n"))

    def findings(stored: DataFrame) -> DataFrame:
        days = stored.groupBy("user_id", "day").agg((F.sum("errors") / F.sum("n")).alias("rate"))
        end = stored.agg(F.max("day").cast("timestamp_ntz").alias("m")).first()["m"]
        return detect_anomalies(days, ["user_id"], "day", "rate", end - timedelta(days=14),
                                season=sunday_zero_weekday(F.col("day")), interval=0.99)

    table, checkpoint = places(t, "findings")
    out = arrivals(t, t.events, "ts", lambda inbox: jobs.refresh_findings(
        t.spark, inbox, t.events.schema, rollup, findings, f"{table}/rollup", f"{table}/findings", checkpoint))
    return rounded(out, ROUND_FOUND)


@query("stream_daily_feature_facts", "Q4 L2", """
SELECT o_custkey, o_orderdate::DATE AS day, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY ALL""")
def stream_daily_feature_facts(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    table, checkpoint = places(t, "facts")
    out = arrivals(t, orders, "o_orderdate", lambda inbox: jobs.daily_feature_facts(
        t.spark, inbox, orders.schema, "o_custkey", "o_orderdate", "o_totalprice", table, checkpoint))
    return rounded(out, {"amount": 2})


@query("stream_search_index", "Q5 N17", ORACLES["search_stored_index"])
def stream_search_index(t):
    """Half of the documents first come in an older version, which the index must forget."""
    docs = t.documents.select("doc_id", "text")
    inbox = scratch_path(t.spark, "inbox")
    table, checkpoint = places(t, "index")
    early = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, F.lit(False))
    older = docs.filter(early).withColumn("text", F.concat(F.lit(QUERY + " "), F.coalesce("text", F.lit(""))))
    for part in (older, docs):
        part.write.mode("append").parquet(inbox)
        index, size = jobs.refresh_index(t.spark, inbox, docs.schema, "doc_id", "text", table, checkpoint)
    return search_index(index, size, "doc_id", QUERY, 20)
