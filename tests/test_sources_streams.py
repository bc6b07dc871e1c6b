import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from beaconry.functions.dates import ntz
from beaconry.operators import evals as ev
from beaconry.operators import usage as us
from beaconry.functions import sampling as sp
from beaconry.session import scratch_path, shared_root
from beaconry.sources import files, landing, tables
from beaconry.streaming import jobs
from beaconry.streaming.sinks import batch_folders


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_lines_and_listing(spark, tmp_path):
    folder = str(tmp_path / "calls")
    put(folder, "transcript_1.txt", "CALL_ID: CS-1\n\nhello, \"you\"\n")
    put(folder, "transcript_2.txt", "only")
    put(folder, "transcript_3.dat", "skip")
    put(folder, "notes.md", "skip")
    got = rows(files.read_lines(spark, folder, "transcript_*.txt").drop("folder"))
    assert sorted(got) == [("transcript_1.txt", 1, "CALL_ID: CS-1"), ("transcript_1.txt", 2, ""),
                           ("transcript_1.txt", 3, 'hello, "you"'), ("transcript_2.txt", 1, "only")]
    assert ("notes.md", 4) in rows(files.list_files(spark, folder).select("file_name", "size"))


def test_manifest_modes(spark, tmp_path):
    folder = str(tmp_path / "m")
    put(folder, "manifest.csv", 'ID,DAY,NAME\n1,2024-01-02,"A, ""x"""\n2,2024-01-03\n3,2024-01-04,C,extra\n')
    schema = "id bigint, day date, name string"
    got = rows(files.read_manifest(spark, folder, schema).select("id", "name"))
    assert got == [(1, 'A, "x"'), (2, None), (3, "C")]
    with pytest.raises(Exception):
        files.read_manifest(spark, folder, schema, strict=True).collect()
    put(folder, "bad.csv", "ID,DAY,NAME\n4,not-a-date,D\n")
    with pytest.raises(Exception, match="not-a-date"):
        files.read_manifest(spark, folder, schema).collect()


def test_empty_inbox_and_table(spark, tmp_path):
    schema = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, value double").schema
    places = [str(tmp_path / x) for x in ("inbox", "table", "checkpoint")]
    assert jobs.append_events(spark, places[0], schema, "event_id", "ts", *places[1:]).count() == 0
    other = [str(tmp_path / x) for x in ("inbox2", "table2", "checkpoint2")]
    assert jobs.land_files(spark, *other, F.lit(None).cast("timestamp_ntz")).count() == 0


def test_slices_do_not_depend_on_row_order(spark):
    from beaconry.operators.ordering import range_slices
    df = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    one, two = (sorted(map(tuple, range_slices(x, [F.col("k")], 5).select("k", "v", "_pos").collect()))
                for x in (df, df.orderBy(F.rand(3)).repartition(6)))
    order = [[v for k, v, p in sorted(x, key=lambda r: (r[0], r[2]))] for x in (one, two)]
    assert sorted(order[0]) == sorted(order[1]) == list(range(400))


def test_landing_null_rules(spark):
    docs = ['{"thread_id":"t1","customer_id":5,"messages":[{"message_id":"m","turn_no":1,"role":"user","content":"hi"}],"feedback":[]}',
            '{"thread_id":"t2","feedback":[{"message_id":"m","rating":-1}]}']
    raw = spark.createDataFrame([(d,) for d in docs], "value string").select(F.parse_json("value").alias("payload"))
    threads = landing.curate_threads(raw)
    assert rows(threads.select("thread_id", "customer_id", "channel")) == [("t1", 5, None), ("t2", None, None)]
    assert rows(landing.curate_messages(raw).select("thread_id", "content", "model")) == [("t1", "hi", None)]
    assert rows(landing.curate_feedback(raw).select("thread_id", "rating", "comment")) == [("t2", -1, None)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "k int, v int")
    kept = tables.delete_rows(df, F.col("v") > 2, str(tmp_path / "kept"))
    assert rows(kept) == [(1, 1), (2, None)]
    root = str(tmp_path / "ds")
    tables.write_version(df, root, "v1")
    assert tables.write_version(df.limit(1), root, "v1").count() == 3
    assert tables.load_version(spark, root, "v1").count() == 3
    assert tables.append_rows(df, str(tmp_path / "kept")).count() == 5


def test_scratch_lies_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_root(spark))


def test_split_and_sample(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    train, valid = sp.split_train_valid(df, "k", "s")
    assert train.count() + valid.count() == 1000
    assert train.join(valid, "k").count() == 0 and 740 < train.count() < 860
    assert sp.sample_rows(df, "k", 50, "s").count() == 50
    assert rows(sp.sample_rows(df, "k", 5, "s")) == rows(sp.sample_rows(df.repartition(7), "k", 5, "s"))
    shares = dict(rows(df.groupBy(sp.weighted_choice(F.col("k"), "w", {"a": 1, "b": 3})).count()))
    assert set(shares) == {"a", "b"} and shares["b"] > shares["a"]


def test_each_file_once(spark, tmp_path):
    inbox, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    put(inbox, "a.txt", '{"thread_id":"t1"}\n{"thread_id":"t2"}\n')
    at = ntz(datetime(2024, 1, 1))
    assert jobs.land_files(spark, inbox, table, cp, at).count() == 2
    assert jobs.land_files(spark, inbox, table, cp, at).count() == 2
    put(inbox, "b.txt", '{"thread_id":"t3"}\n')
    got = jobs.land_files(spark, inbox, table, cp, at)
    assert rows(landing.curate_threads(got).select("thread_id")) == [("t1",), ("t2",), ("t3",)]


def test_retried_batch_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    step = batch_folders(path)
    step(spark.range(3), 0)
    step(spark.range(3), 0)
    assert spark.read.parquet(path).count() == 3


def event(i, user, at, value):
    return (i, user, datetime.fromisoformat(at), value)


def test_spend_stream_across_restarts(spark, tmp_path):
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    inbox, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))

    def arrive(*events):
        spark.createDataFrame(list(events), schema).coalesce(1).write.mode("append").parquet(inbox)
        df = spark.read.parquet(inbox)
        return jobs.daily_spend(spark, inbox, df.schema, "user_id", "ts", "value", table, cp)

    arrive(event(1, 1, "2024-01-01 10:00", 5.0), event(2, 1, "2024-01-01 11:00", 7.0))
    out = arrive(event(3, 1, "2024-01-01 23:30", 1.0), event(4, 2, "2024-01-02 00:10", 2.0))
    assert sorted((r["user_id"], r["day"].day, r["spend"]) for r in out.collect()) == [(1, 1, 13.0), (2, 2, 2.0)]
    status = jobs.limit_status(out, "user_id", 10, 100).collect()
    assert {r["user_id"]: (r["over_month"], r["over_day"]) for r in status} == {1: (True, False), 2: (False, False)}


def test_deduplication_within_lateness(spark, tmp_path):
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    inbox, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    for _ in range(2):
        spark.createDataFrame([event(1, 1, "2024-01-01 10:00", 5.0)], schema).coalesce(1).write.mode("append").parquet(inbox)
        got = jobs.append_events(spark, inbox, spark.read.parquet(inbox).schema, "event_id", "ts", table, cp)
    assert got.count() == 1


def test_usage_edges(spark):
    day = datetime(2024, 1, 15)
    hist = spark.createDataFrame(
        [(day, 1, 1, "f", "m", 100.0, 0, False, "team:a"), (day, 1, 1, "g", "m", 50.0, 10, False, "team:a"),
         (day, 2, 2, "f", "n", 1.0, 10, True, "project:z")],
        "start_time timestamp_ntz, query_id long, user_id long, function_name string, model_name string, credits double, "
        "tokens long, is_completed boolean, query_tag string")
    users = spark.createDataFrame([(2, "b")], "user_id long, user_name string")
    running = us.still_running(hist, users, day).collect()
    assert [(r["query_id"], r["functions"], r["credits_so_far"], r["user_name"]) for r in running] == [(1, "f, g", 150.0, None)]
    texts = spark.createDataFrame([("abcd",), ("abcde",)], "t string")
    priced = us.estimate_cost(texts, "t", "none", hist, 3.0).first()
    assert priced["total_input_tokens"] == 3 and priced["projected_usd"] is None
    assert us.estimate_cost(texts, "t", "none", hist, 3.0, 1e6).first()["projected_usd"] == 9.0
    assert us.monthly_budget_alert(hist, datetime(2023, 1, 1), 1).first()["alert"] is False
    assert rows(us.spend_by_tag(hist, "team").select("team", "credits")) == [("a", 150.0), (None, 1.0)]
    over = us.users_over_limits(hist, 120, 400).collect()
    assert [(r["user_id"], r["over_month"], r["days_over"]) for r in over] == [(1, True, 0)]


def test_evaluation_edges(spark):
    h = spark.createDataFrame([("a", 1, "r1", 0.9), ("a", 2, "r2", 0.8), ("b", 1, "r1", 0.5), ("b", 2, "r2", 0.54),
                               ("c", 1, "r1", 0.1), ("c", 2, "r2", 0.3), ("d", 1, "r1", 0.1)],
                              "metric_name string, run_ts int, run_name string, avg_score double")
    got = {r["metric_name"]: r["status"] for r in ev.regression_status(h).collect()}
    assert got == {"a": "REGRESSION", "b": "STABLE", "c": "IMPROVEMENT"}
    log = spark.createDataFrame([(["x"], ["x"]), (["y"], ["x"]), ([], ["x", "y"])], "called array<string>, expected array<string>")
    assert rows(ev.tool_selection(log, "called", "expected").select("missing_tools", "extra_tools", "tools_match")) == [
        (0, 0, True), (1, 1, False), (2, 0, False)]
    facts = spark.range(1).select(F.lit(3).alias("n"))
    got = rows(ev.check_rows([(facts, {"some": F.col("n") > 0, "null_fails": F.lit(None).cast("boolean"), "none": F.col("n") > 9})]))
    assert got == [("none", "FAIL"), ("null_fails", "FAIL"), ("some", "PASS")]


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    """The policy is one hour: later than that, a closed day does not change any more."""
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    inbox, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    out = None
    for e in (event(1, 1, "2024-01-01 10:00", 5.0), event(2, 1, "2024-01-05 10:00", 7.0), event(3, 1, "2024-01-01 11:00", 100.0)):
        spark.createDataFrame([e], schema).coalesce(1).write.mode("append").parquet(inbox)
        out = jobs.daily_spend(spark, inbox, spark.read.parquet(inbox).schema, "user_id", "ts", "value", table, cp)
    assert sorted((r["day"].day, r["spend"]) for r in out.collect()) == [(1, 5.0), (5, 7.0)]


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    inbox, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    e = [event(1, 1, "2024-01-01 00:30", 5.0), event(2, 1, "2024-01-01 23:30", 7.0)]
    spark.createDataFrame(e, schema).coalesce(1).write.parquet(inbox)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = jobs.daily_spend(spark, inbox, spark.read.parquet(inbox).schema, "user_id", "ts", "value", table, cp)
        assert [(str(r["day"]), r["spend"]) for r in got.collect()] == [("2024-01-01", 12.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_index_forgets_replaced_documents(spark, tmp_path):
    from beaconry.operators import search as se
    from beaconry.session import scratch_path
    from beaconry.streaming import jobs

    batches = [[(1, "red owl"), (2, "owl owl fox"), (3, None), (None, "owl")], [(2, "green fox"), (4, "owl")],
               [(2, "owl night"), (1, "red owl")]]
    inbox, root, checkpoint = (scratch_path(spark, n) for n in ("inbox", "index", "checkpoint"))
    now = {}
    for n, rows_ in enumerate(batches):
        df = spark.createDataFrame(rows_, "id long, t string")
        df.coalesce(1).write.mode("append").parquet(inbox)
        index, size = jobs.refresh_index(spark, inbox, df.schema, "id", "t", root, checkpoint)
        now |= dict(rows_)
        whole = spark.createDataFrame(list(now.items()), "id long, t string")
        assert sorted(map(tuple, index.select("term", "id", "doc_len", "tf").collect()), key=repr) == sorted(
            map(tuple, se.build_index(whole, "id", "t").select("term", "id", "doc_len", "tf").collect()), key=repr)
        got, want = size.first(), se.corpus_size(whole, "t").first()
        assert got["n"] == want["n"] and abs(got["mean"] - want["mean"]) < 1e-12
    # A batch writes its own documents alone.
    assert spark.read.parquet(f"{root}/lengths").filter("batch = 2").count() == 2
    assert spark.read.parquet(f"{root}/tombstones").count() == 3


def test_rows_without_a_time_arrive(spark):
    from datetime import datetime

    from beaconry.plans.stream_queries import arrivals

    class T:
        pass

    t = T()
    t.spark = spark
    day = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, day), (2, None), (3, day.replace(day=9))], "i int, ts timestamp_ntz")
    for rows_, n in ((df, 3), (df.filter("i = 2"), 1), (df.limit(0), 0)):
        assert arrivals(t, rows_, "ts", lambda inbox: spark.read.schema(df.schema).parquet(inbox)).count() == n


def test_closed_days_are_stored_once_and_batches_may_run_again(spark, tmp_path):
    from beaconry.streaming.sinks import all_windows, closing_windows, start_windows

    path = str(tmp_path / "windows")
    schema = "user_id long, day date, spend double"
    start_windows(spark.createDataFrame([], schema), path)
    step = closing_windows(path, ["user_id", "day"], "day")
    state, day = {}, datetime(2024, 1, 1).date()
    for batch in range(12):
        today = day + timedelta(days=batch)
        updates = [(1, today, float(batch)), (None, today, 1.0), (1, today - timedelta(days=1), 100.0 + batch)]
        state |= {u[:2]: u[2] for u in updates}
        for _ in range(2):  # each batch is retried
            step(spark.createDataFrame(updates, schema), batch)
        got = {(r["user_id"], r["day"]): r["spend"] for r in all_windows(spark, path, "day").collect()}
        assert got == state
    assert spark.read.parquet(f"{path}/final").count() == sum(d < today - timedelta(days=1) for _, d in state)
    assert spark.read.parquet(f"{path}/open").count() <= 14
    step(spark.createDataFrame([], schema), 12)
    assert all_windows(spark, path, "day").count() == len(state)
