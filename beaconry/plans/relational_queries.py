"""Row sources, filters, joins, aggregates, windows, scalars (groups B-J)."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import sampling as sp
from beaconry.functions.dates import bucket, ntz, sunday_zero_weekday
from beaconry.functions.safe import clamp, div0, parse_score, rate
from beaconry.operators.ordering import global_row_number, top_per_group
from beaconry.operators.sketches import error_bound, merged_counts, read_day_sketches, write_day_sketches
from beaconry.plans import models as md
from beaconry.plans.registry import query
from beaconry.session import latest, scratch_path


def md5_bucket(key: str, salt: str, n: int = 100) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || '{salt}'), 1, 8))::BIGINT % {n})"


# ---- B: row sources, series, sampling ------------------------------------------------

@query("grid_supplier_months", "B1 B4 D4 D2 C4", """
WITH b AS (SELECT date_trunc('month', min(l_shipdate))::DATE AS lo, date_trunc('month', max(l_shipdate))::DATE AS hi FROM lineitem),
 cal AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM b),
 n AS (SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT s_suppkey, cal.month, coalesce(n, 0) AS lines
FROM supplier CROSS JOIN cal LEFT JOIN n ON l_suppkey = s_suppkey AND n.month = cal.month""")
def grid_supplier_months(t):
    """Entity × calendar grid with zero-filled counts; the calendar is exploded, not joined."""
    month = bucket("month", F.col("l_shipdate"))
    span = t.lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")).first()
    months = F.sequence(bucket("month", ntz(span["lo"])), bucket("month", ntz(span["hi"])),
                        F.expr("INTERVAL 1 MONTH"))
    grid = t.supplier.select("s_suppkey", F.explode(months).alias("month"))
    counts = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey"), month.alias("month")).agg(
        F.count("*").alias("lines"))
    return grid.join(counts, ["s_suppkey", "month"], "left").fillna(0, ["lines"])


SEGMENT_WEIGHTS = {"Major": 10, "Mid": 30, "Grassroots": 60}


@query("weighted_segments", "B2", f"""
SELECT CASE WHEN b < 10 THEN 'Major' WHEN b < 40 THEN 'Mid' ELSE 'Grassroots' END AS giving_level,
       count(*) AS customers, min(c_custkey) AS first_key
FROM (SELECT c_custkey, {md5_bucket('c_custkey', 'level')} AS b FROM customer) GROUP BY 1""")
def weighted_segments(t):
    level = sp.weighted_choice(F.col("c_custkey"), "level", SEGMENT_WEIGHTS)
    return t.customer.groupBy(level.alias("giving_level")).agg(
        F.count("*").alias("customers"), F.min("c_custkey").alias("first_key"))


@query("pick_by_index", "B3 J6", """
SELECT l_linenumber, ['web_chat', 'in_app', 'mobile'][l_linenumber] AS channel, count(*) AS n
FROM lineitem GROUP BY ALL""")
def pick_by_index(t):
    names = F.array(F.lit("web_chat"), F.lit("in_app"), F.lit("mobile"))
    return t.lineitem.groupBy(
        "l_linenumber", F.get(names, F.col("l_linenumber") - 1).alias("channel")).agg(
        F.count("*").alias("n"))


RECUR_SQL = """
w AS (SELECT o_custkey, min(o_orderdate) AS started FROM orders GROUP BY 1),
b AS (SELECT max(o_orderdate) AS hi FROM orders),
r AS (SELECT o_custkey, started + INTERVAL 1 MONTH * (k * (1 + o_custkey % 6)) AS due
      FROM w CROSS JOIN b CROSS JOIN range(1000) g(k)
      WHERE started + INTERVAL 1 MONTH * (k * (1 + o_custkey % 6)) <= hi)"""


@query("recurrence_expansion", "B5 D5", f"""
WITH {RECUR_SQL} SELECT o_custkey, due::DATE AS due FROM r""")
def recurrence_expansion(t):
    """One row per cadence step from the first order to the bound."""
    started = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("started"))
    until = F.to_date(ntz(t.latest("orders", "o_orderdate")))
    step = F.make_interval(months=F.pmod("o_custkey", F.lit(6)).cast("int") + 1)
    return started.select("o_custkey", F.explode(F.sequence("started", until, step)).alias("due"))


@query("global_surrogate_key", "F1", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS gift_id FROM orders""")
def global_surrogate_key(t):
    return global_row_number(t.orders.select("o_orderdate", "o_orderkey"),
                             [F.col("o_orderdate"), F.col("o_orderkey")], "gift_id").drop("o_orderdate")


@query("sample_fixed_rows", "B6", f"""
SELECT c_custkey, c_mktsegment FROM customer ORDER BY {md5_bucket('c_custkey', 'sample', 4294967296)}, c_custkey LIMIT 500""")
def sample_fixed_rows(t):
    return sp.sample_rows(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 500, "sample")


@query("split_train_valid", "B7", f"""
SELECT CASE WHEN {md5_bucket('c_custkey', 'split')} < 80 THEN 'train' ELSE 'valid' END AS part,
       count(*) AS n, sum(c_custkey)::BIGINT AS key_sum FROM customer GROUP BY 1""")
def split_train_valid(t):
    train, valid = sp.split_train_valid(t.customer.select("c_custkey"), "c_custkey", "split")
    both = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("key_sum"))


@query("prototype_slice", "B8 N20", """
SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 25""")
def prototype_slice(t):
    return t.documents.select("doc_id", "lang", "source").orderBy("doc_id").limit(25)


# ---- C: projection, filter, predicate ------------------------------------------------

@query("project_case_clamp", "C1 C2 C3 C5 C13 I12", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'Major' WHEN o_totalprice >= 200000 THEN 'Mid' ELSE 'Grassroots' END AS level,
  CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'pending' END AS state,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent,
  round(least(greatest(o_totalprice / 500000, 0.05), 0.95), 9) AS propensity,
  (o_orderkey % 5 IN (0, 3) AND o_orderstatus = 'P') AS flagged
FROM orders WHERE o_totalprice > 1000 AND o_orderdate IS NOT NULL""")
def project_case_clamp(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.filter((price > 1000) & F.col("o_orderdate").isNotNull()).select(
        "o_orderkey",
        F.when(price >= 400000, "Major").when(price >= 200000, "Mid").otherwise("Grassroots").alias("level"),
        F.when(status == "F", "closed").when(status == "O", "open").otherwise("pending").alias("state"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("urgent"),
        F.round(clamp(price / 500000, 0.05, 0.95), 9).alias("propensity"),
        ((F.pmod("o_orderkey", F.lit(5)).isin(0, 3)) & (status == "P")).alias("flagged"))


@query("in_list_and_bounds", "C6", """
SELECT o_orderkey, o_orderdate::DATE AS day FROM orders
WHERE o_orderdate IN ((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders))
  AND o_orderstatus IN ('F', 'O')""")
def in_list_and_bounds(t):
    lo = t.orders.agg(F.min("o_orderdate")).scalar()
    hi = t.orders.agg(F.max("o_orderdate")).scalar()
    day = F.col("o_orderdate")
    return (t.orders.filter(F.col("o_orderstatus").isin("F", "O") & ((day == lo) | (day == hi)))
            .select("o_orderkey", F.to_date(day).alias("day")))


@query("like_and_ilike", "C7", """
SELECT CASE WHEN p_name ILIKE '%WIDGET%' THEN 'widget' WHEN p_name ILIKE '%Bolt%' THEN 'bolt'
            WHEN p_name LIKE 'red%' THEN 'red' ELSE 'other' END AS kind, count(*) AS parts
FROM part GROUP BY 1""")
def like_and_ilike(t):
    name = F.col("p_name")
    kind = (F.when(name.ilike("%WIDGET%"), "widget").when(name.ilike("%Bolt%"), "bolt")
            .when(name.like("red%"), "red").otherwise("other"))
    return t.part.groupBy(kind.alias("kind")).agg(F.count("*").alias("parts"))


def optional_filter(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Filter only when a value is given; None and '' keep every row."""
    return df if value in (None, "") else df.filter(F.col(column) == value)


@query("scalar_counts_row", "C9", """
SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS threads,
       (SELECT count(*) FROM conversations) AS messages, (SELECT count(*) FROM events) AS events""")
def scalar_counts_row(t):
    conv = t.conversations.agg(F.count_distinct("conv_id").alias("threads"), F.count("*").alias("messages"))
    return conv.withColumn("events", t.events.agg(F.count("*")).scalar())


@query("exists_condition", "C10", """
SELECT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND value > 400) AS alert,
       EXISTS (SELECT 1 FROM events WHERE value > 1000000) AS over_limit""")
def exists_condition(t):
    """One boolean row per condition; Spark stops at the first hit of each task."""
    def exists(df: DataFrame) -> Column:
        return df.limit(1).agg(F.count("*") > 0).scalar()

    events = t.events
    return t.region.limit(1).select(
        exists(events.filter("event_type = 'error' AND value > 400")).alias("alert"),
        exists(events.filter("value > 1000000")).alias("over_limit"))


@query("casts_and_try_casts", "C11 I4 N25", """
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS INT) AS brand_no,
  TRY_CAST(p_type AS DOUBLE) AS type_number, p_size::VARCHAR AS size_text, floor(p_retailprice)::BIGINT AS price_whole,
  ('2024-01-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0'))::DATE AS day,
  CASE WHEN s > 1 THEN s / 100 ELSE s END AS score
FROM (SELECT *, coalesce(TRY_CAST(nullif(regexp_extract('score ' || (p_size / 10.0)::VARCHAR, '([0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE), 0.5) AS s FROM part)""")
def casts_and_try_casts(t):
    raw = F.concat(F.lit("score "), (F.col("p_size") / 10.0).cast("string"))
    day = F.concat(F.lit("2024-01-"), F.lpad((F.pmod("p_partkey", F.lit(28)) + 1).cast("string"), 2, "0"))
    return t.part.select(
        "p_partkey", F.regexp_extract("p_brand", "([0-9]+)", 1).try_cast("int").alias("brand_no"),
        F.col("p_type").try_cast("double").alias("type_number"),
        F.col("p_size").cast("string").alias("size_text"),
        F.floor("p_retailprice").alias("price_whole"),
        F.to_date(day).alias("day"), parse_score(raw).alias("score"))


@query("columns_by_pattern", "C12", "SELECT o_orderdate::DATE AS o_orderdate, o_orderpriority, o_orderstatus, o_orderkey FROM orders")
def columns_by_pattern(t):
    chosen = [c for c in t.orders.columns if c.startswith("o_order")]
    return t.orders.select(*chosen).withColumn("o_orderdate", F.to_date("o_orderdate"))


# ---- D: joins ------------------------------------------------------------------------

@query("join_inner_dimensions", "D1 E1", """
SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def join_inner_dimensions(t):
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    return (per_customer.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
            .join(md.geography(t), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name", "n_name")
            .agg(F.sum("n").alias("orders"), F.round(F.sum("s"), 2).alias("total")))


@query("join_left_missing_count", "D2 E14", """
SELECT c_mktsegment, count(*) AS customers, count(*) - count(n) AS without_events, sum(coalesce(n, 0))::BIGINT AS events
FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey GROUP BY 1""")
def join_left_missing_count(t):
    per_user = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(per_user, "c_custkey", "left").groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), (F.count("*") - F.count("n")).alias("without_events"),
        F.sum(F.coalesce("n", F.lit(0))).alias("events"))


@query("flatten_with_index", "D9", """
SELECT idx, count(*) AS n, count(DISTINCT part) AS parts
FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS part, generate_subscripts(string_split(o_orderpriority, '-'), 1) - 1 AS idx FROM orders)
GROUP BY 1""")
def flatten_with_index(t):
    return (t.orders.select(F.posexplode(F.split("o_orderpriority", "-")).alias("idx", "part"))
            .groupBy(F.col("idx").cast("long").alias("idx"))
            .agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts")))


@query("latest_vs_previous", "D10 F4", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT l.o_custkey, l.o_totalprice AS latest, p.o_totalprice AS previous, round(l.o_totalprice - p.o_totalprice, 2) AS delta
FROM r l JOIN r p ON p.o_custkey = l.o_custkey AND p.rn = 2 WHERE l.rn = 1""")
def latest_vs_previous(t):
    """Newest two rows per key, cut to two per task before the shuffle."""
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    two = top_per_group(t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"),
                        ["o_custkey"], order, 2)
    place = F.struct("o_orderdate", "o_orderkey")
    return (two.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.max_by("o_totalprice", place).alias("latest"),
        F.min_by("o_totalprice", place).alias("previous"))
        .filter("n = 2").select("o_custkey", "latest", "previous",
                                F.round(F.col("latest") - F.col("previous"), 2).alias("delta")))


@query("semi_join_scored", "D12 C6", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200)""")
def semi_join_scored(t):
    hits = t.events.filter("event_type = 'purchase' AND value > 200").select("user_id").distinct()
    return t.customer.join(hits, F.col("c_custkey") == F.col("user_id"), "left_semi").select(
        "c_custkey", "c_name")


@query("join_fan_out_counts", "D13", """
SELECT o_orderstatus, count(*) AS joined_rows, count(DISTINCT o_orderkey) AS orders
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def join_fan_out_counts(t):
    """An order with k lines counts k times, one without lines once: rows are summed
    per order before the join, so no order's lines meet in one task."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("k"))
    return (t.orders.select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey", "left")
            .groupBy("o_orderstatus")
            .agg(F.sum(F.coalesce("k", F.lit(1))).alias("joined_rows"),
                 F.count("*").alias("orders")))


# ---- E: aggregation ------------------------------------------------------------------

@query("aggregate_pricing_summary", "E1 E2 E11", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
  avg(l_quantity) AS avg_qty, min(l_discount) AS min_disc, max(l_tax) AS max_tax, count(*) AS n,
  count(*) FILTER (WHERE l_discount > 0.05) AS discounted
FROM lineitem WHERE l_shipdate <= DATE '2001-09-02' GROUP BY ALL""")
def aggregate_pricing_summary(t):
    return t.lineitem.filter(F.col("l_shipdate") <= ntz(datetime(2001, 9, 2))).groupBy(
        "l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.avg("l_quantity").alias("avg_qty"), F.min("l_discount").alias("min_disc"),
        F.max("l_tax").alias("max_tax"), F.count("*").alias("n"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"))


@query("aggregate_distinct", "E3", """
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT ts::DATE) AS days FROM events GROUP BY 1""")
def aggregate_distinct(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days"))


@query("aggregate_distinct_approx", "E3")
def aggregate_distinct_approx(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey").alias("orders"))


@query("distinct_users_by_week", "E3 O1 E12", """
WITH w AS (SELECT event_type, date_trunc('week', ts)::DATE AS week, count(DISTINCT user_id) AS users, count(*) AS n_rows FROM events GROUP BY ALL)
SELECT event_type, week, users, n_rows::BIGINT AS n_rows, true AS within_bound FROM w""")
def distinct_users_by_week(t):
    """Weeks merged from daily sketches, each held against the exact count and the stated bound."""
    path = scratch_path(t.spark, "day-sketches")
    write_day_sketches(t.events, path, "ts", ["event_type"], "user_id")
    by = ["event_type", F.date_trunc("week", "day").cast("date").alias("week")]
    merged = merged_counts(read_day_sketches(t.spark, path), by)
    exact = t.events.groupBy("event_type", F.date_trunc("week", "ts").cast("date").alias("week")).agg(
        F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("distinct_estimate") - F.col("users"))
    held = off <= F.greatest(F.lit(1.0), F.col("users") * error_bound(12))
    return exact.join(merged, ["event_type", "week"]).select(
        "event_type", "week", "users", "n_rows", held.alias("within_bound"))


@query("having_group_and_global", "E4", """
SELECT o_custkey::VARCHAR AS who, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 18
UNION ALL SELECT 'all', count(*) FROM orders HAVING sum(o_totalprice) > 1000""")
def having_group_and_global(t):
    per = t.orders.groupBy(F.col("o_custkey").cast("string").alias("who")).agg(
        F.count("*").alias("n")).filter("n > 18")
    whole = t.orders.agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s")).filter("s > 1000")
    return per.unionByName(whole.select(F.lit("all").alias("who"), "n"))


def ordered_objects(df: DataFrame, keys: list[str], order: list[Column], fields: list[str],
                    name: str, n: int) -> DataFrame:
    """Top ``n`` rows per group as one JSON array in the given order."""
    ranked = (df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
              .filter(F.col("_rn") <= n))
    items = F.array_sort(F.collect_list(F.struct("_rn", F.struct(*fields).alias("v"))))
    return ranked.groupBy(*keys).agg(F.to_json(F.transform(items, lambda x: x["v"])).alias(name))


@query("ordered_object_array", "E5 J7 G3", """
WITH r AS (SELECT o.*, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rn
           FROM orders o JOIN customer ON c_custkey = o_custkey)
SELECT c_mktsegment, to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY rn))::VARCHAR AS top_orders
FROM r WHERE rn <= 5 GROUP BY 1""")
def ordered_object_array(t):
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return ordered_objects(rows, ["c_mktsegment"], [F.desc("o_totalprice"), F.col("o_orderkey")],
                           ["o_orderkey", "o_orderstatus"], "top_orders", 5)


@query("distinct_joined_string", "E7 E8 J6", """
SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS functions, min(event_id) AS any_event,
       bool_or(value > 100) AS large_seen FROM events GROUP BY 1""")
def distinct_joined_string(t):
    return t.events.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("functions"),
        F.min("event_id").alias("any_event"), F.bool_or(F.col("value") > 100).alias("large_seen"))


@query("safe_ratios", "E9 C4 I12", """
SELECT user_id, CASE WHEN p = 0 THEN 0 ELSE round(c / p, 6) END AS ctr0, round(c / nullif(p, 0), 6) AS ctr_null
FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS c,
             count(*) FILTER (WHERE event_type = 'purchase' AND value > 60) AS p FROM events GROUP BY 1)""")
def safe_ratios(t):
    agg = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("c"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 60)).alias("p"))
    c, p = F.col("c"), F.col("p")
    return agg.select("user_id", F.round(div0(c, p), 6).alias("ctr0"), F.round(rate(c, p), 6).alias("ctr_null"))


@query("aggregate_global", "E10", """
SELECT count(*) AS n, sum(n_chars)::BIGINT AS total_chars, max(n_chars) AS max_chars, round(avg(n_chars), 4) AS avg_chars FROM documents""")
def aggregate_global(t):
    return t.documents.agg(F.count("*").alias("n"), F.sum("n_chars").alias("total_chars"),
                           F.max("n_chars").alias("max_chars"), F.round(F.avg("n_chars"), 4).alias("avg_chars"))


@query("weekly_volume_rollup", "E12 I8", """
SELECT date_trunc('week', o_orderdate)::DATE AS week_ts, round(sum(o_totalprice), 2) AS total_amount FROM orders GROUP BY 1""")
def weekly_volume_rollup(t):
    return t.orders.groupBy(bucket("week", F.col("o_orderdate")).alias("week_ts")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_amount"))


@query("pivot_conditional_average", "E13", """
SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS "F",
  round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS "O",
  round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS "P" FROM orders GROUP BY 1""")
def pivot_conditional_average(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(
        F.round(F.avg("o_totalprice"), 2))


@query("two_dimension_mix", "E16 G1", """
SELECT event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS band, count(*) AS n FROM events GROUP BY ALL ORDER BY event_type, n DESC""")
def two_dimension_mix(t):
    band = F.when(F.col("value") > 50, "high").otherwise("low")
    return t.events.groupBy("event_type", band.alias("band")).agg(F.count("*").alias("n")).orderBy(
        "event_type", F.desc("n"))


# ---- F, G, H -------------------------------------------------------------------------

@query("one_random_row_per_group", "F3", f"""
SELECT c_mktsegment, c_custkey FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY {md5_bucket('c_custkey', 'pick', 4294967296)}, c_custkey) = 1""")
def one_random_row_per_group(t):
    h = sp.stable_hash(F.col("c_custkey"), "pick")
    return t.customer.groupBy("c_mktsegment").agg(F.min_by("c_custkey", F.struct(h, "c_custkey")).alias("c_custkey"))


@query("top_n_per_group", "F2", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3""")
def top_n_per_group(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return top_per_group(rows, ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"),
                                               F.col("l_linenumber")], 3)


@query("top_k_by_score", "G2 G1", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k_by_score(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


TOUR = ("customer", "orders", "lineitem", "events", "documents", "conversations", "supplier")


@query("row_count_tour", "H1", " UNION ALL ".join(f"SELECT '{n}' AS object, count(*) AS row_count FROM {n}" for n in TOUR))
def row_count_tour(t):
    counts = [getattr(t, n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("object"), "row_count")
              for n in TOUR]
    return reduce(DataFrame.unionByName, counts)


# ---- I: scalar functions -------------------------------------------------------------

@query("scalar_strings", "I1 I2 I3 I4 I5", """
SELECT p_partkey, p_brand || ' ' || p_type AS brand_type, upper(trim('  ' || p_name || ' ')) AS loud,
  lpad(p_size::VARCHAR, 4, '0') AS size4, left(p_type, 2) AS type2, replace(p_name, ' ', '_') AS slug,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
  split_part(p_name, ' ', 1) AS first_word, nullif(regexp_extract(p_brand, '#(\\d+)', 1), '') AS brand_no,
  nullif(regexp_extract(p_name, '(zzz)', 1), '') AS no_match,
  regexp_replace(p_brand, '[A-Za-z]', '', 'g') AS no_letters, 'a' || chr(10) || p_name AS two_lines FROM part""")
def scalar_strings(t):
    name, brand = F.col("p_name"), F.col("p_brand")

    def substring_match(column: Column, pattern: str) -> Column:
        """First group of the match, NULL when nothing matches."""
        return F.nullif(F.regexp_extract(column, pattern, 1), F.lit(""))

    return t.part.select(
        "p_partkey", F.concat(brand, F.lit(" "), F.col("p_type")).alias("brand_type"),
        F.upper(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("loud"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size4"),
        F.left("p_type", F.lit(2)).alias("type2"), F.replace(name, F.lit(" "), F.lit("_")).alias("slug"),
        F.initcap(name).alias("title"), F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        substring_match(brand, r"#(\d+)").alias("brand_no"), substring_match(name, "(zzz)").alias("no_match"),
        F.regexp_replace(brand, "[A-Za-z]", "").alias("no_letters"),
        F.concat(F.lit("a"), F.char(F.lit(10)), name).alias("two_lines"))


@query("scalar_dates", "I6 I7 I8 I9 I10", """
SELECT o_orderkey, (o_orderdate + INTERVAL 45 DAY)::DATE AS plus_days, (o_orderdate - INTERVAL 1 MONTH)::DATE AS month_before,
  o_orderdate + INTERVAL 90 MINUTE AS plus_minutes, o_orderdate + INTERVAL 20 SECOND AS plus_seconds, date_diff('day', o_orderdate::DATE, DATE '2001-08-01') AS days_to,
  date_trunc('week', o_orderdate)::DATE AS week, date_trunc('month', o_orderdate)::DATE AS month,
  dayofweek(o_orderdate)::INT AS dow, strftime(o_orderdate, '%Y%m%d-%H%M%S') AS stamp FROM orders""")
def scalar_dates(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.to_date(day + F.expr("INTERVAL 45 DAYS")).alias("plus_days"),
        F.to_date(day - F.expr("INTERVAL 1 MONTH")).alias("month_before"),
        (day + F.expr("INTERVAL 90 MINUTES")).alias("plus_minutes"),
        (day + F.expr("INTERVAL 20 SECONDS")).alias("plus_seconds"),
        F.datediff(F.lit("2001-08-01").cast("date"), day).cast("long").alias("days_to"),
        bucket("week", day).alias("week"), bucket("month", day).alias("month"),
        sunday_zero_weekday(day).alias("dow"), F.date_format(day, "yyyyMMdd-HHmmss").alias("stamp"))


@query("scalar_numbers", "I12", """
SELECT event_id, round(value, 1) AS one_digit, abs(value - 50) AS distance, event_id % 7 AS bucket,
       round(value * 2 + 1 - value / 4, 4) AS mixed FROM events""")
def scalar_numbers(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(v, 1).alias("one_digit"), F.abs(v - 50).alias("distance"),
                           F.pmod("event_id", F.lit(7)).alias("bucket"), F.round(v * 2 + 1 - v / 4, 4).alias("mixed"))


@query("as_of_window", "I11 E2", """
SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1""")
def as_of_window(t):
    """'Now' is the newest time in the data, never the wall clock."""
    since = t.latest("events", "ts") - timedelta(days=7)
    return t.events.filter(F.col("ts") >= ntz(since)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("template_substitution", "I13", """
SELECT c_custkey, 'Customer ' || c_name || ' of segment ' || c_mktsegment || ' needs a call' AS prompt FROM customer""")
def template_substitution(t):
    return t.customer.select("c_custkey", F.format_string(
        "Customer %s of segment %s needs a call", "c_name", "c_mktsegment").alias("prompt"))


# ---- J: semi-structured --------------------------------------------------------------

@query("json_paths", "J1 J2 J3 J4", """
SELECT event_id, (props->>'$.k')::BIGINT AS k, NULL::VARCHAR AS missing, (props->>'$.k')::BIGINT % 3 AS first_tag FROM events""")
def json_paths(t):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    nested = F.parse_json(F.to_json(F.struct(F.array(F.struct(F.pmod(k, F.lit(3)).alias("tag"))).alias("a.b"))))
    return t.events.select(
        "event_id", k.alias("k"), F.try_variant_get(F.try_parse_json("props"), "$.nope", "string").alias("missing"),
        F.variant_get(nested, "$['a.b'][0].tag", "bigint").alias("first_tag"))


@query("json_build_object", "J5 J7", """
SELECT event_id, CASE WHEN value > 50 THEN json_object('event_type', event_type, 'user_id', user_id)::VARCHAR
       ELSE json_object('user_id', user_id)::VARCHAR END AS doc FROM events""")
def json_build_object(t):
    """NULL fields are left out of the object."""
    kind = F.when(F.col("value") > 50, F.col("event_type"))
    return t.events.select("event_id", F.to_json(F.struct(kind.alias("event_type"), "user_id")).alias("doc"))


@query("json_metrics_array", "J10 D9 J6", """
SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS total_tokens, count(*) AS n FROM events GROUP BY 1""")
def json_metrics_array(t):
    """Flatten an array of {unit, value} pairs and sum one unit."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    pairs = F.array(F.struct(F.lit("tokens").alias("unit"), k.alias("amount")),
                    F.struct(F.lit("pages").alias("unit"), F.lit(1).cast("long").alias("amount")))
    return (t.events.select("event_type", F.inline(pairs)).filter("unit = 'tokens'")
            .groupBy("event_type").agg(F.sum("amount").alias("total_tokens"), F.count("*").alias("n")))
