"""Point-in-time features, labels and as-of joins (groups L, D6-D8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import add_months, month_starts, ntz
from beaconry.operators import features as ft
from beaconry.operators.asof import asof_join, latest_features
from beaconry.plans import models as md
from beaconry.plans.metric_queries import LABEL_SQL
from beaconry.plans.registry import query
from beaconry.session import Tables, rounded

CALENDAR_SQL = """
top AS (SELECT max(o_orderdate) AS m FROM orders),
cal AS (SELECT date_trunc('month', m)::TIMESTAMP - i * INTERVAL 1 MONTH AS as_of_ts
        FROM top, range(18) r(i)),
started AS (SELECT o_custkey, min(o_orderdate) AS started FROM orders GROUP BY 1),
grid AS (SELECT o_custkey, started, as_of_ts FROM started, cal WHERE started <= as_of_ts)"""
RFM_SQL = CALENDAR_SQL + """,
rfm AS (SELECT g.o_custkey AS c_custkey, as_of_ts,
  date_diff('day', started::DATE, as_of_ts::DATE) AS tenure_days,
  count(o_orderkey) AS frequency_lifetime,
  count(CASE WHEN o_orderdate >= as_of_ts - INTERVAL 12 MONTH THEN 1 END) AS frequency_last_12m,
  coalesce(sum(o_totalprice), 0) AS monetary_total, coalesce(avg(o_totalprice), 0) AS avg_gift_amount,
  coalesce(date_diff('day', max(o_orderdate)::DATE, as_of_ts::DATE), 1500) AS recency_days
  FROM grid g LEFT JOIN orders o ON o.o_custkey = g.o_custkey AND o_orderdate <= as_of_ts
  GROUP BY g.o_custkey, as_of_ts, started)"""
ENG_SQL = """
eng AS (SELECT g.o_custkey AS c_custkey, as_of_ts, count(l_orderkey) AS engagement_count,
  count(CASE WHEN l_shipdate >= as_of_ts - INTERVAL 6 MONTH THEN 1 END) AS engagement_last_6m
  FROM grid g LEFT JOIN (SELECT o_custkey AS ck, l_shipdate, l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) x
    ON ck = g.o_custkey AND l_shipdate <= as_of_ts GROUP BY g.o_custkey, as_of_ts)"""


def calendar(t: Tables):
    return month_starts(t.latest("orders", "o_orderdate"), 18)


def rfm(t: Tables, cal) -> DataFrame:
    return ft.rfm_view(md.customers_started(t), t.orders, "c_custkey", "started", "o_custkey",
                       "o_orderdate", "o_totalprice", cal)


def engagement(t: Tables, cal) -> DataFrame:
    lines = ft.snapshot_deltas(t.lineitem, "l_orderkey", "l_shipdate", cal, 6)
    moved = ft.through_link(lines, t.orders, "o_orderkey", "o_custkey")
    return ft.engagement_view(md.customers_started(t), moved, "c_custkey", "started", cal)


def engagement_at(t: Tables, as_of) -> DataFrame:
    """Engagement per customer at one as-of, pre-summed per order before the join."""
    since = ntz(add_months(as_of, -6))
    lines = (t.lineitem.filter(F.col("l_shipdate") <= ntz(as_of)).groupBy("l_orderkey")
             .agg(F.count("*").alias("n"), F.count_if(F.col("l_shipdate") >= since).alias("n6")))
    return (lines.join(t.orders.select("o_orderkey", "o_custkey"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.sum("n").alias("engagement_count"), F.sum("n6").alias("engagement_last_6m")))


def training(t: Tables, as_of=None) -> DataFrame:
    """Donor-style training base over customers at ``as_of``."""
    as_of = as_of or md.churn_as_of(t)
    who = md.customers_started(t).join(
        md.geography(t), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("donor_segment"),
        F.col("c_acctbal").alias("wealth_signal_score"), "started")
    return ft.training_base(who, t.orders, engagement_at(t, as_of), "c_custkey", "started",
                            "o_custkey", "o_orderdate", "o_totalprice", as_of)


ROUND_RFM = {"monetary_total": 2, "avg_gift_amount": 6}


@query("feature_rfm_snapshots", "L2 B4 D4 D6 E2 I6 I7", f"""
WITH {RFM_SQL} SELECT c_custkey, as_of_ts, tenure_days, frequency_lifetime, frequency_last_12m,
  round(monetary_total, 2) AS monetary_total, round(avg_gift_amount, 6) AS avg_gift_amount, recency_days FROM rfm""")
def rfm_snapshots(t):
    return rounded(rfm(t, calendar(t)), ROUND_RFM)


@query("feature_engagement_snapshots", "L3 D6", f"""
WITH {CALENDAR_SQL}, {ENG_SQL} SELECT * FROM eng""")
def engagement_snapshots(t):
    return engagement(t, calendar(t))


@query("feature_static_view", "L4 C1", """
SELECT c_custkey, c_acctbal AS wealth_signal_score FROM customer""")
def static_view(t):
    return t.customer.select("c_custkey", F.col("c_acctbal").alias("wealth_signal_score"))


@query("feature_forward_label", "L5 D7 C3 I6", f"""
WITH {LABEL_SQL} SELECT c_custkey, (SELECT a FROM cut)::TIMESTAMP AS as_of_ts, is_lapsed FROM lab""")
def forward_label(t):
    return md.lapse_labels(t)


BASE_SQL = f"""{LABEL_SQL},
geo AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
gift AS (SELECT o_custkey, count(*) AS fl, count(CASE WHEN o_orderdate >= a - INTERVAL 12 MONTH THEN 1 END) AS f12,
         sum(o_totalprice) AS mt, avg(o_totalprice) AS av, max(o_orderdate) AS last
         FROM orders CROSS JOIN cut WHERE o_orderdate <= a GROUP BY 1),
eng AS (SELECT o_custkey, count(*) AS ec, count(CASE WHEN l_shipdate >= a - INTERVAL 6 MONTH THEN 1 END) AS e6
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey CROSS JOIN cut WHERE l_shipdate <= a GROUP BY 1),
base AS (SELECT c.c_custkey, r_name AS region, c_mktsegment AS donor_segment, c_acctbal AS wealth_signal_score,
  date_diff('day', started::DATE, a::DATE) AS tenure_days, coalesce(fl, 0) AS frequency_lifetime,
  coalesce(f12, 0) AS frequency_last_12m, coalesce(mt, 0) AS monetary_total, coalesce(av, 0) AS avg_gift_amount,
  coalesce(date_diff('day', last::DATE, a::DATE), 1500) AS recency_days, coalesce(ec, 0) AS engagement_count,
  coalesce(e6, 0) AS engagement_last_6m, is_lapsed
  FROM lab JOIN customer c ON c.c_custkey = lab.c_custkey JOIN started s ON s.o_custkey = c.c_custkey CROSS JOIN cut
  LEFT JOIN geo ON n_nationkey = c_nationkey LEFT JOIN gift g ON g.o_custkey = c.c_custkey
  LEFT JOIN eng e ON e.o_custkey = c.c_custkey)"""


@query("feature_training_base", "L6 C4 C9 D2 E2", f"""
WITH {BASE_SQL} SELECT c_custkey, region, donor_segment, wealth_signal_score, tenure_days, frequency_lifetime,
 frequency_last_12m, round(monetary_total, 2) AS monetary_total, round(avg_gift_amount, 6) AS avg_gift_amount,
 recency_days, engagement_count, engagement_last_6m, is_lapsed FROM base""")
def training_base(t):
    return rounded(training(t).drop("started"), ROUND_RFM)


@query("feature_label_profile", "L11 E1 I12", f"""
WITH {BASE_SQL} SELECT is_lapsed, count(*) AS donors, round(avg(recency_days), 2) AS avg_recency_days,
  round(avg(frequency_last_12m), 2) AS avg_gifts_12m, round(avg(engagement_last_6m), 2) AS avg_engagement_6m,
  round(avg(monetary_total), 1) AS avg_lifetime_giving FROM base GROUP BY 1""")
def label_profile(t):
    return training(t).groupBy("is_lapsed").agg(
        F.count("*").alias("donors"), F.round(F.avg("recency_days"), 2).alias("avg_recency_days"),
        F.round(F.avg("frequency_last_12m"), 2).alias("avg_gifts_12m"),
        F.round(F.avg("engagement_last_6m"), 2).alias("avg_engagement_6m"),
        F.round(F.avg("monetary_total"), 1).alias("avg_lifetime_giving"))


@query("feature_point_in_time_proof", "L10 C6", f"""
WITH {RFM_SQL} SELECT as_of_ts, count(*) AS donors, round(avg(frequency_last_12m), 2) AS avg_gifts_12m,
  round(avg(recency_days), 2) AS avg_recency_days, round(avg(monetary_total), 1) AS avg_lifetime_giving
FROM rfm WHERE as_of_ts IN ((SELECT min(as_of_ts) FROM cal), (SELECT max(as_of_ts) FROM cal)) GROUP BY 1""")
def point_in_time_proof(t):
    cal = calendar(t)
    return rfm(t, [cal[0], cal[-1]]).groupBy("as_of_ts").agg(
        F.count("*").alias("donors"), F.round(F.avg("frequency_last_12m"), 2).alias("avg_gifts_12m"),
        F.round(F.avg("recency_days"), 2).alias("avg_recency_days"),
        F.round(F.avg("monetary_total"), 1).alias("avg_lifetime_giving"))


@query("feature_training_set", "L7 D3 D8", f"""
WITH {RFM_SQL}, {ENG_SQL},
 ts AS (SELECT max(o_orderdate) - INTERVAL 12 MONTH AS a FROM orders),
 spine AS (SELECT s.o_custkey AS c_custkey, a AS as_of_ts, CASE WHEN count(o.o_orderkey) = 0 THEN 1 ELSE 0 END AS is_lapsed
   FROM started s CROSS JOIN ts LEFT JOIN orders o ON o.o_custkey = s.o_custkey AND o.o_orderdate > a
   AND o.o_orderdate <= a + INTERVAL 12 MONTH WHERE s.started <= a GROUP BY ALL)
SELECT s.c_custkey, is_lapsed, tenure_days, frequency_lifetime, frequency_last_12m,
  round(monetary_total, 2) AS monetary_total, recency_days, engagement_count, engagement_last_6m, c_acctbal AS wealth_signal_score
FROM spine s ASOF LEFT JOIN rfm r ON r.c_custkey = s.c_custkey AND s.as_of_ts >= r.as_of_ts
ASOF LEFT JOIN eng e ON e.c_custkey = s.c_custkey AND s.as_of_ts >= e.as_of_ts
LEFT JOIN customer c ON c.c_custkey = s.c_custkey""")
def training_set(t):
    """The views lie on a calendar, so the newest snapshot at or before a spine time is
    known without looking: plain equality on (entity, snapshot)."""
    cal = [c for c in calendar(t) if c <= md.churn_as_of(t)][-1:]
    at = F.array_max(F.filter(F.array(*[ntz(c) for c in cal]), lambda c: c <= F.col("as_of_ts")))
    spine = md.lapse_labels(t).withColumn("as_of_ts", at)
    seen = rfm(t, cal).select("c_custkey", "as_of_ts", "tenure_days", "frequency_lifetime", "frequency_last_12m",
                              "monetary_total", "recency_days")
    out = (spine.join(seen, ["c_custkey", "as_of_ts"], "left")
           .join(engagement(t, cal), ["c_custkey", "as_of_ts"], "left")
           .join(static_view(t), "c_custkey", "left").drop("as_of_ts"))
    return rounded(out, {"monetary_total": 2})


@query("asof_last_order_per_shipment", "D8", """
WITH f AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS p FROM orders GROUP BY ALL),
 s AS (SELECT l_suppkey, l_linenumber, l_shipdate, l_quantity, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT s.o_custkey AS custkey, l_shipdate, l_suppkey, l_linenumber, l_quantity, p AS last_order_price
FROM s ASOF LEFT JOIN f ON f.o_custkey = s.o_custkey AND s.l_shipdate >= f.o_orderdate""")
def last_order_per_shipment(t):
    shipments = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"),
                                F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("custkey"), "l_shipdate", "l_suppkey", "l_linenumber", "l_quantity")
    prices = t.orders.groupBy(F.col("o_custkey").alias("custkey"), "o_orderdate").agg(
        F.max("o_totalprice").alias("last_order_price"))
    return asof_join(shipments, prices, ["custkey"], "l_shipdate", "o_orderdate", ["last_order_price"])


@query("feature_latest_for_serving", "L9", f"""
WITH {RFM_SQL} SELECT c_custkey, as_of_ts, frequency_lifetime, recency_days FROM rfm
WHERE as_of_ts = (SELECT max(as_of_ts) FROM cal)""")
def latest_for_serving(t):
    cal = calendar(t)
    return latest_features(rfm(t, cal[-1:]), ["c_custkey"], "as_of_ts", cal[-1],
                           ["as_of_ts", "frequency_lifetime", "recency_days"])


@query("feature_latest_one_entity", "L9", f"""
WITH {RFM_SQL} SELECT c_custkey, frequency_lifetime, recency_days FROM rfm
WHERE as_of_ts = (SELECT max(as_of_ts) FROM cal) AND c_custkey = 42""")
def latest_one_entity(t):
    cal = calendar(t)
    return latest_features(rfm(t, cal[-1:]).filter("c_custkey = 42"), ["c_custkey"], "as_of_ts", cal[-1],
                           ["frequency_lifetime", "recency_days"])
