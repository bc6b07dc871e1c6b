"""Metric layer queries (inventory group K)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from beaconry.operators.metrics import Dimension, Model, Table, catalog, check_enums, check_keys
from beaconry.operators.metrics import query as ask
from beaconry.plans import models as md
from beaconry.plans.registry import query
from beaconry.session import rounded

SUBSCRIBERS = ("subscribers_to_brands",)
# Lapse label in SQL: no order in the 12 months after as-of = newest order - 12 months.
LABEL_SQL = """
cut AS (SELECT max(o_orderdate) - INTERVAL 12 MONTH AS a FROM orders),
started AS (SELECT o_custkey, min(o_orderdate) AS started FROM orders GROUP BY 1),
lab AS (SELECT s.o_custkey AS c_custkey,
          CASE WHEN count(o.o_orderkey) = 0 THEN 1 ELSE 0 END AS is_lapsed
        FROM started s CROSS JOIN cut
        LEFT JOIN orders o ON o.o_custkey = s.o_custkey AND o.o_orderdate > a
             AND o.o_orderdate <= a + INTERVAL 12 MONTH
        WHERE s.started <= a GROUP BY 1)"""
GEO_SQL = """
geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""
CONSENT_SQL = md.CONSENT
THUMBS_SQL = """
fb AS (SELECT conv_id, ('0x' || substr(md5(conv_id::VARCHAR || 'rating'), 1, 8))::BIGINT % 100 AS b
       FROM (SELECT DISTINCT conv_id FROM conversations)),
ratings AS (SELECT conv_id, CASE WHEN b < 40 THEN 1 ELSE -1 END AS rating FROM fb WHERE b < 70)"""


@query("metric_ltv_by_segment", "K2 K3 K4 K5 K6 K7 D1 E1 E9", """
WITH o AS (SELECT c_mktsegment AS segment, sum(o_totalprice) AS rev
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
     e AS (SELECT c_mktsegment AS segment, count(*) AS sends
           FROM events JOIN customer ON c_custkey = user_id GROUP BY 1),
     c AS (SELECT c_mktsegment AS segment, count(*) AS subs FROM customer GROUP BY 1)
SELECT segment, round(rev, 2) AS attributed_revenue, coalesce(sends, 0) AS send_count,
       subs AS subscriber_count,
       round(CASE WHEN coalesce(sends, 0) = 0 THEN 0 ELSE rev / sends END, 4) AS revenue_per_send,
       round(CASE WHEN subs = 0 THEN 0 ELSE rev / subs END, 4) AS subscriber_ltv
FROM c LEFT JOIN o USING (segment) LEFT JOIN e USING (segment)""")
def ltv_by_segment(t):
    out = ask(md.sms_model(t), ["credited turnover", "send_count", "subscriber_count",
                                "revenue_per_send", "turnover per recipient"], ["segment"])
    return rounded(out, {"attributed_revenue": 2, "revenue_per_send": 4, "subscriber_ltv": 4})


@query("metric_sms_all_by_region", "K3 K4 K5 K6 K8", f"""
WITH {GEO_SQL},
 c AS (SELECT r_name AS brand_region, count(*) AS subs,
         sum(CASE WHEN {CONSENT_SQL} = 'opted_out' THEN 1 ELSE 0 END) AS outs,
         sum(CASE WHEN {CONSENT_SQL} = 'opted_in' THEN 1 ELSE 0 END) AS ins
       FROM customer JOIN geo ON n_nationkey = c_nationkey GROUP BY 1),
 o AS (SELECT r_name AS brand_region, sum(o_totalprice) AS rev, count(*) AS n
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN geo ON n_nationkey = c_nationkey GROUP BY 1),
 e AS (SELECT r_name AS brand_region, count(*) AS sends,
         sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS delivered,
         sum(CASE WHEN event_type IN ('click','purchase') THEN 1 ELSE 0 END) AS clicks,
         sum(value) AS cost
       FROM events JOIN customer ON c_custkey = user_id JOIN geo ON n_nationkey = c_nationkey GROUP BY 1)
SELECT brand_region, round(rev, 2) AS attributed_revenue, n AS order_count, sends AS send_count,
  delivered::BIGINT AS delivered_count, clicks::BIGINT AS click_count, round(cost, 2) AS total_send_cost,
  subs AS subscriber_count, subs AS opt_in_growth, outs::BIGINT AS opted_out_count,
  ins::BIGINT AS consented_count, round(rev / sends, 4) AS revenue_per_send,
  round(clicks / delivered, 6) AS ctr, round(rev / subs, 4) AS subscriber_ltv,
  round(outs / subs, 6) AS list_churn_rate, round(ins / subs, 6) AS consent_rate
FROM c JOIN o USING (brand_region) JOIN e USING (brand_region)""")
def sms_all_by_region(t):
    model = md.sms_model(t)
    names = [m.name for m in model.metrics] + [r.name for r in model.ratios]
    return rounded(ask(model, names, ["brand_region"], via=SUBSCRIBERS), {
        "attributed_revenue": 2, "total_send_cost": 2, "revenue_per_send": 4, "ctr": 6,
        "subscriber_ltv": 4, "list_churn_rate": 6, "consent_rate": 6})


CAMPAIGN_SQL = """
camp(campaign_id, campaign_type, theme, brand_id) AS (VALUES
  (1, 'broadcast', 'First Look', 1), (2, 'broadcast', 'Clearance', 2),
  (3, 'broadcast', 'Restock', 3), (4, 'flow', 'Greeting', 4), (5, 'flow', 'Forgotten Basket', 5)),
ord AS (SELECT *, substr(o_orderpriority, 1, 1)::INT AS campaign_id FROM orders),
ev AS (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                 WHEN 'purchase' THEN 4 ELSE 5 END AS campaign_id FROM events)"""


@query("metric_revenue_by_campaign_type", "K6 K7 K11 A16", f"""
WITH {CAMPAIGN_SQL},
 o AS (SELECT campaign_type, sum(o_totalprice) AS rev FROM ord JOIN camp USING (campaign_id) GROUP BY 1),
 e AS (SELECT campaign_type, count(*) AS sends FROM ev JOIN camp USING (campaign_id) GROUP BY 1)
SELECT campaign_type, round(rev, 2) AS attributed_revenue, round(rev / sends, 4) AS revenue_per_send
FROM o JOIN e USING (campaign_type)""")
def revenue_by_campaign_type(t):
    out = ask(md.sms_model(t), ["attributed_revenue", "revenue_per_send"], ["campaign_type"])
    return rounded(out, {"attributed_revenue": 2, "revenue_per_send": 4})


@query("metric_ctr_by_theme", "K11 K5", f"""
WITH {CAMPAIGN_SQL}
SELECT theme, round(CASE WHEN d = 0 THEN 0 ELSE c / d END, 6) AS ctr FROM (
  SELECT theme, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS d,
         sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS c
  FROM ev JOIN camp USING (campaign_id) GROUP BY 1)""")
def ctr_by_theme(t):
    return rounded(md.sms_model(t).run("ctr_by_theme"), {"ctr": 6})


@query("metric_consent_by_region", "K11 K7 G1", f"""
WITH {GEO_SQL}
SELECT r_name AS brand_region,
  round(sum(CASE WHEN {CONSENT_SQL} = 'opted_in' THEN 1 ELSE 0 END) / count(*), 6) AS consent_rate,
  round(sum(CASE WHEN {CONSENT_SQL} = 'opted_out' THEN 1 ELSE 0 END) / count(*), 6) AS list_churn_rate
FROM customer JOIN geo ON n_nationkey = c_nationkey GROUP BY 1""")
def consent_by_region(t):
    return rounded(md.sms_model(t).run("consent_rate_by_region"),
                   {"consent_rate": 6, "list_churn_rate": 6})


@query("metric_two_dimensions", "K3 K6 K7", f"""
WITH {CAMPAIGN_SQL},
 o AS (SELECT c_mktsegment AS segment, campaign_type, sum(o_totalprice) AS rev, count(*) AS n
       FROM ord JOIN camp USING (campaign_id) JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
 e AS (SELECT c_mktsegment AS segment, campaign_type, count(*) AS sends
       FROM ev JOIN camp USING (campaign_id) JOIN customer ON c_custkey = user_id GROUP BY ALL)
SELECT segment, campaign_type, n AS order_count, coalesce(sends, 0) AS send_count,
       round(CASE WHEN coalesce(sends, 0) = 0 THEN 0 ELSE rev / sends END, 4) AS revenue_per_send
FROM o FULL JOIN e USING (segment, campaign_type)""")
def two_dimensions(t):
    out = ask(md.sms_model(t), ["order_count", "send_count", "revenue_per_send"],
              ["segment", "campaign_type"])
    return rounded(out, {"revenue_per_send": 4})


@query("metric_revenue_by_month", "K3 I8 E12", """
SELECT date_trunc('month', o_orderdate)::DATE AS order_month, round(sum(o_totalprice), 2) AS attributed_revenue,
       count(*) AS order_count FROM orders GROUP BY 1""")
def revenue_by_month(t):
    out = ask(md.sms_model(t), ["attributed_revenue", "order_count"], ["month of order"])
    return rounded(out, {"attributed_revenue": 2})


@query("metric_opt_in_growth_by_month", "K3 K11", """
SELECT date_trunc('month', started)::DATE AS opt_in_month, count(*) AS opt_in_growth
FROM (SELECT o_custkey, min(o_orderdate) AS started FROM orders GROUP BY 1)
JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def opt_in_growth_by_month(t):
    return ask(md.sms_model(t, with_opt_in=True), ["new recipients"], ["opt_in_month"])


@query("metric_revenue_by_brand_via_campaign", "K8", f"""
WITH {CAMPAIGN_SQL}
SELECT n_name AS brand, round(sum(o_totalprice), 2) AS attributed_revenue
FROM ord JOIN camp USING (campaign_id) JOIN nation ON n_nationkey = brand_id GROUP BY 1""")
def revenue_by_brand_via_campaign(t):
    out = ask(md.sms_model(t), ["attributed_revenue"], ["brand"], via=("orders_to_campaigns",))
    return rounded(out, {"attributed_revenue": 2})


@query("metric_grand_total", "K4 K5 E10", """
SELECT round((SELECT sum(o_totalprice) FROM orders), 2) AS attributed_revenue,
       (SELECT count(*) FROM events) AS send_count,
       round((SELECT sum(o_totalprice) FROM orders) / (SELECT count(*) FROM events), 4) AS revenue_per_send""")
def grand_total(t):
    out = ask(md.sms_model(t), ["attributed_revenue", "send_count", "revenue_per_send"])
    return rounded(out, {"attributed_revenue": 2, "revenue_per_send": 4})


@query("metric_cx_by_plan", "K4 K5 K6 K11 E15", f"""
WITH {LABEL_SQL}, {THUMBS_SQL},
 c AS (SELECT c_mktsegment AS plan, count(*) AS n, sum(c_acctbal) AS mrr, avg(c_acctbal) AS avg_mrr
       FROM customer GROUP BY 1),
 e AS (SELECT c_mktsegment AS plan, count(*) AS ev FROM events JOIN customer ON c_custkey = user_id GROUP BY 1),
 v AS (SELECT c_mktsegment AS plan, avg(o_totalprice) AS hv FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
 l AS (SELECT c_mktsegment AS plan, sum(is_lapsed) AS ch FROM lab JOIN customer USING (c_custkey) GROUP BY 1),
 f AS (SELECT c_mktsegment AS plan, count(*) FILTER (WHERE rating > 0) AS up,
              count(*) FILTER (WHERE rating < 0) AS dn
       FROM customer LEFT JOIN ratings ON conv_id = c_custkey GROUP BY 1)
SELECT plan, n AS customer_count, round(mrr, 2) AS total_mrr, round(avg_mrr, 4) AS avg_mrr,
  coalesce(ev, 0) AS total_events, round(hv, 4) AS avg_home_value, ch::BIGINT AS churned_customers,
  up AS total_thumbs_up, dn AS total_thumbs_down, round(ch / n, 6) AS churn_rate,
  round(CASE WHEN up + dn = 0 THEN 0 ELSE dn / (up + dn) END, 6) AS thumbs_down_rate
FROM c LEFT JOIN e USING (plan) LEFT JOIN v USING (plan) LEFT JOIN l USING (plan) LEFT JOIN f USING (plan)""")
def cx_by_plan(t):
    model = md.cx_model(t)
    names = [m.name for m in model.metrics] + [r.name for r in model.ratios]
    return rounded(ask(model, names, ["plan"]), {
        "total_mrr": 2, "avg_mrr": 4, "avg_home_value": 4, "churn_rate": 6, "thumbs_down_rate": 6})


@query("metric_donor_by_region_segment", "K4 K5 K6", f"""
WITH {LABEL_SQL}, {GEO_SQL},
 cu AS (SELECT c_custkey, r_name AS region, c_mktsegment AS donor_segment
        FROM customer JOIN geo ON n_nationkey = c_nationkey),
 c AS (SELECT region, donor_segment, count(*) AS donor_count FROM cu GROUP BY ALL),
 d AS (SELECT region, donor_segment, sum(o_totalprice) AS tg, avg(o_totalprice) AS ag, count(*) AS gc
       FROM orders JOIN cu ON c_custkey = o_custkey GROUP BY ALL),
 e AS (SELECT region, donor_segment, count(*) AS ec FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN cu ON c_custkey = o_custkey GROUP BY ALL),
 l AS (SELECT region, donor_segment, sum(is_lapsed) AS ld, count(*) AS n FROM lab JOIN cu USING (c_custkey) GROUP BY ALL)
SELECT region, donor_segment, donor_count, round(tg, 2) AS total_giving, round(ag, 6) AS avg_gift,
  gc AS gift_count, ec AS engagement_count, ld::BIGINT AS lapsed_donors, round(ld / n, 6) AS lapse_rate
FROM c JOIN d USING (region, donor_segment) JOIN e USING (region, donor_segment)
JOIN l USING (region, donor_segment)""")
def donor_by_region_segment(t):
    out = ask(md.donor_model(t), ["donor_count", "total_giving", "avg_gift", "gift_count",
                                  "engagement_count", "lapsed_donors", "lapse_rate"],
              ["region", "segment"])
    return rounded(out, {"total_giving": 2, "avg_gift": 6, "lapse_rate": 6})


@query("metric_donor_verified_segment", "K7 K11", f"""
WITH {LABEL_SQL}, {GEO_SQL}
SELECT r_name AS region, c_mktsegment AS donor_segment, round(sum(is_lapsed) / count(*), 6) AS lapse_rate
FROM lab JOIN customer USING (c_custkey) JOIN geo ON n_nationkey = c_nationkey
WHERE r_name = 'ASIA' AND c_mktsegment = 'MACHINERY' GROUP BY ALL""")
def donor_verified_segment(t):
    return rounded(md.donor_model(t).run("lapse_rate_one_segment"), {"lapse_rate": 6})


@query("metric_gtm_by_region", "K4 K6", f"""
WITH {GEO_SQL},
 e AS (SELECT r_name AS region, count(*) AS email_count, avg(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS o,
   avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS r,
   avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS m,
   avg(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000000 END) AS i
   FROM orders JOIN customer ON c_custkey = o_custkey JOIN geo ON n_nationkey = c_nationkey GROUP BY 1),
 w AS (SELECT r_name AS region, avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS win, sum(l_extendedprice) AS rev
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
   JOIN geo ON n_nationkey = c_nationkey GROUP BY 1)
SELECT region, email_count, round(o, 6) AS open_rate, round(r, 6) AS reply_rate, round(m, 6) AS meeting_rate,
  round(i, 6) AS avg_intent, round(win, 6) AS win_rate, round(rev, 2) AS total_revenue FROM e JOIN w USING (region)""")
def gtm_by_region(t):
    model = md.gtm_model(t)
    out = ask(model, [m.name for m in model.metrics], ["region"])
    return rounded(out, {"open_rate": 6, "reply_rate": 6, "meeting_rate": 6, "avg_intent": 6,
                         "win_rate": 6, "total_revenue": 2})


@query("metric_gtm_by_tier_team", "K3 K6", """
WITH e AS (SELECT substr(o_orderpriority, 1, 1)::INT AS quality_tier, c_mktsegment AS team, count(*) AS email_count,
     avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS r
     FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
 w AS (SELECT substr(o_orderpriority, 1, 1)::INT AS quality_tier, c_mktsegment AS team,
     avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS win
     FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT quality_tier, team, email_count, round(r, 6) AS reply_rate, round(win, 6) AS win_rate
FROM e JOIN w USING (quality_tier, team)""")
def gtm_by_tier_team(t):
    out = ask(md.gtm_model(t), ["email_count", "reply_rate", "win_rate"], ["quality_tier", "team"])
    return rounded(out, {"reply_rate": 6, "win_rate": 6})


@query("metric_retail_by_metro", "K1 K4 K6 K7", """
WITH r AS (SELECT n_name AS metro, sum(l_extendedprice) AS refund, count(*) AS n,
       sum(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS fraud, avg(l_extendedprice) AS ar
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
       WHERE l_returnflag = 'R' GROUP BY 1),
 sm AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS m, sum(l_extendedprice) AS sales,
          count(*) FILTER (WHERE l_returnflag = 'R') / count(*) AS rr FROM lineitem GROUP BY ALL),
 s AS (SELECT n_name AS metro, sum(sales) AS sales, avg(rr) AS rr FROM sm JOIN supplier ON s_suppkey = l_suppkey
       JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
SELECT metro, round(refund, 2) AS total_refund, n AS return_txn_count, fraud::BIGINT AS fraud_suspected_count,
  round(ar, 4) AS avg_refund, round(sales, 2) AS total_sales, round(rr, 6) AS avg_return_rate
FROM r JOIN s USING (metro)""")
def retail_by_metro(t):
    model = md.retail_model(t)
    out = ask(model, [m.name for m in model.metrics], ["market"])
    return rounded(out, {"total_refund": 2, "avg_refund": 4, "total_sales": 2, "avg_return_rate": 6})


@query("metric_retail_store_categories", "K7", """
SELECT p_type AS product_category, l_suppkey AS store_id_dim, round(sum(l_extendedprice), 2) AS total_refund,
       count(*) AS return_txn_count
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND l_suppkey = 42 GROUP BY ALL""")
def retail_store_categories(t):
    out = ask(md.retail_model(t), ["total_refund", "return_txn_count"],
              ["department", "store"]).filter("store_id_dim = 42").orderBy(F.desc("total_refund"))
    return rounded(out, {"total_refund": 2})


@query("metric_key_checks", "K1", """
SELECT 'key:geography' AS check_name, count(*) AS violations FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'key:reps', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'key:emails', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'key:outcomes', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'reference:reps_to_geography', count(DISTINCT c_nationkey) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'reference:email_to_rep', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'reference:outcome_to_email', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def key_checks(t):
    return check_keys(md.gtm_model(t))


# ---- verified queries that the models declare ------------------------------------------

@query("metric_verified_revenue_by_type", "K11", f"""
WITH {CAMPAIGN_SQL} SELECT campaign_type, round(sum(o_totalprice), 2) AS attributed_revenue
FROM ord JOIN camp USING (campaign_id) GROUP BY 1""")
def verified_revenue_by_type(t):
    return rounded(md.sms_model(t).run("attributed_revenue_by_type"), {"attributed_revenue": 2})


@query("metric_verified_rps_by_type", "K11", f"""
WITH {CAMPAIGN_SQL},
 o AS (SELECT campaign_type, sum(o_totalprice) AS rev FROM ord JOIN camp USING (campaign_id) GROUP BY 1),
 e AS (SELECT campaign_type, count(*) AS sends FROM ev JOIN camp USING (campaign_id) GROUP BY 1)
SELECT campaign_type, round(rev / sends, 4) AS revenue_per_send FROM o JOIN e USING (campaign_type)""")
def verified_rps_by_type(t):
    return rounded(md.sms_model(t).run("rps_flow_vs_broadcast"), {"revenue_per_send": 4})


@query("metric_verified_opt_in_growth", "K11", f"""
WITH {GEO_SQL} SELECT r_name AS brand_region, count(*) AS opt_in_growth
FROM customer JOIN geo ON n_nationkey = c_nationkey GROUP BY 1""")
def verified_opt_in_growth(t):
    return md.sms_model(t).run("opt_in_growth_by_region")


@query("metric_verified_churn_by_plan", "K11", f"""
WITH {LABEL_SQL} SELECT c_mktsegment AS plan, round(coalesce(sum(is_lapsed), 0) / count(*), 6) AS churn_rate
FROM customer LEFT JOIN lab USING (c_custkey) GROUP BY 1""")
def verified_churn_by_plan(t):
    return rounded(md.cx_model(t).run("churn_by_plan"), {"churn_rate": 6})


@query("metric_verified_thumbs_down_by_plan", "K11", f"""
WITH {THUMBS_SQL}, f AS (SELECT c_mktsegment AS plan, count(*) FILTER (WHERE rating > 0) AS up, count(*) FILTER (WHERE rating < 0) AS dn
  FROM customer LEFT JOIN ratings ON conv_id = c_custkey GROUP BY 1)
SELECT plan, round(CASE WHEN up + dn = 0 THEN 0 ELSE dn / (up + dn) END, 6) AS thumbs_down_rate FROM f""")
def verified_thumbs_down_by_plan(t):
    return rounded(md.cx_model(t).run("thumbs_down_by_plan"), {"thumbs_down_rate": 6})


@query("metric_verified_lapse_by_region", "K11", f"""
WITH {LABEL_SQL}, {GEO_SQL} SELECT r_name AS region, round(sum(is_lapsed) / count(*), 6) AS lapse_rate
FROM lab JOIN customer USING (c_custkey) JOIN geo ON n_nationkey = c_nationkey GROUP BY 1""")
def verified_lapse_by_region(t):
    return rounded(md.donor_model(t).run("lapse_rate_by_region"), {"lapse_rate": 6})


@query("metric_enum_violations", "K10", """
SELECT 'segment' AS dimension, c_mktsegment AS value, count(*) AS rows FROM customer
WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') GROUP BY ALL""")
def enum_violations(t):
    model = Model("customers", (Table("customers", t.customer, ("c_custkey",)),), dimensions=(
        Dimension("customers", "segment", "c_mktsegment",
                  enum=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")),))
    return check_enums(model)


@query("metric_catalog_sizes", "K9 K12", """
WITH s(table_name, rows) AS (SELECT 'reps', count(*) FROM customer UNION ALL SELECT 'emails', count(*) FROM orders
  UNION ALL SELECT 'outcomes', count(*) FROM lineitem UNION ALL SELECT 'geography', count(*) FROM nation),
 c(kind, name, table_name, synonyms) AS (VALUES ('dimension', 'quality_tier', 'emails', ''), ('dimension', 'sent_month', 'emails', ''), ('dimension', 'team', 'reps', ''),
  ('dimension', 'region', 'geography', ''), ('metric', 'email_count', 'emails', ''), ('metric', 'open_rate', 'emails', ''), ('metric', 'reply_rate', 'emails', ''),
  ('metric', 'meeting_rate', 'emails', ''), ('metric', 'avg_intent', 'emails', ''), ('metric', 'win_rate', 'outcomes', ''), ('metric', 'total_revenue', 'outcomes', ''))
SELECT kind, name, table_name, synonyms, rows FROM c JOIN s USING (table_name)""")
def metric_catalog_sizes(t):
    """Declared names and synonyms with the size of the table each one is read from."""
    model = md.gtm_model(t)
    sizes = reduce(lambda a, b: a.unionByName(b), [
        table.frame.agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(table.name)) for table in model.tables])
    return catalog(t.spark, model).join(sizes, "table_name").withColumn(
        "synonyms", F.array_join("synonyms", ", "))
