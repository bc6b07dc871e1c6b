"""Stand-in star schemas over the test tables, and their metric models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import add_months
from beaconry.functions.sampling import stable_bucket
from beaconry.operators import features as ft
from beaconry.operators.metrics import (Dimension, Fact, Metric, Model, Ratio, Relationship,
                                        Table, query)
from beaconry.session import Tables, values

# Campaign id, type, theme and owning brand (nation) of the five
# campaigns that stand in for order priorities and event types.
CAMPAIGNS = [
    (1, "broadcast", "First Look", 1),
    (2, "broadcast", "Clearance", 2),
    (3, "broadcast", "Restock", 3),
    (4, "flow", "Greeting", 4),
    (5, "flow", "Forgotten Basket", 5),
]
CAMPAIGN_OF_EVENT = ("CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 "
                     "WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END")
CONSENT = ("CASE WHEN c_acctbal < 0 THEN 'opted_out' "
           "WHEN c_acctbal < 1000 THEN 'pending' ELSE 'opted_in' END")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def campaigns(t: Tables) -> DataFrame:
    return values(t.spark, CAMPAIGNS, "campaign_id, campaign_type, theme, brand_id")


def geography(t: Tables) -> DataFrame:
    """Nation with its region: bounded by the list of countries."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")


def customers_started(t: Tables) -> DataFrame:
    """Customer with the first order date as acquisition date."""
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("started"))
    return t.customer.join(first, "c_custkey")


def churn_as_of(t: Tables):
    return add_months(t.latest("orders", "o_orderdate"), -12)


def lapse_labels(t: Tables, customers: DataFrame | None = None) -> DataFrame:
    as_of = churn_as_of(t)
    base = customers if customers is not None else customers_started(t)
    return ft.forward_label(base, t.orders, "c_custkey", "started", "o_custkey",
                            "o_orderdate", as_of)


def thumbs(t: Tables) -> DataFrame:
    """Rating +1/-1/none per conversation, fixed by a hash of its id."""
    ids = t.conversations.select("conv_id").distinct()
    b = stable_bucket(F.col("conv_id"), "rating")
    rating = F.when(b < 40, 1).when(b < 70, -1)
    return ids.select("conv_id", rating.alias("rating")).filter("rating IS NOT NULL")


# Names of metrics, ratios, facts and dimensions in the models below must
# match those that users already query; synonyms are free.
def sms_model(t: Tables, with_opt_in: bool = False) -> Model:
    subscribers = (customers_started(t) if with_opt_in else t.customer).withColumn(
        "consent_status", F.expr(CONSENT))
    sends = t.events.withColumn("campaign_id", F.expr(CAMPAIGN_OF_EVENT))
    orders = t.orders.withColumn(
        "attributed_campaign_id", F.substring("o_orderpriority", 1, 1).cast("int"))
    dims = [
        Dimension("brands", "brand_region", "r_name", ("part of the world",)),
        Dimension("brands", "brand", "n_name", ("nation of the sender",)),
        Dimension("subscribers", "segment", "c_mktsegment", ("line of business",), SEGMENTS),
        Dimension("subscribers", "consent_status", "consent_status", ("permission",),
                  ("opted_in", "opted_out", "pending")),
        Dimension("campaigns", "campaign_type", "campaign_type", ("one-off or triggered",),
                  ("broadcast", "flow")),
        Dimension("campaigns", "theme", "theme", ("occasion",)),
        Dimension("orders", "order_date", "to_date(o_orderdate)"),
        Dimension("orders", "order_month", "to_date(date_trunc('month', o_orderdate))",
                  ("month of order",)),
    ]
    if with_opt_in:
        dims.append(Dimension("subscribers", "opt_in_month",
                              "to_date(date_trunc('month', started))", ("month of first order",)))
    return Model(
        "sms_marketing",
        tables=(
            Table("brands", geography(t), ("n_nationkey",), bounded=True, synonyms=("senders",)),
            Table("subscribers", subscribers, ("c_custkey",), synonyms=("recipients",)),
            Table("campaigns", campaigns(t), ("campaign_id",), bounded=True),
            Table("messages", sends, ("event_id",), synonyms=("notices",)),
            Table("orders", orders, ("o_orderkey",), synonyms=("baskets",)),
        ),
        relationships=(
            Relationship("subscribers_to_brands", "subscribers", ("c_nationkey",), "brands"),
            Relationship("campaigns_to_brands", "campaigns", ("brand_id",), "brands"),
            Relationship("messages_to_campaigns", "messages", ("campaign_id",), "campaigns"),
            Relationship("messages_to_subscribers", "messages", ("user_id",), "subscribers"),
            Relationship("orders_to_subscribers", "orders", ("o_custkey",), "subscribers"),
            Relationship("orders_to_campaigns", "orders", ("attributed_campaign_id",), "campaigns"),
        ),
        facts=(
            Fact("messages", "delivered_flag", "IF(event_type <> 'error', 1, 0)"),
            Fact("messages", "clicked_flag", "IF(event_type IN ('click', 'purchase'), 1, 0)"),
            Fact("messages", "send_cost", "value"),
            Fact("subscribers", "is_opted_in", "IF(consent_status = 'opted_in', 1, 0)"),
            Fact("subscribers", "is_opted_out", "IF(consent_status = 'opted_out', 1, 0)"),
            Fact("orders", "order_revenue", "o_totalprice"),
        ),
        dimensions=tuple(dims),
        metrics=(
            Metric("orders", "attributed_revenue", "sum", "order_revenue",
                   ("credited turnover",)),
            Metric("orders", "order_count", "count", "o_orderkey", ("baskets placed",)),
            Metric("messages", "send_count", "count", "event_id", ("notices sent",)),
            Metric("messages", "delivered_count", "sum", "delivered_flag"),
            Metric("messages", "click_count", "sum", "clicked_flag", ("link opens",)),
            Metric("messages", "total_send_cost", "sum", "send_cost", ("dispatch cost",)),
            Metric("subscribers", "subscriber_count", "count", "c_custkey", ("audience",)),
            Metric("subscribers", "opt_in_growth", "count", "c_custkey", ("new recipients",)),
            Metric("subscribers", "opted_out_count", "sum", "is_opted_out", ("lost recipients",)),
            Metric("subscribers", "consented_count", "sum", "is_opted_in"),
        ),
        ratios=(
            Ratio("revenue_per_send", ("attributed_revenue",), ("send_count",), ("turnover per notice",)),
            Ratio("ctr", ("click_count",), ("delivered_count",), ("open share",)),
            Ratio("subscriber_ltv", ("attributed_revenue",), ("subscriber_count",), ("turnover per recipient",)),
            Ratio("list_churn_rate", ("opted_out_count",), ("subscriber_count",), ("loss share",)),
            Ratio("consent_rate", ("consented_count",), ("subscriber_count",), ("permission share",)),
        ),
        verified={
            "attributed_revenue_by_type": lambda m: query(
                m, ["attributed_revenue"], ["campaign_type"]).orderBy(F.desc("attributed_revenue")),
            "rps_flow_vs_broadcast": lambda m: query(
                m, ["revenue_per_send"], ["campaign_type"]).orderBy(F.desc("revenue_per_send")),
            "opt_in_growth_by_region": lambda m: query(
                m, ["opt_in_growth"], ["brand_region"],
                via=("subscribers_to_brands",)).orderBy(F.desc("opt_in_growth")),
            "consent_rate_by_region": lambda m: query(
                m, ["consent_rate", "list_churn_rate"], ["brand_region"],
                via=("subscribers_to_brands",)).orderBy(F.desc("consent_rate")),
            "ctr_by_theme": lambda m: query(m, ["ctr"], ["theme"]).orderBy(F.desc("ctr")),
        },
    )


def cx_model(t: Tables) -> Model:
    ratings = thumbs(t).groupBy(F.col("conv_id").alias("fb_custkey")).agg(
        F.count_if(F.col("rating") > 0).alias("thumbs_up"),
        F.count_if(F.col("rating") < 0).alias("thumbs_down"))
    feedback = (t.customer.select("c_custkey")
                .join(ratings, F.col("c_custkey") == F.col("fb_custkey"), "left")
                .select(F.col("c_custkey").alias("fb_custkey"),
                        F.coalesce("thumbs_up", F.lit(0)).alias("thumbs_up"),
                        F.coalesce("thumbs_down", F.lit(0)).alias("thumbs_down")))
    churn = lapse_labels(t).select(F.col("c_custkey").alias("ch_custkey"),
                                   (F.col("is_lapsed") == 1).alias("is_churned"))
    subscriptions = t.customer.select(F.col("c_custkey").alias("sub_custkey"),
                                      F.col("c_acctbal").alias("mrr"))
    return Model(
        "customer_experience",
        tables=(
            Table("customers", t.customer, ("c_custkey",)),
            Table("subscriptions", subscriptions, ("sub_custkey",)),
            Table("engagement", t.events, ("event_id",)),
            Table("valuations", t.orders, ("o_orderkey",)),
            Table("churn", churn, ("ch_custkey",)),
            Table("feedback", feedback, ("fb_custkey",)),
        ),
        relationships=(
            Relationship("subs_to_customers", "subscriptions", ("sub_custkey",), "customers"),
            Relationship("events_to_customers", "engagement", ("user_id",), "customers"),
            Relationship("valuations_to_customers", "valuations", ("o_custkey",), "customers"),
            Relationship("churn_to_customers", "churn", ("ch_custkey",), "customers"),
            Relationship("feedback_to_customers", "feedback", ("fb_custkey",), "customers"),
        ),
        facts=(Fact("churn", "churned_flag", "IF(is_churned, 1, 0)"),),
        dimensions=(
            Dimension("customers", "plan", "c_mktsegment", ("tier",)),
            Dimension("engagement", "event_type", "event_type"),
            Dimension("churn", "is_churned", "is_churned"),
        ),
        metrics=(
            Metric("customers", "customer_count", "count", "c_custkey"),
            Metric("subscriptions", "total_mrr", "sum", "mrr"),
            Metric("subscriptions", "avg_mrr", "avg", "mrr"),
            Metric("engagement", "total_events", "count", "event_id"),
            Metric("valuations", "avg_home_value", "avg", "o_totalprice"),
            Metric("churn", "churned_customers", "sum", "churned_flag"),
            Metric("feedback", "total_thumbs_up", "sum", "thumbs_up"),
            Metric("feedback", "total_thumbs_down", "sum", "thumbs_down"),
        ),
        ratios=(
            Ratio("churn_rate", ("churned_customers",), ("customer_count",)),
            Ratio("thumbs_down_rate", ("total_thumbs_down",),
                  ("total_thumbs_up", "total_thumbs_down")),
        ),
        verified={
            "churn_by_plan": lambda m: query(m, ["churn_rate"], ["plan"]),
            "thumbs_down_by_plan": lambda m: query(m, ["thumbs_down_rate"], ["plan"]),
        },
    )


def donor_model(t: Tables) -> Model:
    training = lapse_labels(t).withColumnRenamed("c_custkey", "tr_custkey")
    return Model(
        "donor_churn",
        tables=(
            Table("geography", geography(t), ("n_nationkey",), bounded=True),
            Table("donors", t.customer, ("c_custkey",)),
            Table("donations", t.orders, ("o_orderkey",)),
            Table("engagements", t.lineitem, ("l_orderkey", "l_linenumber")),
            Table("training", training, ("tr_custkey",)),
        ),
        relationships=(
            Relationship("donors_to_geography", "donors", ("c_nationkey",), "geography"),
            Relationship("donations_to_donors", "donations", ("o_custkey",), "donors"),
            Relationship("engagements_to_donations", "engagements", ("l_orderkey",), "donations"),
            Relationship("training_to_donors", "training", ("tr_custkey",), "donors"),
        ),
        dimensions=(
            Dimension("geography", "region", "r_name"),
            Dimension("donors", "donor_segment", "c_mktsegment", ("segment", "giving level")),
            Dimension("donations", "appeal_type", "o_orderpriority"),
            Dimension("donations", "gift_month", "to_date(date_trunc('month', o_orderdate))"),
            Dimension("training", "is_lapsed", "is_lapsed"),
        ),
        metrics=(
            Metric("donors", "donor_count", "count", "c_custkey"),
            Metric("donations", "total_giving", "sum", "o_totalprice"),
            Metric("donations", "avg_gift", "avg", "o_totalprice"),
            Metric("donations", "gift_count", "count", "o_orderkey"),
            Metric("engagements", "engagement_count", "count", "l_orderkey"),
            Metric("training", "lapsed_donors", "sum", "is_lapsed"),
            Metric("training", "labelled_donors", "count", "tr_custkey"),
        ),
        ratios=(Ratio("lapse_rate", ("lapsed_donors",), ("labelled_donors",)),),
        verified={
            "lapse_rate_by_region": lambda m: query(m, ["lapse_rate"], ["region"]),
            "lapse_rate_one_segment": lambda m: query(
                m, ["lapse_rate"], ["region", "donor_segment"]).filter(
                "region = 'ASIA' AND donor_segment = 'MACHINERY'"),
        },
    )


def gtm_model(t: Tables) -> Model:
    return Model(
        "outreach",
        tables=(
            Table("geography", geography(t), ("n_nationkey",), bounded=True),
            Table("reps", t.customer, ("c_custkey",)),
            Table("emails", t.orders, ("o_orderkey",)),
            Table("outcomes", t.lineitem, ("l_orderkey", "l_linenumber")),
        ),
        relationships=(
            Relationship("reps_to_geography", "reps", ("c_nationkey",), "geography"),
            Relationship("email_to_rep", "emails", ("o_custkey",), "reps"),
            Relationship("outcome_to_email", "outcomes", ("l_orderkey",), "emails"),
        ),
        facts=(
            Fact("emails", "opened_flag", "IF(o_orderstatus <> 'P', 1, 0)"),
            Fact("emails", "replied_flag", "IF(o_orderstatus = 'F', 1, 0)"),
            Fact("emails", "meeting_flag", "IF(o_orderpriority = '1-URGENT', 1, 0)"),
            Fact("emails", "intent", "IF(o_orderstatus = 'P', NULL, o_totalprice / 1000000)"),
            Fact("outcomes", "won_flag", "IF(l_returnflag = 'N', 1, 0)"),
            Fact("outcomes", "revenue_amount", "l_extendedprice"),
        ),
        dimensions=(
            Dimension("emails", "quality_tier", "CAST(substring(o_orderpriority, 1, 1) AS INT)"),
            Dimension("emails", "sent_month", "to_date(date_trunc('month', o_orderdate))"),
            Dimension("reps", "team", "c_mktsegment"),
            Dimension("geography", "region", "r_name"),
        ),
        metrics=(
            Metric("emails", "email_count", "count", "o_orderkey"),
            Metric("emails", "open_rate", "avg", "opened_flag"),
            Metric("emails", "reply_rate", "avg", "replied_flag"),
            Metric("emails", "meeting_rate", "avg", "meeting_flag"),
            Metric("emails", "avg_intent", "avg", "intent"),
            Metric("outcomes", "win_rate", "avg", "won_flag"),
            Metric("outcomes", "total_revenue", "sum", "revenue_amount"),
        ),
    )


def store_month_metrics(t: Tables) -> DataFrame:
    """Monthly sales and returned share per supplier."""
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    return (t.lineitem.groupBy(F.col("l_suppkey").alias("sm_suppkey"), month.alias("metric_month"))
            .agg(F.sum("l_extendedprice").alias("sales_amount"),
                 F.count("*").alias("transaction_count"),
                 F.count_if(F.col("l_returnflag") == "R").alias("return_count"))
            .withColumn("return_rate", F.col("return_count") / F.col("transaction_count")))


def retail_model(t: Tables) -> Model:
    returns = t.lineitem.filter("l_returnflag = 'R'").join(
        t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return Model(
        "retail_returns",
        tables=(
            Table("retailers", t.region, ("r_regionkey",), bounded=True),
            Table("metros", t.nation, ("n_nationkey",), bounded=True),
            Table("stores", t.supplier, ("s_suppkey",)),
            Table("returns", returns, ("l_orderkey", "l_linenumber")),
            Table("store_metrics", store_month_metrics(t), ("sm_suppkey", "metric_month")),
        ),
        relationships=(
            Relationship("metros_to_retailers", "metros", ("n_regionkey",), "retailers"),
            Relationship("stores_to_metros", "stores", ("s_nationkey",), "metros"),
            Relationship("returns_to_stores", "returns", ("l_suppkey",), "stores"),
            Relationship("metrics_to_stores", "store_metrics", ("sm_suppkey",), "stores"),
        ),
        facts=(Fact("returns", "fraud_flag", "IF(l_discount >= 0.09, 1, 0)"),),
        dimensions=(
            Dimension("retailers", "retailer_name", "r_name", ("chain", "tenant")),
            Dimension("metros", "metro", "n_name", ("market",)),
            Dimension("stores", "store_id_dim", "s_suppkey", ("store",)),
            Dimension("returns", "product_category", "p_type", ("department",)),
            Dimension("returns", "return_date", "to_date(l_shipdate)"),
            Dimension("store_metrics", "metric_month", "metric_month"),
        ),
        metrics=(
            Metric("returns", "total_refund", "sum", "l_extendedprice"),
            Metric("returns", "return_txn_count", "count", "l_orderkey"),
            Metric("returns", "fraud_suspected_count", "sum", "fraud_flag"),
            Metric("returns", "avg_refund", "avg", "l_extendedprice"),
            Metric("store_metrics", "total_sales", "sum", "sales_amount"),
            Metric("store_metrics", "avg_return_rate", "avg", "return_rate"),
        ),
    )
