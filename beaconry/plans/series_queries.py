"""Forecast, anomalies, drivers, briefing and monitoring (group M, set-based part)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import add_months, bucket, ntz, sunday_zero_weekday
from beaconry.operators import monitor as mon
from beaconry.operators.drivers import key_drivers, ranked_drivers, top_drivers
from beaconry.operators.series import detect_anomalies, forecast
from beaconry.plans import models as md
from beaconry.plans.feature_queries import BASE_SQL, training
from beaconry.plans.registry import query
from beaconry.session import Tables, rounded, scratch_path
from beaconry.sources.tables import replace_table

Z99, Z95 = 2.5758293035489004, 1.959963984540054


def weekly_volume(t: Tables, by: list[str] = ()) -> DataFrame:
    return t.orders.groupBy(*by, bucket("week", F.col("o_orderdate")).alias("week_ts")).agg(
        F.sum("o_totalprice").alias("total_amount"))


def forecast_sql(key: str) -> str:
    k, g, on = (f"{key},", f"GROUP BY {key}", f"USING ({key})") if key else ("", "", "ON true")
    on2 = f"USING ({key}, slot)" if key else "USING (slot)"
    return f"""
WITH w AS (SELECT {k} date_trunc('week', o_orderdate)::DATE AS wk, sum(o_totalprice) AS y FROM orders GROUP BY ALL),
 r AS (SELECT {k} (wk - DATE '1970-01-05') // 7 AS i, y FROM w),
 f AS (SELECT {k} regr_slope(y, i) AS b, regr_intercept(y, i) AS a, max(i) AS last FROM r {g}),
 e AS (SELECT {k} i % 52 AS slot, y - (a + b * i) AS res FROM r JOIN f {on}),
 s AS (SELECT {k} slot, avg(res) AS s, var_pop(res) AS v, count(*) AS n FROM e GROUP BY {k} slot),
 d AS (SELECT {k} sqrt(sum(v * n) / sum(n)) AS sd FROM s {g}),
 h AS (SELECT {k} a, b, sd, last + g AS i, (last + g) % 52 AS slot FROM f JOIN d {on}, range(1, 14) x(g)),
 o AS (SELECT {k} DATE '1970-01-05' + (i * 7)::INT AS ts, a + b * i + coalesce(s, 0) AS v, sd FROM h LEFT JOIN s {on2})
SELECT {k} ts, round(v, 0) AS forecast, round(v - {Z95} * sd, 0) AS lower_bound, round(v + {Z95} * sd, 0) AS upper_bound FROM o"""


ROUND0 = {"forecast": 0, "lower_bound": 0, "upper_bound": 0}


@query("forecast_weekly_volume", "M10", forecast_sql(""))
def forecast_weekly_volume(t):
    return rounded(forecast(weekly_volume(t), [], "week_ts", "total_amount", 13), ROUND0)


@query("forecast_many_series", "M10", forecast_sql("o_orderpriority"))
def forecast_many_series(t):
    keys = ["o_orderpriority"]
    return rounded(forecast(weekly_volume(t, keys), keys, "week_ts", "total_amount", 13), ROUND0)


@query("anomaly_weekly_volume", "M11", f"""
WITH w AS (SELECT date_trunc('week', o_orderdate)::DATE AS ts, sum(o_totalprice) AS y FROM orders GROUP BY 1),
 c AS (SELECT max(o_orderdate) - INTERVAL 6 MONTH AS cut FROM orders),
 f AS (SELECT avg(y) AS m, sqrt(var_samp(y) * (count(*) - 1) / (count(*) - 1)) AS sd FROM w, c WHERE ts < cut)
SELECT ts, round(y, 2) AS y, round(m, 2) AS forecast, round(m - {Z99} * sd, 0) AS lower_bound, round(m + {Z99} * sd, 0) AS upper_bound,
 round((y - m) / sd, 4) AS distance, (y < m - {Z99} * sd OR y > m + {Z99} * sd) AS is_anomaly FROM w, f, c WHERE ts >= cut""")
def anomaly_weekly_volume(t):
    cut = add_months(t.latest("orders", "o_orderdate"), -6)
    weeks = weekly_volume(t).withColumn("series", F.lit("all"))
    out = detect_anomalies(weeks, ["series"], "week_ts", "total_amount", cut).drop("series", "basis")
    return rounded(out, {"y": 2, "forecast": 2, "lower_bound": 0, "upper_bound": 0, "distance": 4})


DAILY_SQL = f"""
day AS (SELECT user_id, ts::DATE AS d, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS r FROM events GROUP BY ALL),
c AS (SELECT max(ts)::DATE - 14 AS cut FROM events),
f AS (SELECT user_id, dayofweek(d) AS dow, avg(r) AS m, var_samp(r) AS v, count(*) AS n FROM day, c WHERE d < cut GROUP BY ALL),
p AS (SELECT user_id, CASE WHEN sum(n - 1) = 0 THEN NULL ELSE sqrt(sum(v * (n - 1)) / sum(n - 1)) END AS sd FROM f GROUP BY 1),
fm AS (SELECT user_id, sum(m * n) / sum(n) AS um FROM f GROUP BY 1),
rec AS (SELECT day.user_id, d AS ts, r AS y, CASE WHEN m IS NOT NULL THEN 'season' WHEN um IS NOT NULL THEN 'series' ELSE 'none' END AS basis,
  coalesce(m, um) AS forecast, sd FROM day CROSS JOIN c LEFT JOIN f ON f.user_id = day.user_id AND f.dow = dayofweek(d)
  LEFT JOIN p ON p.user_id = day.user_id LEFT JOIN fm ON fm.user_id = day.user_id WHERE d >= cut),
found AS (SELECT user_id, ts, y, basis, forecast, forecast - {Z99} * coalesce(sd, 0) AS lower_bound,
  forecast + {Z99} * coalesce(sd, 0) AS upper_bound,
  CASE WHEN forecast IS NULL THEN NULL WHEN coalesce(sd, 0) = 0 THEN 0 ELSE (y - forecast) / sd END AS distance FROM rec)"""


def daily_error_share(t: Tables) -> DataFrame:
    share = F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0))
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(share.alias("rate"))


def error_findings(t: Tables) -> DataFrame:
    end = t.latest("events", "ts").replace(hour=0, minute=0, second=0, microsecond=0)
    return detect_anomalies(daily_error_share(t), ["user_id"], "day", "rate", end - timedelta(days=14),
                            season=sunday_zero_weekday(F.col("day")), interval=0.99)


ROUND_FOUND = {"y": 6, "forecast": 6, "lower_bound": 6, "upper_bound": 6, "distance": 4}


@query("anomaly_many_series", "M12 I9", f"""
WITH {DAILY_SQL} SELECT user_id, ts, round(y, 6) AS y, basis, round(forecast, 6) AS forecast, round(lower_bound, 6) AS lower_bound,
 round(upper_bound, 6) AS upper_bound, round(distance, 4) AS distance, (y < lower_bound OR y > upper_bound) AS is_anomaly FROM found""")
def anomaly_many_series(t):
    return rounded(error_findings(t), ROUND_FOUND)


def flagged(t: Tables) -> DataFrame:
    """Flagged rows with the context of their customer."""
    who = t.customer.join(md.geography(t), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"), F.col("n_name").alias("metro"),
        F.col("r_name").alias("region"), F.col("c_mktsegment").alias("store_format"))
    return error_findings(t).filter("is_anomaly").join(who, "user_id")


ENRICHED_SQL = DAILY_SQL + """,
enriched AS (SELECT found.*, n_name AS metro, r_name AS region, c_mktsegment AS store_format FROM found
  JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE y < lower_bound OR y > upper_bound)"""


@query("anomaly_top_flagged", "M12 G2 D1", f"""
WITH {ENRICHED_SQL} SELECT user_id, region, metro, store_format, ts AS on_date, round(y, 3) AS actual_rate,
 round(forecast, 3) AS expected_rate, round(distance, 2) AS anomaly_distance FROM enriched
ORDER BY round(distance, 2) DESC, user_id, ts LIMIT 20""")
def anomaly_top_flagged(t):
    return flagged(t).select(
        "user_id", "region", "metro", "store_format", F.col("ts").alias("on_date"),
        F.round("y", 3).alias("actual_rate"), F.round("forecast", 3).alias("expected_rate"),
        F.round("distance", 2).alias("anomaly_distance")).orderBy(
        F.desc("anomaly_distance"), "user_id", "on_date").limit(20)


RETURNS_SQL = """
cut AS (SELECT max(l_shipdate) - INTERVAL 250 DAY AS c FROM lineitem),
ret AS (SELECT l_extendedprice::DECIMAL(12,2) AS m, l_shipdate >= c AS label, p_type, p_brand, n_name AS metro, r_name AS region, l_suppkey AS store
  FROM lineitem CROSS JOIN cut JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE l_returnflag = 'R'),
tot AS (SELECT sum(m) FILTER (WHERE NOT label)::DOUBLE AS tc, sum(m) FILTER (WHERE label)::DOUBLE AS tt FROM ret),
seg AS (SELECT concat_ws(' & ', 'region=' || region, 'metro=' || metro, 'store=' || store, 'p_type=' || p_type, 'p_brand=' || p_brand) AS segment,
   coalesce(sum(m) FILTER (WHERE NOT label), 0)::DOUBLE AS mc, coalesce(sum(m) FILTER (WHERE label), 0)::DOUBLE AS mt FROM ret
   GROUP BY CUBE (region, metro, store, p_type, p_brand) HAVING grouping_id(region, metro, store, p_type, p_brand) < 31),
drv AS (SELECT segment, mc, mt, mt - mc AS contribution, (mt - mc) / (tt - tc) AS rel, (mt - mc) / nullif(mc, 0) AS gr,
   mt - mc * (tt / tc) AS surprise FROM seg, tot)"""


def return_rows(t: Tables) -> DataFrame:
    """Returned lines: refund, dimensions and the test-window label."""
    cut = t.latest("lineitem", "l_shipdate") - timedelta(days=250)
    stores = t.supplier.join(md.geography(t), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("metro"), F.col("r_name").alias("region"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return (t.lineitem.filter("l_returnflag = 'R'")
            .select("l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("metric"),
                    (F.col("l_shipdate") >= ntz(cut)).alias("label"))
            # One row per (store, part, label) before the dimension joins.
            .groupBy("l_suppkey", "l_partkey", "label").agg(F.sum("metric").alias("metric"))
            .join(stores, "l_suppkey").join(parts, "l_partkey").withColumnRenamed("l_suppkey", "store"))


DRIVER_DIMS = ["region", "metro", "store", "p_type", "p_brand"]


def return_drivers(t: Tables) -> DataFrame:
    found = key_drivers(return_rows(t), "metric", "label", DRIVER_DIMS)
    return found.withColumns({c: F.col(c).cast("double") for c in (
        "metric_control", "metric_test", "contribution", "surprise")})


@query("driver_segments", "M13", f"""
WITH {RETURNS_SQL} SELECT segment, mc AS metric_control, mt AS metric_test, round(contribution, 2) AS contribution,
 round(rel, 6) AS relative_contribution, round(gr, 6) AS growth_rate, round(surprise, 0) AS surprise FROM drv""")
def driver_segments(t):
    return rounded(return_drivers(t), {"contribution": 2, "relative_contribution": 6, "growth_rate": 6, "surprise": 0})


@query("driver_top_ranked", "M13 G2", f"""
WITH {RETURNS_SQL} SELECT segment, round(surprise, 0) AS surprise,
 row_number() OVER (ORDER BY round(abs(surprise), 0) DESC, segment)::INT AS rank FROM drv
ORDER BY round(abs(surprise), 0) DESC, segment LIMIT 25""")
def driver_top_ranked(t):
    return rounded(ranked_drivers(return_drivers(t), 25).select("segment", "surprise", "rank"), {"surprise": 0})


WIDE_DIMS = [*DRIVER_DIMS, "p_size", "p_name"]
WIDE_SQL = (RETURNS_SQL.replace("p_type, p_brand, n_name", "p_type, p_brand, p_size, p_name, n_name")
            .replace("'p_brand=' || p_brand)", "'p_brand=' || p_brand, 'p_size=' || p_size, 'p_name=' || p_name)")
            .replace("(region, metro, store, p_type, p_brand)", "(region, metro, store, p_type, p_brand, p_size, p_name)")
            .replace("< 31", "< 127"))


@query("driver_search_wide", "M13 G2", f"""
WITH {WIDE_SQL} SELECT segment, round(surprise, 0) AS surprise,
 row_number() OVER (ORDER BY round(abs(surprise), 0) DESC, segment)::INT AS rank FROM drv
ORDER BY round(abs(surprise), 0) DESC, segment LIMIT 25""")
def driver_search_wide(t):
    sizes = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_name")
    found = top_drivers(return_rows(t).join(sizes, "l_partkey"), "metric", "label", WIDE_DIMS, 25)
    return rounded(found.select("segment", F.col("surprise").cast("double").alias("surprise"), "rank"), {"surprise": 0})


@query("driver_lapse_rate", "M13", f"""
WITH {BASE_SQL}, b AS (SELECT *, tenure_days < 1500 AS label FROM base),
 s AS (SELECT concat_ws(' & ', 'region=' || region, 'donor_segment=' || donor_segment) AS segment,
   coalesce(sum(is_lapsed) FILTER (WHERE NOT label), 0)::DOUBLE AS mc, coalesce(sum(is_lapsed) FILTER (WHERE label), 0)::DOUBLE AS mt
   FROM b GROUP BY GROUPING SETS ((region), (donor_segment), (region, donor_segment)))
SELECT segment, mc AS metric_control, mt AS metric_test, mt - mc AS contribution FROM s""")
def driver_lapse_rate(t):
    rows = training(t).select("region", "donor_segment", F.col("is_lapsed").cast("double").alias("metric"),
                              (F.col("tenure_days") < 1500).alias("label"))
    return key_drivers(rows, "metric", "label", ["region", "donor_segment"]).select(
        "segment", "metric_control", "metric_test", "contribution")


def briefing(flagged_rows: DataFrame, drivers: DataFrame, generated_at: str) -> DataFrame:
    """One JSON cell with the top 10 flagged rows and the top 15 drivers."""
    top = flagged_rows.withColumn("_d", F.round("distance", 2)).orderBy(F.desc("_d"), "user_id", "ts").limit(10)
    stores = F.array_sort(F.collect_list(F.struct(
        (-F.col("_d")).alias("o"), "user_id", "ts",
        F.struct("user_id", "metro", "region", F.round("y", 3).alias("actual_rate"),
                 F.round("forecast", 3).alias("expected_rate")).alias("v"))))
    causes = F.array_sort(F.collect_list(F.struct(
        "rank", F.struct("segment", F.round("surprise", 0).cast("long").alias("surprise")).alias("v"))))
    spark = flagged_rows.sparkSession
    return spark.range(1).select(F.to_json(F.struct(
        F.lit(generated_at).alias("generated_at"),
        top.agg(F.transform(stores, lambda x: x["v"])).scalar().alias("flagged_stores"),
        drivers.agg(F.transform(causes, lambda x: x["v"])).scalar().alias("top_drivers"),
    )).alias("briefing_json"))


@query("proactive_briefing", "M21 R3 G3 J7 E5", f"""
WITH {ENRICHED_SQL}, {RETURNS_SQL},
 a AS (SELECT *, row_number() OVER (ORDER BY round(distance, 2) DESC, user_id, ts) AS rn FROM enriched),
 b AS (SELECT *, row_number() OVER (ORDER BY round(abs(surprise), 0) DESC, segment) AS rn FROM drv)
SELECT to_json({{'generated_at': (SELECT strftime(max(ts), '%Y-%m-%d') FROM events),
  'flagged_stores': (SELECT list({{'user_id': user_id, 'metro': metro, 'region': region, 'actual_rate': round(y, 3),
      'expected_rate': round(forecast, 3)}} ORDER BY rn) FROM a WHERE rn <= 10),
  'top_drivers': (SELECT list({{'segment': segment, 'surprise': round(surprise, 0)::BIGINT}} ORDER BY rn) FROM b WHERE rn <= 15)}})::VARCHAR AS briefing_json""")
def proactive_briefing(t):
    when = t.latest("events", "ts").date().isoformat()
    return briefing(flagged(t), ranked_drivers(return_drivers(t), 15), when)


# ---- scores, drift, quality ----------------------------------------------------------

SCORE_WEIGHTS = {"recency_days": 0.004, "frequency_last_12m": -0.35, "engagement_last_6m": -0.05,
                 "tenure_days": -0.0002}
SCORE_BIAS = -0.6
SCORE_SQL = ("1 / (1 + exp(-(-0.6 + recency_days * 0.004 + frequency_last_12m * -0.35 "
             "+ engagement_last_6m * -0.05 + tenure_days * -0.0002)))")


def scorecard(df: DataFrame) -> DataFrame:
    """Transparent logistic score over the training base."""
    z = F.lit(SCORE_BIAS)
    for name, weight in SCORE_WEIGHTS.items():
        z = z + F.col(name) * weight
    return df.withColumn("pred_lapse", (1 / (1 + F.exp(-z))).cast("decimal(10,6)").cast("double"))


def scoring_log(t: Tables) -> DataFrame:
    """Score, actual and time per customer; the time is spread over 30 days by key."""
    end = md.churn_as_of(t)
    offset = F.make_dt_interval(days=F.pmod("c_custkey", F.lit(30)).cast("int"))
    return scorecard(training(t)).withColumn("scored_at", ntz(end) - offset).withColumn(
        "predicted", (F.col("pred_lapse") >= 0.5).cast("int"))


LOG_SQL = BASE_SQL + f""",
log AS (SELECT base.*, ({SCORE_SQL})::DECIMAL(10,6)::DOUBLE AS pred_lapse, a - INTERVAL 1 DAY * (c_custkey % 30) AS scored_at,
  CASE WHEN ({SCORE_SQL})::DECIMAL(10,6)::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS predicted FROM base CROSS JOIN cut)"""


@query("scoring_log", "M14 D3", f"""
WITH {LOG_SQL} SELECT c_custkey, region, scored_at::DATE AS scored_on, pred_lapse, is_lapsed AS actual_lapse, predicted FROM log""")
def scoring_log_rows(t):
    return scoring_log(t).select("c_custkey", "region", F.to_date("scored_at").alias("scored_on"), "pred_lapse",
                                 F.col("is_lapsed").alias("actual_lapse"), "predicted")


@query("drift_daily", "M15", f"""
WITH {LOG_SQL} SELECT scored_at::DATE AS window_start, round(avg(pred_lapse), 11) AS mean_score, count(*) AS n,
 round((SELECT avg(pred_lapse) FROM log), 11) AS baseline_mean, round(avg(pred_lapse) - (SELECT avg(pred_lapse) FROM log), 11) AS difference_of_means
FROM log GROUP BY 1""")
def drift_daily(t):
    log = scoring_log(t)
    out = mon.drift_of_means(log, log, "pred_lapse", "scored_at")
    out = out.withColumn("window_start", F.to_date("window_start"))
    return rounded(out, {"mean_score": 11, "baseline_mean": 11, "difference_of_means": 11})


@query("drift_by_region", "M16", f"""
WITH {LOG_SQL}, b AS (SELECT region, avg(pred_lapse) AS bm FROM log GROUP BY 1)
SELECT scored_at::DATE AS window_start, region, round(avg(pred_lapse), 11) AS mean_score, count(*) AS n,
 round(any_value(bm), 11) AS baseline_mean, round(avg(pred_lapse) - any_value(bm), 11) AS difference_of_means
FROM log JOIN b USING (region) GROUP BY 1, 2""")
def drift_by_region(t):
    log = scoring_log(t)
    out = mon.drift_of_means(log, log, "pred_lapse", "scored_at", ["region"])
    out = out.withColumn("window_start", F.to_date("window_start"))
    return rounded(out, {"mean_score": 11, "baseline_mean": 11, "difference_of_means": 11})


def stored_baseline(t: Tables) -> DataFrame:
    """Scores of the customers of an even key, stored before anything is logged."""
    return replace_table(scorecard(training(t)).filter(F.pmod("c_custkey", F.lit(2)) == 0).select("region", "pred_lapse"),
                         scratch_path(t.spark, "baseline"))


STORED_SQL = LOG_SQL + """,
base_scores AS (SELECT region, pred_lapse FROM log WHERE c_custkey % 2 = 0), later AS (SELECT * FROM log WHERE c_custkey % 2 <> 0)"""


@query("drift_from_stored_baseline", "M14 M15 M16", f"""
WITH {STORED_SQL}, b AS (SELECT region, avg(pred_lapse) AS bm FROM base_scores GROUP BY 1)
SELECT scored_at::DATE + 30 AS window_start, region, round(avg(pred_lapse), 11) AS mean_score, count(*) AS n,
 round(any_value(bm), 11) AS baseline_mean, round(avg(pred_lapse) - any_value(bm), 11) AS difference_of_means
FROM later JOIN b USING (region) GROUP BY 1, 2""")
def drift_from_stored_baseline(t):
    """A stored snapshot against the other customers, scored a month later."""
    baseline = stored_baseline(t)
    later = scoring_log(t).filter(F.pmod("c_custkey", F.lit(2)) != 0).withColumn(
        "scored_at", F.col("scored_at") + F.expr("INTERVAL 30 DAYS"))
    out = mon.drift_of_means(later, baseline, "pred_lapse", "scored_at", ["region"])
    return rounded(out.withColumn("window_start", F.to_date("window_start")),
                   {"mean_score": 11, "baseline_mean": 11, "difference_of_means": 11})


F1_SQL = f"""
WITH {LOG_SQL}, c AS (SELECT scored_at::DATE AS day, count(*) AS n, count(*) FILTER (WHERE is_lapsed = 1 AND predicted = 1) AS tp,
  count(*) FILTER (WHERE is_lapsed = 0 AND predicted = 1) AS fp, count(*) FILTER (WHERE is_lapsed = 1 AND predicted = 0) AS fn
  FROM log GROUP BY 1)"""


def daily_quality(t: Tables) -> DataFrame:
    return mon.classification_report(scoring_log(t), "is_lapsed", "predicted", [F.to_date("scored_at").alias("day")])


@query("quality_daily", "M17", F1_SQL + """ SELECT day, n, round(tp / nullif(tp + fp, 0), 6) AS precision,
  round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""")
def quality_daily(t):
    return rounded(daily_quality(t), {"precision": 6, "recall": 6, "f1": 6})


@query("quality_alert", "M17 C10", F1_SQL + """ SELECT coalesce(bool_or(2 * tp / nullif(2 * tp + fp + fn, 0) < 0.8), false) AS alert,
  count(*) FILTER (WHERE 2 * tp / nullif(2 * tp + fp + fn, 0) < 0.8) AS windows_below FROM c""")
def quality_alert(t):
    return mon.performance_alert(daily_quality(t), "f1", 0.80)


@query("confusion_matrix", "M6", f"""
WITH {LOG_SQL} SELECT is_lapsed AS actual, predicted, count(*) AS n FROM log GROUP BY ALL""")
def confusion(t):
    return mon.confusion_matrix(scoring_log(t), "is_lapsed", "predicted")


@query("auc_exact", "M5", f"""
WITH {LOG_SQL}, s AS (SELECT pred_lapse, count(*) FILTER (WHERE is_lapsed = 1) AS p, count(*) FILTER (WHERE is_lapsed = 0) AS n FROM log GROUP BY 1),
 r AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY pred_lapse ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM r""")
def auc_exact(t):
    return rounded(mon.auc(scoring_log(t), "is_lapsed", "pred_lapse"), {"auc": 6})


@query("linear_attribution", "M8", f"""
WITH {BASE_SQL}, m AS (SELECT avg(recency_days) AS r, avg(frequency_last_12m) AS f, avg(engagement_last_6m) AS e, avg(tenure_days) AS t FROM base)
SELECT c_custkey, round(0.004 * (recency_days - r), 6) AS phi_recency_days, round(-0.35 * (frequency_last_12m - f), 6) AS phi_frequency_last_12m,
 round(-0.05 * (engagement_last_6m - e), 6) AS phi_engagement_last_6m, round(-0.0002 * (tenure_days - t), 6) AS phi_tenure_days FROM base, m""")
def linear_attribution_query(t):
    return linear_attribution(training(t), "c_custkey", SCORE_WEIGHTS)


def linear_attribution(df: DataFrame, key: str, weights: dict[str, float]) -> DataFrame:
    """Exact Shapley values of a linear score: weight × (value − mean)."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in weights])).scalar()
    held = df.select(key, *weights, means.alias("_mean"))
    return held.select(key, *[
        F.round(F.lit(w) * (F.col(c) - F.col(f"_mean.{c}")), 6).alias(f"phi_{c}") for c, w in weights.items()])


ACTION_SQL = ("CASE WHEN recency_days > 400 THEN 'personal call' WHEN frequency_last_12m = 0 THEN 'win-back appeal' "
              "WHEN engagement_last_6m = 0 THEN 'event invitation' ELSE 'thank-you note' END")
# The two features that move a customer's score most, with what they add to it.
DRIVER_SQL = ("array_to_string(list_transform(list_reverse_sort(["
              + ", ".join(f"{{'size': abs(round({n} * {w}, 2)), 'name': '{n}', 'adds': round({n} * {w}, 2)}}"
                          for n, w in SCORE_WEIGHTS.items())
              + "])[1:2], lambda d: d.name || format(' {:+.2f}', d.adds)), ', ')")


def driver_text(weights: dict[str, float], n: int = 2) -> Column:
    """The ``n`` largest contributions ``weight × value`` of a row, as text."""
    def adds(name: str, weight: float) -> Column:
        return F.round(F.col(name) * weight, 2)

    parts = F.array(*[F.struct(F.abs(adds(f, w)).alias("size"), F.lit(f).alias("name"), adds(f, w).alias("adds"))
                      for f, w in weights.items()])
    top = F.slice(F.sort_array(parts, asc=False), 1, n)
    return F.array_join(F.transform(top, lambda d: F.concat(d["name"], F.format_string(" %+.2f", d["adds"]))), ", ")




def scored_customers(t: Tables) -> DataFrame:
    return scorecard(training(t)).withColumns({
        "churn_probability": F.round("pred_lapse", 4),
        "risk_drivers": driver_text(SCORE_WEIGHTS), "recommended_action": F.expr(ACTION_SQL)})


def top_risk(scored: DataFrame, segment: str, n: int) -> DataFrame:
    """Highest-risk customers of a segment as one JSON array."""
    top = scored.filter(F.col("donor_segment") == segment).orderBy(F.desc("pred_lapse"), "c_custkey").limit(n)
    items = F.array_sort(F.collect_list(F.struct(
        (-F.col("pred_lapse")).alias("o"), "c_custkey", F.struct(
            "c_custkey", "region", "churn_probability", "risk_drivers", "recommended_action").alias("v"))))
    return top.agg(F.to_json(F.transform(items, lambda x: x["v"])).alias("top_risk"))


@query("top_risk_json", "M19 R1 F2 E5", f"""
WITH {LOG_SQL}, r AS (SELECT * FROM log WHERE donor_segment = 'MACHINERY' ORDER BY pred_lapse DESC, c_custkey LIMIT 5)
SELECT to_json(list({{'c_custkey': c_custkey, 'region': region, 'churn_probability': round(pred_lapse, 4),
 'risk_drivers': {DRIVER_SQL}, 'recommended_action': {ACTION_SQL}}} ORDER BY pred_lapse DESC, c_custkey))::VARCHAR AS top_risk FROM r""")
def top_risk_json(t):
    return top_risk(scored_customers(t), "MACHINERY", 5)


@query("one_customer_risk", "M20 R2", f"""
WITH {LOG_SQL} SELECT c_custkey, round(pred_lapse, 4) AS churn_probability, {DRIVER_SQL} AS risk_drivers FROM log WHERE c_custkey = 42""")
def one_customer_risk(t):
    return scored_customers(t).filter("c_custkey = 42").select(
        "c_custkey", F.round("pred_lapse", 4).alias("churn_probability"), "risk_drivers")


@query("top_scores", "G2 M9", f"""
WITH {LOG_SQL} SELECT c_custkey, round(pred_lapse, 4) AS churn_probability FROM log ORDER BY pred_lapse DESC, c_custkey LIMIT 10""")
def top_scores(t):
    return scored_customers(t).orderBy(F.desc("pred_lapse"), "c_custkey").limit(10).select(
        "c_custkey", F.round("pred_lapse", 4).alias("churn_probability"))
