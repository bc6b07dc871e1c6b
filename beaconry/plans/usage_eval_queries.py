"""Usage and cost analytics (O) and evaluation analytics (P)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions.sampling import stable_bucket
from beaconry.operators import evals as ev
from beaconry.operators import usage as us
from beaconry.plans import models as md
from beaconry.plans.registry import query
from beaconry.plans.relational_queries import md5_bucket, optional_filter
from beaconry.session import Tables, rounded, values

# Illustrative credits per million tokens and price per credit.
RATES = [("llama-small", 0.19), ("llama-medium", 1.21), ("frontier", 2.55)]
USD_PER_CREDIT = 3.0

USAGE_SQL = """
h AS (SELECT ts AS start_time, event_id // 3 AS query_id, user_id, event_type AS function_name,
  CASE user_id % 3 WHEN 0 THEN 'llama-small' WHEN 1 THEN 'llama-medium' ELSE 'frontier' END AS model_name,
  value AS credits, (props->>'$.k')::BIGINT AS tokens, event_id % 3 = 2 AND (event_id // 3) % 10 <> 0 AS is_completed,
  'team:t' || (user_id % 4)::VARCHAR || ';project:p' || (event_id % 2)::VARCHAR AS query_tag FROM events)"""


def usage(t: Tables) -> DataFrame:
    """Usage history from the event stream; three rows make one query."""
    user, event = F.col("user_id"), F.col("event_id")
    query_id = F.floor(event / 3)
    model = F.get(F.array(*[F.lit(n) for n, _ in RATES]), F.pmod(user, F.lit(3)).cast("int"))
    return t.events.select(
        F.col("ts").alias("start_time"), query_id.alias("query_id"), "user_id",
        F.col("event_type").alias("function_name"), model.alias("model_name"), F.col("value").alias("credits"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("tokens"),
        ((F.pmod(event, F.lit(3)) == 2) & (F.pmod(query_id, F.lit(10)) != 0)).alias("is_completed"),
        F.concat(F.lit("team:t"), F.pmod(user, F.lit(4)).cast("string"), F.lit(";project:p"),
                 F.pmod(event, F.lit(2)).cast("string")).alias("query_tag"))


def users(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))


@query("usage_daily_credits", "O1 E12 E3", f"""
WITH {USAGE_SQL} SELECT start_time::DATE AS usage_date, function_name, model_name, round(sum(credits), 2) AS total_credits,
 count(DISTINCT query_id) AS query_count FROM h WHERE start_time >= (SELECT max(start_time) FROM h) - INTERVAL 30 DAY GROUP BY ALL""")
def usage_daily_credits(t):
    return rounded(us.daily_credits(usage(t), t.latest("events", "ts")), {"total_credits": 2})


@query("usage_monthly_consumers", "O2 D1", f"""
WITH {USAGE_SQL} SELECT user_id, c_name AS user_name, date_trunc('month', start_time)::DATE AS usage_month,
 round(sum(credits), 2) AS total_credits, count(DISTINCT query_id) AS query_count FROM h JOIN customer ON c_custkey = user_id
WHERE start_time >= (SELECT max(start_time) FROM h) - INTERVAL 3 MONTH GROUP BY ALL""")
def usage_monthly_consumers(t):
    return rounded(us.monthly_consumers(usage(t), users(t), t.latest("events", "ts")), {"total_credits": 2})


@query("usage_still_running", "O3 E4 E7 E8 D2", f"""
WITH {USAGE_SQL}, q AS (SELECT query_id, min(user_id) AS user_id, string_agg(DISTINCT function_name, ', ' ORDER BY function_name) AS functions,
  sum(credits) AS c, min(start_time) AS started_at FROM h WHERE start_time >= (SELECT max(start_time) FROM h) - INTERVAL 48 HOUR
  GROUP BY 1 HAVING NOT bool_or(is_completed))
SELECT user_id, query_id, functions, round(c, 2) AS credits_so_far, started_at, c_name AS user_name FROM q LEFT JOIN customer ON c_custkey = user_id""")
def usage_still_running(t):
    return rounded(us.still_running(usage(t), users(t), t.latest("events", "ts")), {"credits_so_far": 2})


@query("token_counts", "N27", """
SELECT count(*) AS rows_to_process, sum(ceil(length(text) / 4))::BIGINT AS total_input_tokens,
 floor(avg(ceil(length(text) / 4)))::BIGINT AS avg_tokens_per_row, max(ceil(length(text) / 4))::BIGINT AS max_tokens_per_row FROM documents""")
def token_counts(t):
    return us.token_estimate(t.documents, "text")


@query("cost_projection", "O4 A16", """
WITH n AS (SELECT sum(ceil(length(text) / 4))::BIGINT AS total_input_tokens FROM documents),
 r(model_name, rate) AS (VALUES ('llama-small', 0.19), ('llama-medium', 1.21), ('frontier', 2.55))
SELECT model_name, rate::DOUBLE AS credits_per_1m_tokens, total_input_tokens, round(total_input_tokens / 1000000 * rate, 4) AS projected_credits,
 round(total_input_tokens / 1000000 * rate * 3, 4) AS projected_usd FROM r, n""")
def cost_projection(t):
    rates = values(t.spark, RATES, "model_name, credits_per_1m_tokens")
    return rounded(us.project_cost(t.documents, "text", rates, USD_PER_CREDIT),
                   {"projected_credits": 4, "projected_usd": 4})


@query("cost_empirical_rates", "O5 E9", f"""
WITH {USAGE_SQL} SELECT model_name, sum(tokens)::BIGINT AS tokens, round(sum(credits), 2) AS token_credits,
 round(sum(credits) / nullif(sum(tokens), 0) * 1e6, 2) AS credits_per_1m_tokens FROM h WHERE tokens > 0 AND function_name ILIKE '%PURCH%' GROUP BY 1""")
def cost_empirical_rates(t):
    return rounded(us.empirical_rates(usage(t), "%PURCH%"), {"token_credits": 2, "credits_per_1m_tokens": 2})


@query("cost_reconciled", "O5 R6", f"""
WITH {USAGE_SQL}, n AS (SELECT count(*) AS rows_to_process, sum(ceil(length(text) / 4))::BIGINT AS total_input_tokens FROM documents),
 r AS (SELECT sum(credits) / nullif(sum(tokens), 0) * 1e6 AS rate FROM h WHERE model_name = 'frontier' AND tokens > 0)
SELECT 'frontier' AS model, rows_to_process, total_input_tokens, round(rate, 2) AS credits_per_1m_tokens,
 round(total_input_tokens / 1000000 * rate, 2) AS projected_credits, round(total_input_tokens / 1000000 * rate * 3, 2) AS projected_usd FROM n, r
UNION ALL SELECT 'unknown', rows_to_process, total_input_tokens, NULL, NULL, NULL FROM n""")
def cost_reconciled(t):
    def one(model: str) -> DataFrame:
        return us.estimate_cost(t.documents, "text", model, usage(t), USD_PER_CREDIT).withColumn("model", F.lit(model))

    return rounded(one("frontier").unionByName(one("unknown")),
                   {"credits_per_1m_tokens": 2, "projected_credits": 2, "projected_usd": 2})


@query("budget_monthly_alert", "O6 E4 C10", """
SELECT round(coalesce(sum(value), 0), 2) AS spend, coalesce(sum(value), 0) > 500 AS alert FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'""")
def budget_monthly_alert(t):
    month = t.latest("events", "ts").replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return rounded(us.monthly_budget_alert(usage(t), month, 500), {"spend": 2})


@query("budget_users_over", "O7", f"""
WITH {USAGE_SQL}, d AS (SELECT user_id, start_time::DATE AS day, sum(credits) AS s FROM h GROUP BY ALL),
 m AS (SELECT user_id, date_trunc('month', day)::DATE AS month, sum(s) AS ms, count(*) FILTER (WHERE s > 400) AS days_over FROM d GROUP BY ALL)
SELECT user_id, month, round(ms, 2) AS month_spend, days_over, ms > 3600 AS over_month FROM m WHERE ms > 3600 OR days_over > 0""")
def budget_users_over(t):
    return rounded(us.users_over_limits(usage(t), 3600, 400), {"month_spend": 2})


@query("usage_by_tag", "O8", f"""
WITH {USAGE_SQL} SELECT regexp_extract(query_tag, 'team:([^;]*)', 1) AS team, round(sum(credits), 2) AS credits, count(*) AS calls FROM h GROUP BY 1""")
def usage_by_tag(t):
    return rounded(us.spend_by_tag(usage(t), "team"), {"credits": 2})


# ---- evaluations ---------------------------------------------------------------------

# Names of the evaluation metrics.
METRICS = ["answer_correctness", "tool_selection_accuracy", "logical_consistency", "routing_quality"]
TOOLS = {"single_tool": ["mail_scorer"], "multi_tool": ["mail_scorer", "mail_coach"], "refusal": []}
PROCESS = "CASE WHEN toxic = 1 THEN 'refusal' WHEN doc_id % 4 = 0 THEN 'multi_tool' ELSE 'single_tool' END"
INTENT = "CASE WHEN toxic = 1 THEN 'out_of_scope' WHEN quality = 1 THEN 'score_email' ELSE 'coach_email' END"
TRUTH_SQL = f"truth AS (SELECT doc_id AS input, {PROCESS} AS process, {INTENT} AS intent FROM labels)"
SCORES_SQL = TRUTH_SQL + ", sc AS (" + " UNION ALL ".join(
    f"SELECT input, '{run}' AS run_name, '{m}' AS metric_name, least({md5_bucket('input', run + m, 101)} + {lift}, 100) / 100.0::DOUBLE AS score, "
    f"process, intent FROM truth"
    for run, lift in (("baseline-v1", 0), ("improved-v2", 12)) for m in METRICS) + ")"


def truth(t: Tables) -> DataFrame:
    """One JSON ground-truth document per labelled input."""
    calls = F.when(F.expr(PROCESS) == "multi_tool", F.array(*[F.struct(F.lit(n).alias("tool_name")) for n in TOOLS["multi_tool"]]))
    calls = calls.when(F.expr(PROCESS) == "single_tool", F.array(F.struct(F.lit("mail_scorer").alias("tool_name"))))
    return t.labels.select(
        F.col("doc_id").alias("input"),
        F.to_json(F.struct(calls.alias("ground_truth_invocations"), F.expr(INTENT).alias("intent"),
                           F.expr(PROCESS).alias("process"))).alias("ground_truth"))


def scores(t: Tables) -> DataFrame:
    """Scores of two runs, fixed by a hash of (input, run, metric)."""
    runs = []
    for run, lift in (("baseline-v1", 0), ("improved-v2", 12)):
        for metric in METRICS:
            raw = F.least(stable_bucket(F.col("doc_id"), run + metric, 101) + lift, F.lit(100)) / 100
            runs.append(F.struct(F.lit(run).alias("run_name"), F.lit(metric).alias("metric_name"), raw.alias("score")))
    return t.labels.select(F.col("doc_id").alias("input"), F.inline(F.array(*runs)))


ROUND4 = {"avg_score": 4, "min_score": 4, "max_score": 4}


@query("eval_coverage", "P1 J1", f"WITH {TRUTH_SQL} SELECT process, intent, count(*) AS n FROM truth GROUP BY ALL")
def eval_coverage(t):
    return ev.coverage(truth(t))


@query("eval_metric_summary", "P2 E17", f"""
WITH {SCORES_SQL} SELECT metric_name, count(*) AS num_records, round(avg(score), 4) AS avg_score, min(score) AS min_score, max(score) AS max_score
FROM sc WHERE run_name = 'baseline-v1' GROUP BY 1""")
def eval_metric_summary(t):
    return rounded(ev.run_summary(scores(t).filter("run_name = 'baseline-v1'"), ["metric_name"]), ROUND4)


@query("eval_lowest_with_reason", "P3 J2 G2", f"""
WITH {SCORES_SQL} SELECT input, metric_name, score, 'score below ' || (ceil(score * 10) / 10)::DECIMAL(3,1)::VARCHAR AS explanation
FROM sc WHERE run_name = 'baseline-v1' ORDER BY score, input, metric_name LIMIT 8""")
def eval_lowest_with_reason(t):
    bound = (F.ceil(F.col("score") * 10) / 10).cast("decimal(3,1)").cast("string")
    calls = F.parse_json(F.to_json(F.array(F.struct(F.concat(F.lit("score below "), bound).alias("explanation")))))
    low = scores(t).filter("run_name = 'baseline-v1'").orderBy("score", "input", "metric_name").limit(8)
    return low.select("input", "metric_name", "score",
                      F.variant_get(calls, "$[0].explanation", "string").alias("explanation"))


@query("eval_pivot", "P4 E13", f"""
WITH {SCORES_SQL} SELECT process, intent, """ + ", ".join(
    f"round(avg(CASE WHEN metric_name = '{m}' THEN score END), 4) AS {m}" for m in METRICS) + """
FROM sc WHERE run_name = 'baseline-v1' GROUP BY ALL""")
def eval_pivot(t):
    out = ev.metric_pivot(scores(t).filter("run_name = 'baseline-v1'"), truth(t), METRICS)
    return rounded(out, {m: 4 for m in METRICS})


DIFF3 = {"baseline": 4, "candidate": 4, "delta": 4}


@query("eval_run_comparison", "P5 D11", f"""
WITH {SCORES_SQL}, b AS (SELECT metric_name, avg(score) AS s FROM sc WHERE run_name = 'baseline-v1' GROUP BY 1),
 i AS (SELECT metric_name, avg(score) AS s FROM sc WHERE run_name = 'improved-v2' GROUP BY 1)
SELECT metric_name, round(b.s, 4) AS baseline, round(i.s, 4) AS candidate, round(i.s - b.s, 4) AS delta FROM b JOIN i USING (metric_name)""")
def eval_run_comparison(t):
    return rounded(ev.compare_runs(scores(t), ["metric_name"], "baseline-v1", "improved-v2"), DIFF3)


@query("eval_drill_down", "P6 D11 C6", f"""
WITH {SCORES_SQL}, b AS (SELECT * FROM sc WHERE run_name = 'baseline-v1'), i AS (SELECT * FROM sc WHERE run_name = 'improved-v2')
SELECT b.process, metric_name, round(avg(b.score), 4) AS baseline, round(avg(i.score), 4) AS candidate, round(avg(i.score - b.score), 4) AS delta
FROM b JOIN i USING (input, metric_name) WHERE b.process IN ('refusal', 'multi_tool') GROUP BY ALL""")
def eval_drill_down(t):
    return rounded(ev.compare_scenarios(scores(t), truth(t), "baseline-v1", "improved-v2", ["refusal", "multi_tool"]), DIFF3)


RUN_TIMES = {"baseline-v1": datetime(2024, 1, 10), "improved-v2": datetime(2024, 1, 24)}


def score_history(t: Tables) -> DataFrame:
    """Rollup per run and metric, appended run by run."""
    parts = []
    for run, at in RUN_TIMES.items():
        rollup = rounded(ev.run_summary(scores(t).filter(F.col("run_name") == run), ["run_name", "metric_name"]), ROUND4)
        parts.append(rollup.withColumn("run_ts", F.lit(at.date())))
    return parts[0].unionByName(parts[1])


HISTORY_SQL = SCORES_SQL + """, hist AS (SELECT run_name, metric_name, count(*) AS num_records, round(avg(score), 4) AS avg_score, min(score) AS min_score,
  max(score) AS max_score, CASE run_name WHEN 'baseline-v1' THEN DATE '2024-01-10' ELSE DATE '2024-01-24' END AS run_ts FROM sc GROUP BY 1, 2)"""


@query("eval_history_append", "P7 A12", f"WITH {HISTORY_SQL} SELECT * FROM hist")
def eval_history_append(t):
    return score_history(t)


@query("eval_regression_status", "P8 F4 D10 C2", f"""
WITH {HISTORY_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY run_ts DESC, run_name DESC) AS rn FROM hist)
SELECT l.metric_name, l.avg_score AS latest, p.avg_score AS previous, round(l.avg_score - p.avg_score, 4) AS delta,
 CASE WHEN l.avg_score < p.avg_score - 0.05 THEN 'REGRESSION' WHEN l.avg_score > p.avg_score + 0.05 THEN 'IMPROVEMENT' ELSE 'STABLE' END AS status
FROM r l JOIN r p ON l.metric_name = p.metric_name AND p.rn = 2 WHERE l.rn = 1""")
def eval_regression_status(t):
    return rounded(ev.regression_status(score_history(t)), {"delta": 4})


@query("eval_tool_selection", "P9 J2", f"""
WITH {TRUTH_SQL}, c AS (SELECT process, input % 5 = 0 AS skipped FROM truth)
SELECT process, count(*) AS n, round(avg(CASE WHEN (process = 'refusal' AND NOT skipped) OR (process = 'single_tool' AND NOT skipped)
   OR (process = 'multi_tool' AND NOT skipped) THEN 1.0 ELSE 0.0 END), 4) AS tool_accuracy,
 sum(CASE WHEN process = 'single_tool' AND skipped THEN 1 WHEN process = 'multi_tool' AND skipped THEN 2 ELSE 0 END)::BIGINT AS missing,
 sum(CASE WHEN process <> 'refusal' AND skipped THEN 1 WHEN process = 'refusal' AND skipped THEN 1 ELSE 0 END)::BIGINT AS extra
FROM c GROUP BY 1""")
def eval_tool_selection(t):
    """Called tools: the expected ones, but every fifth input calls another tool instead."""
    log = truth(t).select(
        "input", ev.truth_field("process").alias("process"),
        F.coalesce(F.try_variant_get(F.try_parse_json("ground_truth"), "$.ground_truth_invocations",
                                     "array<struct<tool_name: string>>"), F.array()).alias("calls"))
    expected = F.col("calls")["tool_name"]
    called = F.when(F.pmod("input", F.lit(5)) == 0, F.array(F.lit("next_step"))).otherwise(expected)
    out = ev.tool_selection(log.select("process", expected.alias("expected"), called.alias("called")), "called", "expected")
    return out.groupBy("process").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("tools_match").cast("double")), 4).alias("tool_accuracy"),
        F.sum("missing_tools").alias("missing"), F.sum("extra_tools").alias("extra"))


# The issue categories. Their seed words are those of the test texts.
ISSUES = {"WRONG_ANSWER": ["idiot", "stupid"], "MISROUTED": ["pathetic"], "MISSING_CONTEXT": ["clown", "moron"],
          "FORMAT_ISSUE": ["trash"], "SCOPE_ERROR": ["scum", "worthless"]}
ISSUE_SQL = " ".join(f"WHEN {' OR '.join(f'lower(text) LIKE {chr(39)}%{w}%{chr(39)}' for w in words)} THEN '{name}'"
                     for name, words in ISSUES.items())


@query("eval_feedback_triage", "P10 N3 J1", f"""
SELECT CASE {ISSUE_SQL} ELSE 'OTHER' END AS issue_category, count(*) AS n
FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND text <> '' GROUP BY 1""")
def eval_feedback_triage(t):
    """Negative feedback messages sorted into issue categories by seed terms."""
    event = F.parse_json(F.to_json(F.struct((F.col("toxic") == 0).alias("positive"), F.col("text").alias("feedback_message"))))
    rows = t.documents.join(t.labels, "doc_id").select(event.alias("value"))
    message = F.lower(F.variant_get("value", "$.feedback_message", "string"))
    negative = rows.filter(~F.variant_get("value", "$.positive", "boolean") & (message != ""))
    category = F.coalesce(*[F.when(message.rlike("|".join(words)), name) for name, words in ISSUES.items()], F.lit("OTHER"))
    return negative.groupBy(category.alias("issue_category")).agg(F.count("*").alias("n"))


@query("eval_recent_spans", "P11 J3 G2", """
SELECT ts, event_type AS span, 'agent-' || (user_id % 3)::VARCHAR AS agent FROM events ORDER BY ts DESC, event_id DESC LIMIT 15""")
def eval_recent_spans(t):
    agent = F.concat(F.lit("agent-"), F.pmod("user_id", F.lit(3)).cast("string"))
    attributes = F.parse_json(F.to_json(F.struct(agent.alias("ai.agent.name"))))
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(15).select(
        "ts", F.col("event_type").alias("span"),
        F.variant_get(attributes, "$['ai.agent.name']", "string").alias("agent"))


@query("eval_data_checks", "P12 E10", f"""
WITH {SCORES_SQL}
SELECT 'customers_positive' AS check_name, CASE WHEN (SELECT count(*) FROM customer) > 0 THEN 'PASS' ELSE 'FAIL' END AS result
UNION ALL SELECT 'orders_per_customer_2_to_50', CASE WHEN (SELECT count(*) FROM orders) / (SELECT count(*) FROM customer) BETWEEN 2 AND 50 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 'tool_selection_scored', CASE WHEN (SELECT count(score) FROM sc WHERE metric_name = 'tool_selection_accuracy') > 0 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 'two_runs', CASE WHEN (SELECT count(DISTINCT run_name) FROM sc) >= 2 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 'covers_single_tool_and_refusal', CASE WHEN (SELECT count(DISTINCT process) FROM truth WHERE process IN ('single_tool', 'refusal')) = 2 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 'no_toxic_labels', CASE WHEN (SELECT sum(toxic) FROM labels) = 0 THEN 'PASS' ELSE 'FAIL' END""")
def eval_data_checks(t):
    sizes = t.customer.agg(F.count("*").alias("c")).withColumn("o", t.orders.agg(F.count("*")).scalar())
    s = scores(t).agg(F.count_distinct("run_name").alias("runs"),
                      F.count(F.when(F.col("metric_name") == "tool_selection_accuracy", F.col("score"))).alias("scored"))
    cover = truth(t).agg(F.count_distinct(F.when(
        ev.truth_field("process").isin("single_tool", "refusal"), ev.truth_field("process"))).alias("p"))
    toxic = t.labels.agg(F.sum("toxic").alias("s"))
    return ev.check_rows([
        (sizes, {"customers_positive": F.col("c") > 0,
                 "orders_per_customer_2_to_50": (F.col("o") / F.col("c")).between(2, 50)}),
        (s, {"tool_selection_scored": F.col("scored") > 0, "two_runs": F.col("runs") >= 2}),
        (cover, {"covers_single_tool_and_refusal": F.col("p") == 2}),
        (toxic, {"no_toxic_labels": F.col("s") == 0})])


def team_performance(t: Tables, region: str | None = None) -> DataFrame:
    """Governed aggregate for one region (or all) as a single JSON array."""
    reps = optional_filter(t.customer.join(md.geography(t), F.col("c_nationkey") == F.col("n_nationkey")), "r_name", region)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count_if(F.col("l_returnflag") == "N").alias("won"), F.count("*").alias("n"))
    rows = (t.orders.join(lines, "o_orderkey")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.sum("n").alias("n"), F.sum("won").alias("won"),
                 F.sum(F.when(F.col("o_orderstatus") == "F", F.col("n")).otherwise(0)).alias("replied"))
            .join(reps, "c_custkey").groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("team"))
            .agg(F.sum("n").alias("emails"),
                 F.round(F.sum("replied") / F.sum("n"), 4).alias("reply_rate"),
                 F.sum("won").alias("won_deals")))
    items = F.array_sort(F.collect_list(F.struct(
        (-F.col("won_deals")).alias("o"), "region", "team",
        F.struct("region", "team", "emails", "reply_rate", "won_deals").alias("v"))))
    return rows.agg(F.to_json(F.transform(items, lambda x: x["v"])).alias("performance"))


@query("team_performance_json", "R1 C8 E5 E2", """
WITH x AS (SELECT r_name AS region, c_mktsegment AS team, count(*) AS emails,
  round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 4) AS reply_rate, sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)::BIGINT AS won_deals
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey GROUP BY ALL),
 w AS (SELECT 'ALL' AS scope, * FROM x UNION ALL SELECT 'ASIA', * FROM x WHERE region = 'ASIA')
SELECT scope, to_json(list({'region': region, 'team': team, 'emails': emails, 'reply_rate': reply_rate, 'won_deals': won_deals}
  ORDER BY won_deals DESC, region, team))::VARCHAR AS performance FROM w GROUP BY 1""")
def team_performance_json(t):
    return team_performance(t).withColumn("scope", F.lit("ALL")).unionByName(
        team_performance(t, "ASIA").withColumn("scope", F.lit("ASIA")))
