"""Evaluation analytics over scored runs.

Scores: run_name, input, metric_name, score. Ground truth is a JSON document
per input with intent, process and expected tool calls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.operators.ordering import top_per_group


def truth_field(field: str) -> Column:
    return F.try_variant_get(F.try_parse_json("ground_truth"), f"$.{field}", "string")


def coverage(truth: DataFrame) -> DataFrame:
    """Labelled inputs per process and intent."""
    return truth.groupBy(truth_field("process").alias("process"), truth_field("intent").alias("intent")).agg(
        F.count("*").alias("n"))


def run_summary(scores: DataFrame, keys: list[str]) -> DataFrame:
    return scores.groupBy(*keys).agg(
        F.count("*").alias("num_records"), F.avg("score").alias("avg_score"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def metric_pivot(scores: DataFrame, truth: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean score per process and intent, one column per metric."""
    labelled = truth.select("input", truth_field("process").alias("process"), truth_field("intent").alias("intent"))
    return scores.join(labelled, "input").groupBy("process", "intent").pivot("metric_name", metrics).agg(
        F.avg("score"))


def compare_runs(scores: DataFrame, keys: list[str], baseline: str, candidate: str) -> DataFrame:
    """Mean score of two runs per key with the difference; one pass, no self-join."""
    run = F.col("run_name")
    out = scores.filter(run.isin(baseline, candidate)).groupBy(*keys).agg(
        F.avg(F.when(run == baseline, F.col("score"))).alias("baseline"),
        F.avg(F.when(run == candidate, F.col("score"))).alias("candidate"))
    return out.filter("baseline IS NOT NULL AND candidate IS NOT NULL").withColumn(
        "delta", F.col("candidate") - F.col("baseline"))


def compare_scenarios(scores: DataFrame, truth: DataFrame, baseline: str, candidate: str,
                      processes: list[str]) -> DataFrame:
    """Run comparison per (process, metric) over inputs scored in both runs."""
    chosen = truth.withColumn("process", truth_field("process")).filter(
        F.col("process").isin(*processes)).select("input", "process")
    pairs = compare_runs(scores.join(chosen, "input"), ["process", "input", "metric_name"], baseline, candidate)
    return pairs.groupBy("process", "metric_name").agg(
        F.avg("baseline").alias("baseline"), F.avg("candidate").alias("candidate"),
        F.avg("delta").alias("delta"))


def regression_status(history: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Latest against previous run per metric: REGRESSION, IMPROVEMENT or STABLE."""
    two = top_per_group(history.select("metric_name", "run_ts", "run_name", "avg_score"), ["metric_name"],
                        [F.desc("run_ts"), F.desc("run_name")], 2)
    place = F.struct("run_ts", "run_name")
    delta = F.col("latest") - F.col("previous")
    return (two.groupBy("metric_name").agg(
        F.count("*").alias("_n"), F.max_by("avg_score", place).alias("latest"),
        F.min_by("avg_score", place).alias("previous"))
        .filter("_n = 2").drop("_n")
        .withColumn("delta", delta)
        .withColumn("status", F.when(F.col("latest") < F.col("previous") - tolerance, "REGRESSION")
                    .when(F.col("latest") > F.col("previous") + tolerance, "IMPROVEMENT")
                    .otherwise("STABLE")))


def tool_selection(log: DataFrame, called: str, expected: str) -> DataFrame:
    """Compare the called with the expected tool sets of each row."""
    missing = F.array_except(expected, called)
    extra = F.array_except(called, expected)
    return log.withColumns({
        "missing_tools": F.size(missing), "extra_tools": F.size(extra),
        "tools_match": (F.size(missing) == 0) & (F.size(extra) == 0)})


def checks(conditions: dict[str, Column]) -> list[Column]:
    return [F.when(F.coalesce(c, F.lit(False)), "PASS").otherwise("FAIL").alias(n)
            for n, c in conditions.items()]


def check_rows(facts: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """PASS/FAIL rows: each DataFrame holds one row of aggregates the conditions use."""
    parts = []
    for row, conditions in facts:
        names = list(conditions)
        held = row.select(*checks(conditions))
        parts.append(held.unpivot([], names, "check_name", "result"))
    return reduce(DataFrame.unionByName, parts)
