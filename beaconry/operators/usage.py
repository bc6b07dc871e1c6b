"""Usage and cost analytics over a usage history.

History columns: start_time, query_id, user_id, function_name, model_name,
credits, tokens, is_completed, query_tag.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import add_months, bucket, ntz
from beaconry.functions.safe import rate


def daily_credits(history: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Credits and distinct queries per day, function and model."""
    return (history.filter(F.col("start_time") >= ntz(as_of - timedelta(days=days)))
            .groupBy(bucket("day", F.col("start_time")).alias("usage_date"), "function_name", "model_name")
            .agg(F.sum("credits").alias("total_credits"),
                 F.count_distinct("query_id").alias("query_count")))


def monthly_consumers(history: DataFrame, users: DataFrame, as_of: datetime, months: int = 3) -> DataFrame:
    """Credits per user and month; users join after the aggregate, one row per user-month."""
    spend = (history.filter(F.col("start_time") >= ntz(add_months(as_of, -months)))
             .groupBy(bucket("month", F.col("start_time")).alias("usage_month"), "user_id")
             .agg(F.sum("credits").alias("total_credits"),
                  F.count_distinct("query_id").alias("query_count")))
    return spend.join(users, "user_id")


def still_running(history: DataFrame, users: DataFrame, as_of: datetime, hours: int = 48) -> DataFrame:
    """Queries none of whose usage rows is marked completed, with the cost so far."""
    open_queries = (history.filter(F.col("start_time") >= ntz(as_of - timedelta(hours=hours)))
                    .groupBy("query_id").agg(
                        F.min("user_id").alias("user_id"),
                        F.array_join(F.array_sort(F.collect_set("function_name")), ", ").alias("functions"),
                        F.sum("credits").alias("credits_so_far"), F.min("start_time").alias("started_at"),
                        F.bool_or("is_completed").alias("_done"))
                    .filter(~F.col("_done")).drop("_done"))
    return open_queries.join(users, "user_id", "left")


def token_estimate(texts: DataFrame, text: str) -> DataFrame:
    """Rows and estimated tokens: one token per started four characters."""
    n = F.ceil(F.char_length(text) / 4)
    return texts.agg(F.count("*").alias("rows_to_process"), F.sum(n).alias("total_input_tokens"),
                     F.floor(F.avg(n)).alias("avg_tokens_per_row"), F.max(n).alias("max_tokens_per_row"))


def price(tokens: Column, credits_per_million: Column, usd_per_credit: float) -> dict[str, Column]:
    credits = tokens / 1_000_000 * credits_per_million
    return {"projected_credits": credits, "projected_usd": credits * usd_per_credit}


def project_cost(texts: DataFrame, text: str, rates: DataFrame, usd_per_credit: float) -> DataFrame:
    """Price a full run per model of a rate table (model_name, credits_per_1m_tokens)."""
    total = token_estimate(texts, text).select("total_input_tokens").scalar()
    return rates.withColumn("total_input_tokens", total).withColumns(
        price(F.col("total_input_tokens"), F.col("credits_per_1m_tokens"), usd_per_credit))


def empirical_rates(history: DataFrame, name_pattern: str | None = None) -> DataFrame:
    """Credits per million tokens actually charged, per model; NULL without tokens."""
    rows = history.filter(F.col("tokens") > 0)
    if name_pattern:
        rows = rows.filter(F.col("function_name").ilike(name_pattern))
    return rows.groupBy("model_name").agg(
        F.sum("tokens").alias("tokens"), F.sum("credits").alias("token_credits")).withColumn(
        "credits_per_1m_tokens", rate(F.col("token_credits"), F.col("tokens")) * 1e6)


def estimate_cost(texts: DataFrame, text: str, model: str, history: DataFrame, usd_per_credit: float,
                  credits_per_1m_tokens: float | None = None) -> DataFrame:
    """Rows, tokens and price of one run; no rate known → price stays NULL."""
    charged = F.lit(credits_per_1m_tokens).cast("double")
    if credits_per_1m_tokens is None:
        charged = (empirical_rates(history.filter(F.col("model_name") == model))
                   .select("credits_per_1m_tokens").scalar())
    sized = token_estimate(texts, text).select("rows_to_process", "total_input_tokens")
    return sized.withColumn("credits_per_1m_tokens", charged).withColumns(
        price(F.col("total_input_tokens"), F.col("credits_per_1m_tokens"), usd_per_credit))


def monthly_budget_alert(history: DataFrame, month: datetime, budget: float) -> DataFrame:
    """One row: spend of the month, and whether it is above the budget."""
    return (history.filter((F.col("start_time") >= ntz(month)) & (F.col("start_time") < ntz(add_months(month, 1))))
            .agg(F.coalesce(F.sum("credits"), F.lit(0.0)).alias("spend"))
            .withColumn("alert", F.col("spend") > budget))


def users_over_limits(history: DataFrame, monthly_limit: float, daily_limit: float) -> DataFrame:
    """Users above the monthly limit, or above the daily limit on some day of the month."""
    daily = history.groupBy("user_id", bucket("day", F.col("start_time")).alias("day")).agg(
        F.sum("credits").alias("spend"))
    per_month = daily.groupBy("user_id", bucket("month", F.col("day")).alias("month")).agg(
        F.sum("spend").alias("month_spend"),
        F.count_if(F.col("spend") > daily_limit).alias("days_over"))
    return per_month.withColumn("over_month", F.col("month_spend") > monthly_limit).filter(
        "over_month OR days_over > 0")


def spend_by_tag(history: DataFrame, tag: str) -> DataFrame:
    """Credits per value of one key of the ``key:value;key:value`` tag."""
    value = F.element_at(F.str_to_map("query_tag", F.lit(";"), F.lit(":")), tag)
    return history.groupBy(value.alias(tag)).agg(
        F.sum("credits").alias("credits"), F.count("*").alias("calls"))
