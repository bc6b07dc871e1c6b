"""Forecast and anomaly detection over one or many time series.

Input is one row per (series, period): callers roll events up first, which also
bounds every series by its number of periods. All models are fitted by plain
aggregates, so a million series cost the same few shuffles as one.
"""

from __future__ import annotations

from datetime import datetime
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import ntz


def z_value(prediction_interval: float) -> float:
    """Two-sided normal quantile of a prediction interval."""
    return NormalDist().inv_cdf(0.5 + prediction_interval / 2)


def period_index(day: Column, days: int) -> Column:
    """Whole periods since a fixed Monday (1970-01-05)."""
    return F.floor(F.datediff(day, F.lit("1970-01-05").cast("date")) / days)


def forecast(series: DataFrame, keys: list[str], day: str, target: str, horizon: int,
             period_days: int = 7, season: int = 52, interval: float = 0.95) -> DataFrame:
    """Next ``horizon`` periods: linear trend plus mean seasonal residual.

    Bounds are ± z times the deviation of what trend and season leave over.
    """
    i, y, slot = F.col("_i"), F.col("_y"), F.pmod(F.col("_i"), F.lit(season))
    rows = series.select(*keys, period_index(F.col(day), period_days).alias("_i"),
                         F.col(target).cast("double").alias("_y"))
    trend = rows.groupBy(*keys).agg(
        F.regr_slope(y, i).alias("_b"), F.regr_intercept(y, i).alias("_a"), F.max("_i").alias("_last"))
    if keys:
        fitted = rows.join(trend, keys)
    else:
        fitted = rows.select("*", *[trend.select(c).scalar().alias(c) for c in ("_a", "_b", "_last")])
    left = fitted.withColumn("_r", y - (F.col("_a") + F.col("_b") * i)).withColumn("_slot", slot)
    # Mean residual per slot; the spread around it is pooled over the slots.
    seasonal = left.groupBy(*keys, "_slot").agg(
        F.avg("_r").alias("_s"), F.var_pop("_r").alias("_v"), F.count("*").alias("_n"))
    spread = seasonal.groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("_sd"))
    if keys:
        head = trend.join(spread, keys)
    else:
        head = trend.withColumn("_sd", spread.scalar())
    ahead = (head.withColumn("_i", F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + horizon)))
             .withColumn("_slot", slot))
    z = z_value(interval)
    value = F.col("_a") + F.col("_b") * i + F.coalesce("_s", F.lit(0.0))
    return (ahead.join(seasonal.select(*keys, "_slot", "_s"), [*keys, "_slot"], "left")
            .select(*keys,
                    F.date_add(F.lit("1970-01-05").cast("date"), (i * period_days).cast("int")).alias("ts"),
                    value.alias("forecast"), (value - z * F.col("_sd")).alias("lower_bound"),
                    (value + z * F.col("_sd")).alias("upper_bound")))


def detect_anomalies(series: DataFrame, keys: list[str], ts: str, target: str, cut: datetime,
                     season: Column | None = None, interval: float = 0.99) -> DataFrame:
    """Train strictly before ``cut``, score from ``cut`` on.

    The forecast is the training mean of the same (series, season), else of the
    series (``basis`` tells which); the spread is pooled over the seasons of the
    series. Distance counts spreads. Every recent point is kept: without any
    training row of its series basis is ``none`` and the findings are NULL.
    """
    keyed = series.withColumn("_season", season if season is not None else F.lit(0))
    when = F.col(ts)
    train, recent = keyed.filter(when < ntz(cut)), keyed.filter(when >= ntz(cut))
    stats = train.groupBy(*keys, "_season").agg(
        F.avg(target).alias("forecast"), F.var_samp(target).alias("_v"), F.count("*").alias("_n"))
    spread = stats.groupBy(*keys).agg(
        F.sqrt(F.try_divide(F.sum(F.col("_v") * (F.col("_n") - 1)), F.sum(F.col("_n") - 1))).alias("_sd"))
    whole = stats.groupBy(*keys).agg((F.sum(F.col("forecast") * F.col("_n")) / F.sum("_n")).alias("_mean"))
    z = z_value(interval)
    y, mean = F.col("y"), F.col("forecast")
    sd = F.when(mean.isNotNull(), F.coalesce("_sd", F.lit(0.0)))
    basis = F.when(F.col("_own").isNotNull(), "season").when(F.col("_mean").isNotNull(), "series").otherwise("none")
    scored = (recent.withColumnRenamed(target, "y")
              .join(stats.select(*keys, "_season", F.col("forecast").alias("_own")), [*keys, "_season"], "left")
              .join(spread.join(whole, keys), keys, "left")
              .withColumn("forecast", F.coalesce("_own", "_mean")).withColumn("basis", basis))
    return scored.select(
        *keys, F.col(ts).alias("ts"), "y", "basis", "forecast", (mean - z * sd).alias("lower_bound"),
        (mean + z * sd).alias("upper_bound"),
        F.when(mean.isNotNull(), F.coalesce(F.try_divide(y - mean, sd), F.lit(0.0))).alias("distance"),
        ((y < mean - z * sd) | (y > mean + z * sd)).alias("is_anomaly"))
