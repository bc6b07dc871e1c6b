"""Point-in-time features and forward-window labels over (entity, snapshot).

A snapshot calendar is a short sorted list of timestamps. Instead of joining
every entity-snapshot to its whole history, each fact is turned into at most two
deltas: it enters the running totals at the first snapshot not before it, and
leaves the trailing window after the last snapshot that still covers it. Deltas
are summed per entity into one column per slot before the shuffle, so a hot entity
costs one row per task, and running sums inside that row give the features.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.dates import add_months, ntz

NO_HISTORY_DAYS = 1500  # recency of an entity without history


def _rank(ts: Column, bounds: list[datetime], inclusive: bool) -> Column:
    """How many bounds are below ``ts`` (or not above it): plain comparisons."""
    tests = [(ntz(b) <= ts) if inclusive else (ntz(b) < ts) for b in bounds]
    return sum([t.cast("int") for t in tests[1:]], tests[0].cast("int"))


def snapshot_deltas(facts: DataFrame, key: str, ts: str, calendar: list[datetime],
                    trailing_months: int, amount: str | None = None) -> DataFrame:
    """Deltas (key, slot) of each fact; facts after the last snapshot are not read.

    They are summed by ``snapshot_features``, or by ``through_link`` before its join.
    """
    n = len(calendar)
    value = F.col(amount).cast("double") if amount else F.lit(0.0)
    enter = F.struct(F.col("_in").alias("slot"), F.lit(1).alias("n"), F.col("_amount").alias("amount"),
                     F.lit(1).alias("recent"), F.col("_ts").alias("last_ts"))
    leave = F.struct(F.col("_out").alias("slot"), F.lit(0).alias("n"), F.lit(0.0).alias("amount"),
                     F.lit(-1).alias("recent"), F.lit(None).cast("timestamp_ntz").alias("last_ts"))
    # A fact too old for the trailing window of its first snapshot never enters it.
    stale = F.col("_out") <= F.col("_in")
    old = F.struct(F.col("_in").alias("slot"), F.lit(1).alias("n"), F.col("_amount").alias("amount"),
                   F.lit(0).alias("recent"), F.col("_ts").alias("last_ts"))
    windows = [add_months(c, -trailing_months) for c in calendar]
    rows = (facts.filter(F.col(ts) <= ntz(calendar[-1]))
            .select(F.col(key).alias("key"), F.col(ts).cast("timestamp_ntz").alias("_ts"),
                    value.alias("_amount"),
                    _rank(F.col(ts), calendar, False).alias("_in"),
                    _rank(F.col(ts), windows, True).alias("_out"))
            .select("key", F.explode(F.when(stale, F.array(old))
                                     .when(F.col("_out") >= n, F.array(enter))
                                     .otherwise(F.array(enter, leave))).alias("d"))
            .select("key", "d.*"))
    return rows


def sum_deltas(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "slot").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"),
        F.sum("recent").alias("recent"), F.max("last_ts").alias("last_ts"))


def snapshot_features(entities: DataFrame, deltas: DataFrame, key: str, started: str,
                      calendar: list[datetime]) -> DataFrame:
    """Running totals per (entity, snapshot) for entities started by the snapshot.

    Columns: key, as_of_ts, tenure_days, n, recent, amount, recency_days.
    """
    n = len(calendar)
    start = (entities.filter(F.col(started) <= ntz(calendar[-1]))
             .select(F.col(key).alias("key"), F.col(started).alias("_started"), F.lit(True).alias("_held")))
    at = [F.col("slot") == i for i in range(n)]

    def sums(column: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(hit, F.col(column))), F.lit(0)) for hit in at])

    # One row per entity: a sum per snapshot slot, combined in the task before the shuffle.
    per = (deltas.unionByName(start, allowMissingColumns=True).groupBy("key").agg(
        sums("n").alias("n"), sums("amount").alias("amount"), sums("recent").alias("recent"),
        F.array(*[F.max(F.when(hit, F.col("last_ts"))) for hit in at]).alias("last_ts"),
        F.max("_started").alias("_started"), F.max("_held").alias("_held")).filter("_held"))
    slots = F.sequence(_rank(F.col("_started"), calendar, False), F.lit(n - 1))
    as_of = F.get(F.array(*[ntz(c) for c in calendar]), F.col("slot"))

    def running(column: str, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate(F.slice(column, 1, F.col("slot") + 1), zero, lambda total, x: total + x.cast(kind))

    return (per.select("*", F.explode(slots).alias("slot"))
            .select(F.col("key").alias(key), as_of.alias("as_of_ts"),
                    F.datediff(as_of, "_started").cast("long").alias("tenure_days"),
                    running("n", "long").alias("n"), running("recent", "long").alias("recent"),
                    running("amount", "double").alias("amount"),
                    F.coalesce(F.datediff(as_of, F.array_max(F.slice("last_ts", 1, F.col("slot") + 1))),
                               F.lit(NO_HISTORY_DAYS)).cast("long").alias("recency_days")))


def rfm_view(entities: DataFrame, facts: DataFrame, key: str, started: str, fact_key: str,
             ts: str, amount: str, calendar: list[datetime]) -> DataFrame:
    """Recency, frequency, monetary and tenure per (entity, snapshot)."""
    deltas = snapshot_deltas(facts, fact_key, ts, calendar, 12, amount)
    out = snapshot_features(entities, deltas, key, started, calendar)
    return out.select(
        key, "as_of_ts", "tenure_days",
        F.col("n").alias("frequency_lifetime"), F.col("recent").alias("frequency_last_12m"),
        F.col("amount").alias("monetary_total"),
        F.coalesce(F.try_divide("amount", "n"), F.lit(0.0)).alias("avg_gift_amount"),
        "recency_days")


def engagement_view(entities: DataFrame, deltas: DataFrame, key: str, started: str,
                    calendar: list[datetime]) -> DataFrame:
    """Lifetime and 6-month engagement per (entity, snapshot) from 6-month deltas."""
    return snapshot_features(entities, deltas, key, started, calendar).select(
        key, "as_of_ts", F.col("n").alias("engagement_count"),
        F.col("recent").alias("engagement_last_6m"))


def through_link(deltas: DataFrame, link: DataFrame, link_key: str, owner: str) -> DataFrame:
    """Move deltas from a child key to its owner (order → customer), summed per child first."""
    moved = (sum_deltas(deltas).join(link.select(F.col(link_key).alias("key"), F.col(owner).alias("_owner")), "key")
             .drop("key").withColumnRenamed("_owner", "key"))
    return moved


def forward_label(entities: DataFrame, facts: DataFrame, key: str, started: str, fact_key: str,
                  ts: str, as_of: datetime, months: int = 12, label: str = "is_lapsed") -> DataFrame:
    """1 where the entity has no fact in (as_of, as_of + months]; eligible entities only."""
    ahead = (facts.filter((F.col(ts) > ntz(as_of)) & (F.col(ts) <= ntz(add_months(as_of, months))))
             .groupBy(F.col(fact_key).alias(key)).agg(F.count("*").alias("_ahead")))
    return (entities.filter(F.col(started) <= ntz(as_of)).select(key)
            .join(ahead, key, "left")
            .select(key, ntz(as_of).alias("as_of_ts"),
                    F.when(F.coalesce("_ahead", F.lit(0)) == 0, 1).otherwise(0).alias(label)))


def training_base(entities: DataFrame, gifts: DataFrame, engagement: DataFrame, key: str,
                  started: str, gift_key: str, gift_ts: str, gift_amount: str,
                  as_of: datetime) -> DataFrame:
    """Features at one as-of with the forward label: one pass over the gifts.

    ``engagement`` holds per-entity ``engagement_count`` and ``engagement_last_6m``.
    """
    ts, cut = F.col(gift_ts), ntz(as_of)
    past = ts <= cut
    year_ago, year_on = ntz(add_months(as_of, -12)), ntz(add_months(as_of, 12))
    history = (gifts.filter(ts <= year_on).groupBy(F.col(gift_key).alias(key)).agg(
        F.count_if(past).alias("frequency_lifetime"),
        F.count_if(past & (ts >= year_ago)).alias("frequency_last_12m"),
        F.sum(F.when(past, F.col(gift_amount))).alias("monetary_total"),
        F.avg(F.when(past, F.col(gift_amount))).alias("avg_gift_amount"),
        F.max(F.when(past, ts)).alias("_last"),
        F.count_if(ts > cut).alias("_ahead")))
    zero = F.lit(0)
    return (entities.filter(F.col(started) <= cut)
            .join(history, key, "left").join(engagement, key, "left")
            .select(
                *entities.columns,
                F.datediff(cut, F.col(started)).cast("long").alias("tenure_days"),
                F.coalesce("frequency_lifetime", zero).alias("frequency_lifetime"),
                F.coalesce("frequency_last_12m", zero).alias("frequency_last_12m"),
                F.coalesce("monetary_total", F.lit(0.0)).alias("monetary_total"),
                F.coalesce("avg_gift_amount", F.lit(0.0)).alias("avg_gift_amount"),
                F.coalesce(F.datediff(cut, "_last"), F.lit(NO_HISTORY_DAYS)).cast("long").alias("recency_days"),
                F.coalesce("engagement_count", zero).alias("engagement_count"),
                F.coalesce("engagement_last_6m", zero).alias("engagement_last_6m"),
                F.when(F.coalesce("_ahead", zero) == 0, 1).otherwise(0).alias("is_lapsed")))
