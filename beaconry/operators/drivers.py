"""Key-driver analysis: which segments explain a change between two groups."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions.safe import rate
from beaconry.session import scratch_path
from beaconry.sources.tables import replace_table

#: Cells that a task of ``key_drivers`` expands into grouping sets, about.
CELLS_OF_TASK = 100_000


def _cells(rows: DataFrame, metric: str, label: str, dims: list[str]) -> DataFrame:
    """Sums of both groups per full dimension combination."""
    test = F.col(label)
    return rows.groupBy(*dims).agg(
        F.coalesce(F.sum(F.when(~test, F.col(metric))), F.lit(0)).alias("_control"),
        F.coalesce(F.sum(F.when(test, F.col(metric))), F.lit(0)).alias("_test"))


def _finished(segments: DataFrame, cells: DataFrame, name: Column) -> DataFrame:
    """Shares of the change from the sums of each segment and of all cells."""
    control, seen = F.col("metric_control"), F.col("metric_test")
    return (segments
            .withColumn("_c", cells.agg(F.sum("_control")).scalar())
            .withColumn("_t", cells.agg(F.sum("_test")).scalar())
            .select(name.alias("segment"), "metric_control", "metric_test",
                    (seen - control).alias("contribution"),
                    rate(seen - control, F.col("_t") - F.col("_c")).alias("relative_contribution"),
                    rate(seen - control, control).alias("growth_rate"),
                    (seen - control * rate(F.col("_t"), F.col("_c"))).alias("surprise")))


def key_drivers(rows: DataFrame, metric: str, label: str, dims: list[str],
                max_depth: int | None = None) -> DataFrame:
    """Every segment of the dimensions, up to ``max_depth`` of them (default: all),
    with its share of the change.

    ``label`` is true for the test group. Rows are first summed per full
    dimension combination; only those sums are expanded into grouping sets, so
    the data itself is shuffled once and never multiplied. The sums are stored first.

    surprise = test − control × (total test / total control): what the segment
    moved beyond the overall change. A NULL value of a dimension is a value of
    its own, written ``dimension=NULL``.
    """
    cells = replace_table(_cells(rows, metric, label, dims), scratch_path(rows.sparkSession, "cells"))
    # A task holds the sums of all sets over its cells, so the cells of one are bounded.
    spread = cells.repartition(1 + cells.count() // CELLS_OF_TASK)
    sets = [list(c) for n in range(1, (max_depth or len(dims)) + 1) for c in combinations(dims, n)]
    segments = spread.groupingSets([[F.col(d) for d in s] for s in sets], *dims).agg(
        F.sum("_control").alias("metric_control"), F.sum("_test").alias("metric_test"),
        *[F.grouping(d).alias(f"_out_{d}") for d in dims])
    name = F.concat_ws(" & ", *[
        F.when(F.col(f"_out_{d}") == 0, F.concat(F.lit(f"{d}="), F.coalesce(F.col(d).cast("string"), F.lit("NULL"))))
        for d in dims])
    return _finished(segments, cells, name)


def ranked_drivers(drivers: DataFrame, n: int, digits: int = 0) -> DataFrame:
    """The ``n`` segments with the largest surprise; ranks are given to those rows only."""
    size = F.round(F.abs("surprise"), digits)
    top = drivers.withColumn("_size", size).orderBy(F.desc("_size"), "segment").limit(n)
    return top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("_size"), "segment"))).drop("_size")


def top_drivers(rows: DataFrame, metric: str, label: str, dims: list[str], n: int, digits: int = 0) -> DataFrame:
    """The rows of ``ranked_drivers(key_drivers(...), n, digits)`` without expanding every grouping set.

    A segment's surprise is the sum of its cells' surprises, so no part of it can move more
    than the sum of its positive or of its negative cells. The lattice is searched level by
    level: segments grow by one later dimension, and one whose bound lies below the n-th best
    found so far is not grown. A value whose own segment is excluded is forgotten, as is a
    dimension that a branch no longer adds, and cells that then agree become one: a level
    holds sums per living segment and what it may still grow by, not copies of the cells.
    The result is exact; where no bound excludes anything, every segment is visited, as in
    ``key_drivers``. All of it stays in Spark, stored narrow and compressed; the driver reads
    one threshold a level.

    Without a control total the surprise is NULL and segments are ranked by name.
    """
    if not 0 < len(dims) < 63:
        raise ValueError("between 1 and 62 dimensions")
    spark = rows.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        return replace_table(df, scratch_path(spark, "drivers"))

    named = rows.select(*[F.col(d).alias(f"_d{i}") for i, d in enumerate(dims)], metric, label)
    parts = [f"_d{i}" for i in range(len(dims))]
    cells = stored(_cells(named, metric, label, parts))
    ratio = cells.agg(rate(F.sum("_test"), F.sum("_control")).cast("double").alias("r")).first()["r"]
    if ratio is None:
        return ranked_drivers(key_drivers(rows, metric, label, dims), n, digits)

    def has(mask: str, i: int) -> Column:
        return F.col(mask).bitwiseAND(F.lit(1 << i).cast("long")) != 0

    held = [f"_k{i}" for i in range(len(dims))]
    name = F.concat_ws(" & ", *[
        F.when(has("_m", i), F.concat(F.lit(f"{d}="), F.coalesce(F.col(held[i]).cast("string"), F.lit("NULL"))))
        for i, d in enumerate(dims)])
    kinds = cells.agg(F.sum("_control").alias("_control"), F.sum("_test").alias("_test")).schema

    def total(c: str) -> Column:  # of one type at every level, however often summed
        return F.sum(c).cast(kinds[c].dataType)

    moved = F.col("_test").cast("double") - F.col("_control").cast("double") * ratio
    best = None

    def measured(grown: DataFrame) -> DataFrame:
        """Sums and bounds of each segment (``_m``, its values) of rows still to grow."""
        return stored(grown.groupBy("_m", *[F.when(has("_m", i), F.col(d)).alias(held[i]) for i, d in enumerate(parts)]).agg(
            total("_control").alias("metric_control"), total("_test").alias("metric_test"),
            F.sum(F.greatest(moved, F.lit(0.0))).alias("_up"), F.sum(F.greatest(-moved, F.lit(0.0))).alias("_down")))

    def living(level: DataFrame) -> DataFrame:
        """Segments that may still hold one of the ``n`` best, after those of this level are ranked."""
        nonlocal best
        found = ranked_drivers(_finished(level, cells, name), n, digits)
        best = stored(found if best is None else ranked_drivers(best.unionByName(found).drop("rank"), n, digits))
        got = best.agg(F.count("*").alias("n"), F.min(F.round(F.abs("surprise"), digits)).alias("least")).first()
        bar = float(got["least"]) if got["n"] == n else 0.0
        # The slack covers rounding of the ranks and of sums in floating point.
        reach = F.greatest("_up", "_down") * (1 + 1e-9) + 10.0 ** -digits
        return stored(level.filter(reach >= bar).select("_m", *held))

    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(len(dims))])
    alive = living(measured(cells.select("*", F.explode(bits).alias("_m"))))
    # A value whose own segment can't reach the best is in no segment that can: it is forgotten,
    # and cells that differ in such values only become one.
    front = cells.withColumn("_l", F.lit(0).cast("long"))
    for i, d in enumerate(parts):
        own = alive.filter(F.col("_m") == (1 << i)).select(F.col(held[i]).alias("_v"), F.lit(1 << i).cast("long").alias("_bit"))
        front = (front.join(own, F.col(d).eqNullSafe(F.col("_v")), "left")
                 .withColumns({"_l": F.col("_l") + F.coalesce("_bit", F.lit(0)), d: F.when(F.col("_bit").isNotNull(), F.col(d))})
                 .drop("_v", "_bit"))
    front = front.withColumn("_m", F.lit(0).cast("long"))
    for depth in range(len(dims)):
        # ``_l``: dimensions still to add. Others that the segment does not hold are dropped.
        step = F.explode(F.filter(bits, lambda b: b.bitwiseAND(F.col("_l")) != 0)).alias("_bit")
        grown = (front.select("*", step)
                 .withColumns({"_m": F.col("_m").bitwiseOR(F.col("_bit")), "_l": F.col("_l").bitwiseAND(-2 * F.col("_bit"))}))
        grown = stored(grown.groupBy("_m", "_l", *[F.when(has("_m", i) | has("_l", i), F.col(d)).alias(d) for i, d in enumerate(parts)])
                       .agg(total("_control").alias("_control"), total("_test").alias("_test")))
        if depth:  # segments of one value are known
            alive = living(measured(grown))
            same = F.col("_m") == F.col("_m_")
            for i, (d, k) in enumerate(zip(parts, held)):
                same = same & F.when(has("_m", i), F.col(d)).eqNullSafe(F.col(f"{k}_"))
            grown = grown.join(alive.select(*[F.col(c).alias(f"{c}_") for c in alive.columns]), same, "leftsemi")
        front = grown.filter("_l != 0")
        if front.isEmpty():
            break
    return best
