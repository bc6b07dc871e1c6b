"""Null- and zero-tolerant arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div0(numerator: Column, denominator: Column) -> Column:
    """``n / d``, 0 where ``d`` is 0 and NULL where either side is NULL."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator)


def rate(numerator: Column, denominator: Column) -> Column:
    """``n / d``, NULL where ``d`` is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def clamp(value: Column, low: float, high: float) -> Column:
    """Bound ``value`` to [low, high]; a NULL stays NULL."""
    return F.when(value.isNotNull(),
                  F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def parse_score(raw: Column, default: float = 0.5) -> Column:
    """First number in a free-text answer; missing → default, above 1 → percent."""
    number = F.regexp_extract(raw, r"([0-9]*\.?[0-9]+)", 1).try_cast("double")
    score = F.coalesce(number, F.lit(default))
    return F.when(score > 1, score / 100).otherwise(score)


def parse_score_clamped(raw: Column, default: float = 0.5) -> Column:
    """First number in a free-text answer, bounded to [0, 1]."""
    number = F.regexp_extract(raw, r"([0-9]*\.?[0-9]+)", 1).try_cast("double")
    return clamp(F.coalesce(number, F.lit(default)), 0.0, 1.0)
