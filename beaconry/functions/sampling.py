"""Deterministic assignment: same key and salt give the same bucket on every run.

MD5 keeps the buckets equal across engines, so a retry, a lost executor or
another system reproduces them. Nothing here shuffles, except the one
``orderBy(...).limit(n)`` of ``sample_rows`` which is a per-task top-n.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_hash(key: Column, salt: str) -> Column:
    """32-bit non-negative hash of ``key`` as a long."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def stable_bucket(key: Column, salt: str, buckets: int = 100) -> Column:
    return F.pmod(stable_hash(key, salt), F.lit(buckets)).cast("int")


def weighted_choice(key: Column, salt: str, weights: dict[str, int]) -> Column:
    """Assign a category by whole-number weights."""
    bucket = stable_bucket(key, salt, sum(weights.values()))
    names, edges, total = list(weights), [], 0
    for name in names:
        total += weights[name]
        edges.append(total)
    branches = list(zip(names[:-1], edges[:-1]))
    return reduce(lambda acc, b: F.when(bucket < b[1], b[0]).otherwise(acc),
                  reversed(branches), F.lit(names[-1]))


def sample_rows(df: DataFrame, key: str, n: int, salt: str) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones on every run."""
    return (df.withColumn("_h", stable_hash(F.col(key), salt))
            .orderBy("_h", key).limit(n).drop("_h"))


def split_train_valid(df: DataFrame, key: str, salt: str,
                      train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete split on the key."""
    is_train = stable_bucket(F.col(key), salt) < train_percent
    return df.filter(is_train), df.filter(~is_train)
