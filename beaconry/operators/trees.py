"""Boosted trees as arrays: scores after any number of trees, and exact Shapley values.

A fitted ensemble is small beside the data (its size is checked), so its nodes are
broadcast once and every task works on Arrow batches of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.session import scratch_path

#: Nodes of an ensemble that may be broadcast: about 56 bytes each.
MOST_NODES = 2_000_000
#: Rows that are explained at a time.
ROWS = 256


@dataclass
class Paths:
    """Leaves of one tree, each with the distinct features of its path: a row goes along
    where ``low < x <= high`` for all; ``share`` is the part of the training rows that
    took the path's turns at that feature. Short paths are filled up with open slots."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def taken(self, x: np.ndarray) -> np.ndarray:
        """Whether each row meets each slot; a value that is no number goes right."""
        at = x[:, self.feature]
        return ~(at <= self.low) & ((at <= self.high) | np.isposinf(self.high))


class Ensemble:
    """Nodes of all trees end to end; ``weight`` of each tree."""

    def __init__(self, nodes: list, weight: list[float], features: list[str]):
        self.features, self.weight = features, np.array(weight)
        tree = np.array([n[0] for n in nodes])
        self.root = np.searchsorted(tree, np.arange(len(weight)))
        start = self.root[tree]
        self.feature = np.array([n[1] for n in nodes])
        self.threshold = np.array([n[2] for n in nodes], dtype=float)
        leaf = self.feature < 0
        own = np.arange(len(nodes))
        self.left = np.where(leaf, own, start + [n[3] for n in nodes])
        self.right = np.where(leaf, own, start + [n[4] for n in nodes])
        self.value = np.array([n[5] for n in nodes], dtype=float)
        self.cover = np.array([n[6] for n in nodes], dtype=float)
        self.paths = [self._paths(r) for r in self.root]

    def _paths(self, root: int) -> Paths:
        leaves, edge = [], [(root, {})]
        while edge:
            node, way = edge.pop()
            f = int(self.feature[node])
            if f < 0:
                leaves.append((self.value[node], way))
                continue
            low, high, share = way.get(f, (-np.inf, np.inf, 1.0))
            t = self.threshold[node]
            for child, bounds in ((self.left[node], (low, min(high, t))), (self.right[node], (max(low, t), high))):
                edge.append((child, way | {f: (*bounds, share * self.cover[child] / self.cover[node])}))
        width = max(1, max(len(way) for _, way in leaves))
        slots = [[(f, *b) for f, b in way.items()] + [(0, -np.inf, np.inf, 1.0)] * (width - len(way)) for _, way in leaves]
        feature, low, high, share = (np.array([[s[k] for s in row] for row in slots]) for k in range(4))
        return Paths(feature, low, high, share, np.array([v for v, _ in leaves]))

    @property
    def expected(self) -> float:
        """Mean margin over the training rows' shares."""
        return float(sum(w * (p.value * p.share.prod(axis=1)).sum() for w, p in zip(self.weight, self.paths)))

    def margins(self, x: np.ndarray, stages: list[int]) -> np.ndarray:
        """Margin of each row after the first ``n`` trees, a column per stage."""
        out, total = np.zeros((len(x), len(stages))), np.zeros(len(x))
        rows = np.arange(len(x))
        for k, root in enumerate(self.root, 1):
            at = np.full(len(x), root)
            while (self.feature[at] >= 0).any():
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.weight[k - 1] * self.value[at]
            for j, n in enumerate(stages):
                if n == k:
                    out[:, j] = total
        return out

    def attribution(self, x: np.ndarray) -> np.ndarray:
        """Shapley value of each feature for the margin of each row.

        The game of a leaf pays its value times the product over its features of 1 or 0
        (known, met or not) or of the share (unknown). The weight of a feature set of
        size k among d features is the integral of ``t**k * (1 - t)**(d - 1 - k)``, so a
        leaf gives feature i ``value * (met - share)`` times the integral over 0..1 of the
        product of the others' ``share + (met - share) * t``: a polynomial of degree d - 1,
        for which ceil(d / 2) nodes of Gauss-Legendre are exact.
        """
        out = np.zeros((len(x), len(self.features)))
        for weight, p in zip(self.weight, self.paths):
            node, part = np.polynomial.legendre.leggauss((p.share.shape[1] + 1) // 2)
            gain = p.taken(x) - p.share
            total = np.zeros_like(gain)
            for t, w in zip((node + 1) / 2, part / 2):
                factor = p.share + gain * t
                total += w * factor.prod(axis=2, keepdims=True) / factor
            slot = np.zeros((p.feature.size, len(self.features)))
            slot[np.arange(p.feature.size), p.feature.ravel()] = 1
            out += (weight * p.value[:, None] * gain * total).reshape(len(x), -1) @ slot
        return out


def ensemble(model: PipelineModel, spark: SparkSession, features: list[str]) -> Ensemble:
    """The boosted stage of a fitted pipeline (numeric features only) as arrays."""
    path = scratch_path(spark, "ensemble")
    trees = model.stages[-1]
    trees.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if stored.count() > MOST_NODES:
        raise ValueError(f"an ensemble of more than {MOST_NODES} nodes is not broadcast")
    rows = stored.select(
        "treeID", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", F.lit(0)), "leftChild", "rightChild",
        "prediction", "rawCount", "split.numCategories", "id").orderBy("treeID", "id").collect()
    if any(r[1] >= 0 and r[7] >= 0 for r in rows):
        raise ValueError("splits on categories are not supported")
    return Ensemble([tuple(r[:7]) for r in rows], list(trees.treeWeights), features)


def _numbers(batch: pa.RecordBatch, first: int) -> np.ndarray:
    columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[first:]]
    return np.stack(columns, axis=1) if columns else np.zeros((batch.num_rows, 0))


def attribution(model: PipelineModel, rows: DataFrame, key: str, features: list[str]) -> DataFrame:
    """``(key, feature, phi)``: exact Shapley values of every row's log-odds.

    Unknown features follow the shares of the training rows at each split. The values
    of a row add up to its log-odds minus the mean log-odds over those shares.
    """
    spark = rows.sparkSession
    trees = ensemble(model, spark, features)
    shared, names = spark.sparkContext.broadcast(trees), pa.array(features)
    given = rows.select(key, *[F.col(f).cast("double") for f in features])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                phi = 2 * shared.value.attribution(_numbers(part, 1))  # the margin is half the log-odds
                n, d = phi.shape
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(n), d))),
                     names.take(pa.array(np.tile(np.arange(d), n))), pa.array(phi.ravel())], names=[key, "feature", "phi"])

    kind = given.schema[0].dataType.simpleString()
    return given.mapInArrow(run, f"`{key}` {kind}, feature string, phi double")


def staged_scores(model: PipelineModel, rows: DataFrame, keep: list[str], features: list[str], stages: list[int]) -> DataFrame:
    """``keep`` columns with ``n_trees`` and ``p``: the probability after each number of trees,
    as a model of that many trees with the same settings would give it."""
    spark = rows.sparkSession
    trees = ensemble(model, spark, features)
    if not all(0 < n <= len(trees.weight) for n in stages):
        raise ValueError("stages lie between one tree and all")
    shared = spark.sparkContext.broadcast(trees)
    given = rows.select(*keep, *[F.col(f).cast("double") for f in features])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-2 * shared.value.margins(_numbers(batch, len(keep)), stages)))
            for k, n in enumerate(stages):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(np.full(batch.num_rows, n, np.int32)), pa.array(p[:, k])],
                    names=[*keep, "n_trees", "p"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:len(keep)])
    return given.mapInArrow(run, f"{kinds}, n_trees int, p double")
