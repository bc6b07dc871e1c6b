"""Naive Bayes text classes, trained and applied by aggregates alone.

Word weights are logarithms in millionths, rounded to whole numbers, so sums do not
depend on their order and a rerun or another engine gives the same scores.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.text import tokens

UNIT = 1_000_000
#: Most words whose weights are broadcast.
COMMON = 1 << 17


@dataclass
class WordModel:
    """One row per word with an array of weights, one per class, and each class's prior.

    ``common`` holds the words that make up at least one in ``COMMON`` of all words
    learnt from, hence at most ``COMMON`` rows; ``words`` holds all.
    """

    classes: list[str]
    words: DataFrame
    priors: list[int]
    common: DataFrame


def _log(value: Column) -> Column:
    return F.round(F.log(value) * UNIT).cast("long")


def learn_classes(docs: DataFrame, text: str, classes: dict[str, Column], rivals: bool) -> WordModel:
    """A model of the boolean ``classes`` from all rows of ``docs`` with a text.

    ``rivals`` true: classes exclude each other, a weight is ln P(word | class). False:
    each class stands alone, a weight is ln P(word | class) - ln P(word | not class).
    Counts are smoothed by one; a NULL class is false. One row of totals reaches the
    driver, the words stay in Spark.
    """
    names = [f"_c{i}" for i in range(len(classes))]
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.col(text).alias("_text"), *[F.coalesce(c, F.lit(False)).alias(n) for n, c in zip(names, classes.values())])
    counts = (rows.select(*names, F.explode(tokens(F.col("_text"))).alias("token")).groupBy("token")
              .agg(F.count("*").alias("_n"), *[F.count_if(n).alias(n) for n in names]).checkpoint())
    words = counts.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", *names)]).first()
    docs_of = rows.agg(F.count("*").alias("_n"), *[F.count_if(n).alias(n) for n in names])

    def share(count: Column, total: int) -> Column:
        return _log((count + 1) / F.lit(float(max(total + words["v"], 1))))

    def weight(n: str) -> Column:
        own = share(F.col(n), words[n])
        return own if rivals else own - share(F.col("_n") - F.col(n), words["_n"] - words[n])

    def prior(n: str) -> Column:
        own = _log((F.col(n) + 1) / (F.col("_n") + 1))
        return own if rivals else own - _log((F.col("_n") - F.col(n) + 1) / (F.col("_n") + 1))

    table = counts.select("token", "_n", F.array(*[weight(n) for n in names]).alias("weights"))
    common = table.filter(F.col("_n") * COMMON >= words["_n"]).drop("_n")
    return WordModel(list(classes), table.drop("_n"), list(docs_of.select(*[prior(n).alias(n) for n in names]).first()), common)


def class_scores(docs: DataFrame, keys: list[str], text: str, model: WordModel, salts: int = 4) -> DataFrame:
    """``keys`` and ``scores`` (array of long, one per class), one row per combination of
    keys, NULLs included; rows of equal keys are scored as one text.

    Words that the model does not know count nothing; a NULL or empty text scores the
    priors. Weights of the common words (at most ``COMMON``, ``WordModel.common``) are
    broadcast and summed in the task that reads the text. All other words of the model are
    joined: each is held ``salts`` times and documents are dealt over them, so that a
    word in every document is no single task; what is shuffled is one row per document and
    distinct word that is not common.
    """
    slots = range(len(model.classes))
    words = docs.select(*keys, F.explode(tokens(F.col(text))).alias("token"))
    weighed = words.join(F.broadcast(model.common), "token").groupBy(*keys).agg(
        *[F.sum(F.col("weights")[i]).alias(f"_s{i}") for i in slots])
    pairs = (words.join(F.broadcast(model.common.select("token")), "token", "left_anti")
             .groupBy(*keys, "token").agg(F.count("*").alias("_times"))
             .withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")))
    table = model.words.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = pairs.join(table, ["token", "_salt"]).select(
        *keys, *[(F.col("weights")[i] * F.col("_times")).alias(f"_s{i}") for i in slots])
    zeros = docs.select(*keys, *[F.lit(0).cast("long").alias(f"_s{i}") for i in slots])
    return (zeros.unionByName(weighed).unionByName(hits).groupBy(*keys).agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in slots])
            .select(*keys, F.array(*[F.col(f"_s{i}") + model.priors[i] for i in slots]).alias("scores")))


def best_class(model: WordModel, scores: str = "scores") -> Column:
    """The class of the highest score; the first one wins a tie."""
    place = F.array_position(F.col(scores), F.array_max(scores))
    return F.element_at(F.array(*[F.lit(c) for c in model.classes]), place.cast("int"))


def class_thresholds(scored: DataFrame, classes: dict[str, Column], scores: str = "scores") -> list[float]:
    """Per class the middle between the mean score of its rows and that of the others.

    A class without rows on one side has no threshold to learn: infinity, never given.
    """
    def middle(i: int, flag: Column) -> Column:
        score, own = F.col(scores)[i], F.coalesce(flag, F.lit(False))
        mean = [F.sum(F.when(side, score)) / F.count_if(side) for side in (own, ~own)]
        return F.coalesce((mean[0] + mean[1]) / 2, F.lit(float("inf"))).alias(f"_t{i}")

    return list(scored.agg(*[middle(i, c) for i, c in enumerate(classes.values())]).first())


def classes_above(model: WordModel, thresholds: list[float], scores: str = "scores") -> Column:
    """Array of the classes whose score reaches their threshold, in the model's order."""
    given = F.array(*[F.when(F.col(scores)[i] >= t, F.lit(c))
                      for i, (c, t) in enumerate(zip(model.classes, thresholds))])
    return F.array_compact(given)


def agreement(rows: DataFrame, by: list[str], hit: Column) -> DataFrame:
    """Rows and share of hits per group, without a hit where ``hit`` is NULL."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits")).withColumn(
        "accuracy", F.round(F.col("hits") / F.col("n"), 4))
