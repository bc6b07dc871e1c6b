import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.llm import language_id as lid


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return lid.learn(documents.filter(lid.fold_of("doc_id") != 2))


def test_held_out_accuracy(documents, model):
    held = documents.filter(lid.fold_of("doc_id") == 2)
    got = (lid.identify(held, model).join(held.select(F.col("doc_id").alias("id"), "lang"), "id")
           .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"),
                F.avg(F.col("accepted").cast("int"))).first())
    assert got[0] >= 0.97 and 0 <= got[1] and got[2] <= 1 and got[3] == 1


def test_probabilities_add_up(spark):
    """Over the characters of the alphabet, and one more, each context sums to 1."""
    texts = ["abba ab", "abab b", "aabb ba ab"]
    learned = lid.learn(spark.createDataFrame([(t, lang) for t in texts for lang in ("x", "y")], "text string, lang string"))
    for context in ("   ", "  a", " ab", "abz"):
        packed = [sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context + last)) for last in "ab z"]
        chance = np.exp2(learned.log2(np.array(packed, dtype=np.uint64)))
        assert np.allclose(chance.sum(axis=0), 1, atol=1e-6)


def test_odd_rows(odd, none, model):
    rows = odd.select("doc_id", "text").collect()
    got = lid.identify(odd, model).collect()
    assert len(got) == len(rows)
    by_id = {r["id"]: r for r in got if r["id"] is not None}
    for i in (2, 3, 4, 6):  # null, empty, blank, no letter
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["accepted"]) == ("und", 0.0, False)
    assert by_id[9]["lang_pred"] in model.languages
    assert lid.identify(none, model).count() == 0
    assert lid.learn(none) is None
    assert {r["lang_pred"] for r in lid.identify(odd, None).collect()} == {"und"}
    assert lid.accepted(odd, None).count() == 0


def test_rejects_what_is_no_language(spark, documents, model):
    rng = random.Random(7)
    noise = [("".join(rng.choice("bcdfghjklmnpqrstvwxzéüñ") for _ in range(400)),) for _ in range(20)]
    assert lid.accepted(spark.createDataFrame(noise, "text string"), model).count() == 0
    kept = lid.accepted(documents, model)
    assert kept.columns == documents.columns and kept.count() == documents.count()


def test_rerun_agrees(documents, model):
    again = lid.learn(documents.filter(lid.fold_of("doc_id") != 2))
    assert all((a == b).all() for a, b in zip(model.chances, again.chances))
    assert (model.limits == again.limits).all()


def test_a_rare_language_has_its_own_limit(spark):
    rng = random.Random(8)

    def text(letters):
        words = ["".join(rng.choice(letters) for _ in range(4)) for _ in range(12)]
        return " ".join(rng.choice(words) for _ in range(60))

    rows = [(text("abcde"), "x") for _ in range(400)] + [(text("mnopq"), "y") for _ in range(3)]
    df = spark.createDataFrame(rows, "text string, lang string")
    learned = lid.learn(df, calibration_rows=4)
    assert np.isfinite(learned.limits).all()
    costs = lid._scored(df.select("lang", "text"), learned).filter("lang_pred = id").groupBy("id").agg(F.max("cost")).collect()
    assert all(learned.limits[learned.languages.index(lang)] >= cost for lang, cost in costs)
    assert lid.accepted(df, learned).count() == len(rows)


def test_one_scoring_gives_the_same(documents, model, odd, none):
    learns = lid.fold_of("doc_id") != 2
    once = {r["id"]: r for r in lid.learn_and_identify(documents, learns).collect()}
    for r in lid.identify(documents, model).collect():
        assert r == once[r["id"]]
    kept = lid.learn_and_accept(documents)
    assert kept.columns == documents.columns
    assert sorted(kept.collect()) == sorted(lid.accepted(documents, lid.learn(documents)).collect())
    got = lid.learn_and_accept(odd)
    assert got.schema.names == odd.schema.names and sorted(got.collect(), key=repr) == sorted(
        lid.accepted(odd, lid.learn(odd)).collect(), key=repr)
    assert lid.learn_and_accept(none).count() == 0 and lid.learn_and_identify(none, learns).count() == 0


def test_numerals_are_no_letters(spark, model):
    texts = ["\u00bd \u00b2", "\u2460", "\u2167", "1_2", "\u00bd caf\u00e9 the"]
    got = lid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("id").collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, True, True, False]


def test_limits_follow_from_all_rows(spark, model, documents):
    """the cost of shuffled letters is their mean over all rows, not that of a sample."""
    learns = documents.filter(lid.fold_of("doc_id") != 2)
    one, other = (lid.learn(learns, calibration_rows=n) for n in (1, 500))
    assert (one.limits == other.limits).all()
    fitted, counted = lid._fit(lid._labelled(learns, "text", "lang"))
    costs = lid._shuffled_costs(fitted, counted)
    grams = counted.toPandas()
    rng = np.random.default_rng(3)
    for i, name in enumerate(fitted.languages):  # drawn texts come to the same mean
        own = grams[grams["lang"] == name]
        picked = rng.choice(own["gram"].to_numpy(), 40_000, p=own["n"] / own["n"].sum()).view(np.uint64)
        last = own["gram"].to_numpy() & 0xFFFF
        share = np.where(last == 32, 0, own["n"])
        made = np.zeros(len(picked), np.uint64)
        for k in range(lid.ORDER):
            c = (picked >> np.uint64(16 * k)) & np.uint64(0xFFFF)
            drawn = rng.choice(last, len(picked), p=share / share.sum()).astype(np.uint64)
            made |= np.where(c == 32, np.uint64(32), drawn) << np.uint64(16 * k)
        drawn_cost = (-fitted.log2(made).mean(axis=0)).min()
        assert abs(drawn_cost - costs[i]) < 0.15
