import math
import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from beaconry.operators import bayes
from beaconry.operators import text as tx
from beaconry.operators.sketches import error_bound, merged_counts, read_day_sketches, write_day_sketches
from beaconry.session import scratch_path


def labelled(spark):
    rng = random.Random(3)
    vocabulary = {"pay": ["bill", "card", "fee", "the"], "ship": ["box", "late", "van", "the"]}
    data = [(i, " ".join(rng.choices(vocabulary[kind], k=rng.randrange(1, 9))), kind)
            for i, kind in enumerate(rng.choices(["pay", "ship"], k=60))]
    data += [(100, None, "pay"), (101, "", "ship"), (102, "the the unseen", None), (None, "box van", "ship")]
    return data, spark.createDataFrame(data, "id long, text string, kind string")


def test_scores_equal_plain_naive_bayes(spark):
    data, df = labelled(spark)
    kinds = ["pay", "ship"]
    model = bayes.learn_classes(df, "text", {k: F.col("kind") == k for k in kinds}, rivals=True)
    got = {(r["id"], r["text"]): list(r["scores"])
           for r in bayes.class_scores(df, ["id", "text"], "text", model, salts=3).collect()}
    counts = {k: Counter(w for _, t, c in data if t and c == k for w in t.split()) for k in kinds}
    known = {w for _, t, _ in data if t for w in t.split()}
    texts = [r for r in data if r[1] is not None]

    def log(x):
        return round(math.log(x) * bayes.UNIT)

    for key, text, _ in data:
        want = [log((sum(c == k for _, _, c in texts) + 1) / (len(texts) + 1))
                + sum(log((counts[k][w] + 1) / (counts[k].total() + len(known))) for w in (text or "").split())
                for k in kinds]
        assert got[key, text] == want


def test_classes_of_held_out_rows(spark):
    _, df = labelled(spark)
    classes = {k: F.col("kind") == k for k in ("pay", "ship")}
    model = bayes.learn_classes(df.filter("id % 3 != 0"), "text", classes, rivals=True)
    scored = bayes.class_scores(df.filter("id % 3 = 0 AND text RLIKE '[^the ]'"), ["id", "kind"], "text", model)
    report = bayes.agreement(scored, [], bayes.best_class(model) == F.col("kind")).first()
    assert report["n"] > 10 and report["accuracy"] >= 0.9


def test_several_classes_and_no_learning_rows(spark):
    _, df = labelled(spark)
    classes = {"ship": F.col("kind") == "ship", "never": F.lit(None).cast("boolean")}
    model = bayes.learn_classes(df, "text", classes, rivals=False)
    scored = bayes.class_scores(df, ["id", "kind"], "text", model)
    limits = bayes.class_thresholds(scored, classes)
    assert limits[1] == math.inf
    rows = scored.filter("id < 100").withColumn("tags", bayes.classes_above(model, limits)).collect()
    assert all("never" not in r["tags"] for r in rows)
    assert sum((r["tags"] == ["ship"]) == (r["kind"] == "ship") for r in rows) >= 0.85 * len(rows)
    empty = bayes.learn_classes(df.limit(0), "text", classes, rivals=True)
    assert {len(r["scores"]) for r in bayes.class_scores(df, ["id"], "text", empty).collect()} == {2}


def test_day_sketches_replace_and_merge(spark):
    day = datetime(2024, 3, 1)
    rng = random.Random(1)
    data = [(day + timedelta(days=rng.randrange(5)), g, rng.randrange(3000)) for g in "ab" for _ in range(6000)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, g string, u long")
    path = scratch_path(spark, "test-sketches")
    write_day_sketches(df, path, "ts", ["g"], "u")
    write_day_sketches(df.filter("day(ts) = 2"), path, "ts", ["g"], "u")  # comes again
    daily = read_day_sketches(spark, path)
    assert daily.count() == 10
    for row in merged_counts(daily, ["g"]).collect():
        users = {u for _, g, u in data if g == row["g"]}
        assert row["n_rows"] == 6000
        assert abs(row["distinct_estimate"] - len(users)) <= error_bound(12) * len(users)


def test_aspects_keep_rows_without_words(spark):
    docs = spark.createDataFrame([(1, "good with bread. bad"), (None, "bad with"), (2, None), (3, "nothing")], "k int, t string")
    words = spark.createDataFrame([("good", 1), ("bad", -1)], "token string, polarity int")
    out = tx.aspect_sentiment(docs, "k", "t", {"food": ["bread"], "company": ["with"]}, words)
    got = {(r["k"], r["aspect"]): (r["words"], r["pos"], r["neg"], r["sentiment"]) for r in out.collect()}
    assert got[1, "food"] == got[1, "company"] == (3, 1, 0, "positive")
    assert got[None, "company"] == (2, 0, 1, "negative")
    assert got[3, "food"] == (0, 0, 0, "unknown")


def test_scores_are_alike_however_many_words_are_broadcast(spark, monkeypatch):
    _, df = labelled(spark)
    classes = {k: F.col("kind") == k for k in ("pay", "ship")}
    got, held = [], []
    for most in (1, 8, 1 << 17):
        monkeypatch.setattr(bayes, "COMMON", most)
        model = bayes.learn_classes(df, "text", classes, rivals=False)
        held.append(model.common.count())
        got.append(sorted(map(str, bayes.class_scores(df, ["id", "kind"], "text", model).collect())))
    assert held[0] == 0 < held[1] < held[2] == model.words.count() and held[1] <= 8
    assert got[0] == got[1] == got[2]


def test_themes_count_a_text_once(spark):
    data = [("a", "Red red owl"), ("a", None), ("b", "owl b"), (None, "red x x x"), ("b", ""), ("a", "owl-red")]
    df = spark.createDataFrame(data, "g string, t string")
    for group, least in (("g", 2), (None, 1)):
        want = Counter()
        words = [(g, [w for w in (t or "").lower().replace("-", " ").split() if len(w) >= least]) for g, t in data]
        spread = Counter(w for _, ws in words for w in set(ws))
        for g, ws in words:
            want.update((g, w) if group else (w,) for w in ws)
        out = tx.theme_weights(df, group, "t", least)
        assert {tuple(r)[:-3]: (r["tf"], r["df"], r["weight"]) for r in out.collect()} == {
            k: (n, spread[k[-1]], round(n * math.log(len(data) / spread[k[-1]]), 4)) for k, n in want.items()}
        # Groups and the whole corpus take their numbers from stored counts, not from the texts again.
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == (0 if group else 2)
