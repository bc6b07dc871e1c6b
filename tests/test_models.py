import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from beaconry.functions.sampling import split_train_valid
from beaconry.functions.text import tokens
from beaconry.operators import ml, trees
from beaconry.plans import model_queries as mq
from beaconry.session import Tables, scratch_path

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def base(spark):
    import os
    if not os.path.isdir(DATA):
        pytest.skip("test tables not present")
    return mq.prepared(Tables(spark, DATA))


@pytest.fixture(scope="module")
def model(base):
    return ml.boosted_stages(mq.LABEL, n_trees=5, max_depth=3).fit(mq.split(base)[0])


def test_metrics_in_range_and_auc_agrees(base, model):
    from beaconry.operators import monitor as mon
    _, valid = mq.split(base)
    got = ml.evaluate(model, valid, mq.LABEL)
    assert 0 <= got["val_f1"] <= 1 and 0 <= got["val_auc"] <= 1
    scored = ml.score(model, valid, "c_custkey", [mq.LABEL])
    assert scored.filter("pred_lapse < 0 OR pred_lapse > 1").count() == 0
    exact = mon.auc(scored, mq.LABEL, "pred_lapse").first()["auc"]
    assert abs(exact - got["val_auc"]) < 0.02


def test_attribution_adds_up(base, model):
    """Values of a row sum to its prediction minus the mean of the training rows drawn for it."""
    train, valid = mq.split(base)
    few, draws, size = valid.limit(20), 3, train.count()
    phi = ml.sampled_attribution(model, few, train, "c_custkey", ml.FEATURES, draws)
    total = {r["c_custkey"]: r["s"] for r in phi.groupBy("c_custkey").agg(F.sum("phi").alias("s"), F.count("*")).collect()}
    pred = {r["c_custkey"]: r["pred_lapse"] for r in ml.score(model, few, "c_custkey").collect()}
    back = {r["c_custkey"]: r["pred_lapse"] for r in ml.score(model, train, "c_custkey").collect()}
    order = [back[r["c_custkey"]] for r in train.orderBy(F.xxhash64("c_custkey"), "c_custkey").select("c_custkey").collect()]
    picks = few.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("d")).select(
        "c_custkey", F.pmod(F.xxhash64("c_custkey", "d"), F.lit(size).cast("long")).alias("p")).collect()
    assert set(total) == set(pred)
    for k in total:
        mean = sum(order[r["p"]] for r in picks if r["c_custkey"] == k) / draws
        assert abs(total[k] - (pred[k] - mean)) < 1e-9


def test_versions(spark, base, model):
    from datetime import datetime
    root = scratch_path(spark, "models")
    ml.save_version(model, spark, root, "m", "v1", {"val_auc": 0.6, "val_f1": 0.5}, datetime(2024, 1, 1))
    runs = ml.save_version(model, spark, root, "m", "v2", {"val_auc": 0.7, "val_f1": 0.5}, datetime(2024, 1, 2), default=False)
    assert runs.count() == 2
    loaded = ml.load_default(spark, root, "m")
    assert loaded.stages[-1].getNumTrees == 5


def test_best_run_is_returned(base):
    train, valid = mq.split(base)
    best, metrics, runs = ml.candidate_runs(train, valid, mq.LABEL, [
        {"n_trees": 2, "max_depth": 2, "learning_rate": 0.1}, {"n_trees": 3, "max_depth": 2, "learning_rate": 0.1}])
    rows = runs.collect()
    top = [r for r in rows if r["is_best"]]
    assert len(top) == 1 and len(rows) == 2
    assert top[0]["val_auc"] == max(r["val_auc"] for r in rows) == metrics["val_auc"]
    assert best.stages[-1].getNumTrees == top[0]["n_trees"]


def test_registered_version_is_the_best_run(spark):
    t = Tables(spark, DATA)
    held = mq.chain(t)
    top = held["runs"].filter("is_best").first()
    version = held["versions"].first()
    assert (version["val_auc"], version["val_f1"]) == (top["val_auc"], top["val_f1"])
    assert mq.default_model(t).stages[-1].getNumTrees == top["n_trees"]
    assert mq.chain(Tables(spark, DATA)) is held


def test_refresh_job(spark, base):
    out = mq.refresh_job(Tables(spark, DATA), scratch_path(spark, "job"))
    train, valid = mq.split(base)
    assert out["scores"].count() == base.count()
    assert (out["baseline"].count(), out["log"].count()) == (train.count(), valid.count())
    assert out["log"].filter("pred_lapse IS NULL").count() == 0
    assert out["log"].agg(F.min("scored_at")).first()[0] > out["baseline"].agg(F.max("scored_at")).first()[0]
    assert out["drift"].filter("difference_of_means <> 0").count() > 0
    assert out["quality"].count() == 7


def plain_value(e, node, row, known):
    """Mean prediction below a node when only ``known`` features are known."""
    f = int(e.feature[node])
    if f < 0:
        return e.value[node]
    left, right = e.left[node], e.right[node]
    if f in known:
        return plain_value(e, left if row[f] <= e.threshold[node] else right, row, known)
    share = e.cover[left] / e.cover[node]
    return share * plain_value(e, left, row, known) + (1 - share) * plain_value(e, right, row, known)


def plain_shapley(e, row):
    """Shapley values over all feature subsets."""
    d = len(e.features)

    def pays(known):
        return sum(w * plain_value(e, r, row, known) for w, r in zip(e.weight, e.root))

    game = {s: pays(set(s)) for n in range(d + 1) for s in itertools.combinations(range(d), n)}
    out = np.zeros(d)
    for i in range(d):
        for s, paid in game.items():
            if i not in s:
                weight = math.factorial(len(s)) * math.factorial(d - 1 - len(s)) / math.factorial(d)
                out[i] += weight * (game[tuple(sorted({*s, i}))] - paid)
    return out


def test_exact_attribution_equals_all_subsets(spark, base):
    few = ml.FEATURES[:5]
    train, valid = mq.split(base)
    model = ml.boosted_stages(mq.LABEL, few, n_trees=4, max_depth=5).fit(train)
    e = trees.ensemble(model, spark, few)
    rows = valid.select(*[F.col(f).cast("double") for f in few]).limit(12).collect()
    x = np.array([list(r) for r in rows])
    x[0, 2] = np.nan
    got = e.attribution(x)
    for row, phi in zip(x, got):
        assert np.allclose(plain_shapley(e, row), phi, atol=1e-12)
    assert abs(plain_value_all(e) - e.expected) < 1e-12


def plain_value_all(e):
    return sum(w * plain_value(e, r, None, set()) for w, r in zip(e.weight, e.root))


def test_exact_attribution_adds_up(spark, base, model):
    _, valid = mq.split(base)
    mean = 2 * trees.ensemble(model, spark, ml.FEATURES).expected
    phi = trees.attribution(model, valid, "c_custkey", ml.FEATURES)
    total = {r["c_custkey"]: (r["s"], r["n"]) for r in
             phi.groupBy("c_custkey").agg(F.sum("phi").alias("s"), F.count("*").alias("n")).collect()}
    for r in ml.score(model, valid, "c_custkey").collect():
        s, n = total[r["c_custkey"]]
        assert n == len(ml.FEATURES) and abs(s - (math.log(r["pred_lapse"] / (1 - r["pred_lapse"])) - mean)) < 1e-9
    assert phi.count() == len(ml.FEATURES) * valid.count()
    assert trees.attribution(model, valid.limit(0), "c_custkey", ml.FEATURES).count() == 0


def test_stages_are_smaller_models(base):
    train, valid = mq.split(base)
    whole = ml.boosted_stages(mq.LABEL, n_trees=6, max_depth=3).fit(train)
    small = ml.boosted_stages(mq.LABEL, n_trees=4, max_depth=3).fit(train)
    got = {(r["c_custkey"], r["n_trees"]): r["p"] for r in
           trees.staged_scores(whole, valid, ["c_custkey"], ml.FEATURES, [4, 6]).collect()}
    for model, n in ((small, 4), (whole, 6)):
        for r in ml.score(model, valid, "c_custkey").collect():
            assert abs(got[r["c_custkey"], n] - r["pred_lapse"]) < 1e-12
    with pytest.raises(ValueError, match="stages"):
        trees.staged_scores(small, valid, ["c_custkey"], ml.FEATURES, [5])


def test_grid_fits_once_per_other_setting(base, monkeypatch):
    fits = []
    plain = ml.boosted_stages
    monkeypatch.setattr(ml, "boosted_stages", lambda *a, **k: fits.append(k) or plain(*a, **k))
    best, points = ml.grid_search(mq.split(base)[0], mq.LABEL, {"n_trees": [2, 4], "max_depth": [2, 3], "learning_rate": [0.1]})
    got = points.collect()
    assert len(got) == 4 and len(fits) == 2 * 3 + 1
    top = [r for r in got if r["is_best"]]
    assert len(top) == 1 and top[0]["f1"] == max(r["f1"] for r in got)
    assert best.stages[-1].getNumTrees == top[0]["n_trees"]


def test_training_table_is_spread_over_the_cores(spark, data):
    """Every tree of every fit runs in as many tasks as the stored table has parts (F5 to F8, F10, F11)."""
    base = mq.prepared(Tables(spark, data))
    assert base.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_baseline_runs_without_the_boosted_candidates(spark, data):
    """F13, F16: the baseline fits its own model only."""
    t = Tables(spark, data + "/")
    mq.model_baseline_scores(t)
    assert "runs" not in mq._CHAINS[spark.sparkContext.applicationId, t.folder]


def test_text_fit_has_few_parts_and_hashes_once(spark, tmp_path, monkeypatch):
    """a fit sends a gradient per part and iteration, so parts must not grow with the files."""
    rng = random.Random(5)
    vocabulary = [["calm", "kind", "warm", "the", "of"], ["rage", "hate", "vile", "the", "of"]]
    texts = [(i, " ".join(rng.choices(vocabulary[i % 3 == 0], k=rng.randrange(2, 9)))) for i in range(240)]
    texts += [(240, ""), (241, "unseen words"), (0, "the hate")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(242)], "doc_id long, toxic int")
    docs.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    rows = docs.join(labels, "doc_id").withColumn("words", tokens(F.col("text")))
    train, valid = split_train_valid(rows, "doc_id", "toxic")
    plain = Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="_tf", numFeatures=1 << 18), IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(labelCol="toxic", maxIter=100, regParam=0.01)]).fit(train.coalesce(1)).transform(valid)
    want = {r["toxic"]: (r["n"], round(r["hits"] / r["n"], 4)) for r in plain.groupBy("toxic").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("toxic")).alias("hits")).collect()}

    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: seen.append(
        (df.rdd.getNumPartitions(), [kind for _, kind in df.dtypes])) or fit(self, df))
    small = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        got = {r["toxic"]: (r["n"], r["exact_match"]) for r in mq.text_toxic_trained(Tables(spark, str(tmp_path))).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and sum(n for n, _ in got.values()) > 30
    [(parts, kinds)] = seen
    assert 1 <= parts <= spark.sparkContext.defaultParallelism
    assert "array<string>" not in kinds
