import os
import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from beaconry.operators import drivers
from beaconry.operators import monitor as mon
from beaconry.operators.drivers import key_drivers, ranked_drivers, top_drivers
from beaconry.operators.series import detect_anomalies, forecast, z_value
from beaconry.session import shared_root


def test_z():
    assert abs(z_value(0.99) - 2.5758293) < 1e-6


def test_forecast_follows_trend_and_season(spark):
    monday = date(2020, 1, 6)
    data = [(k, monday + timedelta(weeks=w), 100.0 + 2 * w + (10 if w % 4 == 0 else 0)) for k in (1, 2) for w in range(80)]
    df = spark.createDataFrame(data, "k int, ts date, y double")
    out = forecast(df, ["k"], "ts", "y", 4, season=4).collect()
    assert len(out) == 8
    for r in out:
        w = (r["ts"] - monday).days // 7
        assert 80 <= w < 84
        assert abs(r["forecast"] - (100 + 2 * w + (10 if w % 4 == 0 else 0))) < 1
        assert r["lower_bound"] <= r["forecast"] <= r["upper_bound"]


def test_anomalies(spark):
    day = datetime(2024, 1, 1)
    data = [("a", day + timedelta(days=i), 10.0 + i % 3) for i in range(40)]
    data += [("flat", day + timedelta(days=i), 5.0) for i in range(40)]
    data[38] = ("a", day + timedelta(days=38), 50.0)
    data[-1] = ("flat", day + timedelta(days=39), 6.0)
    data.append(("new", day + timedelta(days=39), 1.0))  # no training data: kept, not judged
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, y0 double")
    out = detect_anomalies(df, ["k"], "ts", "y0", day + timedelta(days=30)).collect()
    assert len(out) == 21
    new = next(r for r in out if r["k"] == "new")
    assert (new["basis"], new["forecast"], new["is_anomaly"]) == ("none", None, None)
    assert all(r["basis"] == "season" for r in out if r["k"] != "new")
    assert {(r["k"], r["ts"].day) for r in out if r["is_anomaly"]} == {("a", 8), ("flat", 9)}
    assert all(r["distance"] == 0.0 for r in out if r["k"] == "flat")


def test_drivers_equal_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), rnd.choice("xyz"), rnd.random() < 0.3, rnd.randint(1, 9)) for _ in range(500)]
    df = spark.createDataFrame(data, "d1 string, d2 string, label boolean, m int")
    got = {r["segment"]: r for r in key_drivers(df, "m", "label", ["d1", "d2"]).collect()}
    assert len(got) == 2 + 3 + 6
    t, c = (sum(r[3] for r in data if r[2] is x) for x in (True, False))
    for d1 in "ab":
        for d2 in "xyz":
            mine = [r for r in data if r[0] == d1 and r[1] == d2]
            mt, mc = (sum(r[3] for r in mine if r[2] is x) for x in (True, False))
            r = got[f"d1={d1} & d2={d2}"]
            assert (r["metric_test"], r["metric_control"], r["contribution"]) == (mt, mc, mt - mc)
            assert abs(r["surprise"] - (mt - mc * t / c)) < 1e-9
    top = ranked_drivers(key_drivers(df, "m", "label", ["d1", "d2"]), 3, 6).collect()
    assert sorted(r["rank"] for r in top) == [1, 2, 3]


def wide_rows(spark, dims, n, values):
    rng = random.Random(5)
    data = []
    for i in range(n):
        row = [rng.choice([None, *"abcd"[:values]]) for _ in range(dims)]
        base = 900.0 if row[0] == "a" and row[2] == "b" and i % 2 else 0.0
        data.append((*row, float(rng.randrange(10)) + base, i % 2 == 0))
    names = [f"d{k}" for k in range(dims)]
    return spark.createDataFrame(data, ", ".join(f"{d} string" for d in names) + ", m double, label boolean"), names


def test_search_equals_the_full_lattice(spark):
    df, names = wide_rows(spark, 5, 400, 2)
    full = ranked_drivers(key_drivers(df, "m", "label", names), 12, 2).collect()
    found = top_drivers(df, "m", "label", names, 12, 2).orderBy("rank").collect()
    assert [(r["segment"], r["rank"]) for r in found] == [(r["segment"], r["rank"]) for r in full]
    assert all(abs(a["surprise"] - b["surprise"]) < 1e-6 for a, b in zip(found, full))


def test_search_prunes_fifteen_dimensions(spark):
    df, names = wide_rows(spark, 15, 60, 4)
    found = top_drivers(df, "m", "label", names, 3, 2).orderBy("rank").collect()
    values = [r.asDict() for r in df.collect()]
    control = sum(r["m"] for r in values if not r["label"])
    ratio = sum(r["m"] for r in values if r["label"]) / control
    assert len(found) == 3
    for row in found:
        want = dict(p.split("=") for p in row["segment"].split(" & "))
        inside = [r for r in values if all(str(r[d] or "NULL") == v for d, v in want.items())]
        moved = sum(r["m"] if r["label"] else -r["m"] * ratio for r in inside)
        assert abs(row["surprise"] - moved) < 1e-6
    single = ranked_drivers(key_drivers(df, "m", "label", names, max_depth=1), 1, 2).first()
    assert abs(found[0]["surprise"]) >= abs(single["surprise"]) - 0.01


def test_cells_of_a_task_are_bounded(spark, monkeypatch):
    """F17 to F19: more cells are expanded by more tasks, not by larger ones."""
    df = spark.range(2_000).select("id", (F.col("id") % 7).alias("b"), F.lit(1).alias("m"), (F.col("id") % 2 == 0).alias("label"))
    monkeypatch.setattr(drivers, "CELLS_OF_TASK", 100, raising=False)
    found = key_drivers(df, "m", "label", ["id", "b"])
    assert "RoundRobinPartitioning(21)" in found._jdf.queryExecution().toString()
    assert found.count() == 2_000 + 7 + 2_000


def test_search_forgets_values_that_cannot_matter(spark):
    """Cells that differ in excluded values only are stored once, not per segment (F1)."""
    def stored():
        root = shared_root(spark).removeprefix("file:")
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(root) for f in files)

    df = spark.range(20_000).select(
        F.concat(F.lit("part number "), F.xxhash64("id").cast("string")).alias("a"), (F.col("id") % 2).alias("b"),
        (F.col("id") % 3).alias("c"), (F.col("id") % 5).alias("d"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("e"),
        F.when(F.col("id") % 30 == 1, 40.0).otherwise(1.0).alias("m"), (F.col("id") % 4 < 2).alias("label"))
    names, before = list("abcde"), stored()
    found = top_drivers(df, "m", "label", names, 5, 2).orderBy("rank").collect()
    assert stored() - before < 2_000_000
    full = ranked_drivers(key_drivers(df, "m", "label", names), 5, 2).orderBy("rank").collect()
    assert [r["segment"] for r in found] == [r["segment"] for r in full]


def test_search_of_nothing_and_without_control(spark):
    df, names = wide_rows(spark, 3, 10, 2)
    assert top_drivers(df.limit(0), "m", "label", names, 5).count() == 0
    assert top_drivers(df.filter("label"), "m", "label", names, 5).count() == 5


def test_driver_values_may_be_null(spark):
    data = [("a", None, True, 3), ("a", "x", False, 2), (None, "x", True, 5), (None, None, False, 1)]
    df = spark.createDataFrame(data, "d1 string, d2 string, label boolean, m int")
    got = {r["segment"]: (r["metric_control"], r["metric_test"]) for r in key_drivers(df, "m", "label", ["d1", "d2"]).collect()}
    assert got == {"d1=a": (2, 3), "d1=NULL": (1, 5), "d2=x": (2, 5), "d2=NULL": (1, 3), "d1=a & d2=NULL": (0, 3),
                   "d1=a & d2=x": (2, 0), "d1=NULL & d2=x": (0, 5), "d1=NULL & d2=NULL": (1, 0)}
    assert key_drivers(df, "m", "label", ["d1", "d2"], max_depth=1).count() == 4


def test_anomaly_season_without_training_uses_the_series(spark):
    day = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", day + timedelta(days=i), float(i % 2), i % 2 if i < 30 else 2) for i in range(31)],
                               "k string, ts timestamp_ntz, y0 double, s int")
    r = detect_anomalies(df, ["k"], "ts", "y0", day + timedelta(days=30), season=F.col("s")).first()
    assert (r["basis"], r["forecast"]) == ("series", 0.5)


def test_auc_with_ties(spark):
    rnd = random.Random(2)
    data = [(rnd.randint(0, 1), rnd.randint(0, 20) / 20) for _ in range(300)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "y int, s double")
    for slices in (1, 5):
        assert abs(mon.auc(df, "y", "s", slices).first()["auc"] - want) < 1e-12


def test_report_and_alert(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (1, 0, 0), (2, 0, 0)], "w int, y int, p int")
    report = mon.classification_report(df, "y", "p", [F.col("w")])
    assert {r["w"]: r["f1"] for r in report.collect()} == {1: pytest.approx(2 / 3), 2: None}
    assert tuple(mon.performance_alert(report, "f1", 0.8).first()) == (True, 1)
    assert tuple(mon.performance_alert(report.filter("w = 2"), "f1", 0.8).first()) == (False, 0)
    assert rows(mon.confusion_matrix(df, "y", "p")) == [(0, 0, 2), (1, 0, 1), (1, 1, 1)]


def test_drift(spark):
    day = datetime(2024, 1, 1, 12)
    log = spark.createDataFrame([(day, 0.2, "a"), (day, 0.4, "b"), (day + timedelta(days=1), 0.9, "a")],
                                "at timestamp_ntz, s double, g string")
    base = spark.createDataFrame([(0.3, "a"), (0.5, "a")], "s double, g string")
    out = mon.drift_of_means(log, base, "s", "at").select("n", F.round("difference_of_means", 6))
    assert rows(out) == [(1, 0.5), (2, -0.1)]
    assert mon.drift_of_means(log, base, "s", "at", ["g"]).count() == 2
