import math
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from beaconry.functions.safe import clamp, div0, parse_score, parse_score_clamped, rate
from beaconry.functions.text import best_label, extract_fields, html_to_text, tokens
from beaconry.operators import bitmaps, cells
from beaconry.operators import chunking as ck
from beaconry.operators import search as se
from beaconry.operators import text as tx
from beaconry.session import scratch_path


def test_safe_functions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "a double, b double")
    got = [tuple(r) for r in df.select(div0(F.col("a"), F.col("b")), rate(F.col("a"), F.col("b"))).collect()]
    assert got == [(0.5, 0.5), (0.0, None), (None, None), (None, None)]
    raw = spark.createDataFrame([("0.75",), ("score 85",), ("none",), (None,)], "r string")
    assert [r[0] for r in raw.select(parse_score(F.col("r"))).collect()] == [0.75, 0.85, 0.5, 0.5]
    assert [r[0] for r in raw.select(parse_score_clamped(F.col("r"))).collect()] == [0.75, 1.0, 0.5, 0.5]
    assert [r[0] for r in df.select(clamp(F.col("b"), 0.5, 1.0)).collect()] == [1.0, 0.5, 1.0, None]


def test_tokens_and_fields(spark):
    df = spark.createDataFrame([("  Élan, vital! x2y",), ("",), ("123",)], "t string")
    assert [r[0] for r in df.select(tokens(F.col("t"))).collect()] == [["élan", "vital", "x", "y"], [], []]
    one = spark.createDataFrame([("mail a.b@c.org from 10.0.0.1",)], "t string").select(extract_fields(F.col("t")).alias("f")).first()["f"]
    assert (one["email"], one["ip_address"], one["phone"]) == ("a.b@c.org", "10.0.0.1", None)


def test_html(spark):
    page = "<html><head><title>t</title></head><body><!-- x --><script>var a='</p>';</script><h1>Big</h1><p>a &amp; b<br>c</p></body></html>"
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(html_to_text(F.col("h"))).first()[0] == "# Big\na & b\nc"


def test_best_label(spark):
    df = spark.createDataFrame([(0, 0), (2, 2), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(best_label({"A": F.col("a"), "B": F.col("b")}, "none")).collect()]
    assert got == ["none", "A", "B"]


def lexicon(spark):
    return spark.createDataFrame([("good", 1), ("nice", 1), ("bad", -1), ("awful", -1)], "token string, polarity int")


def test_sentiment_labels(spark):
    texts = [(1, "good nice day"), (2, "bad"), (3, "good bad"), (4, "a day"), (5, " 12 "), (6, "good nice fine great nice bad")]
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"]: r["sentiment"] for r in tx.overall_sentiment(df, ["id"], "t", lexicon(spark)).collect()}
    assert got == {1: "positive", 2: "negative", 3: "mixed", 4: "neutral", 5: "unknown", 6: "mixed"}


def test_aspects(spark):
    df = spark.createDataFrame([(1, "The price is good. Setup was awful\nbad day"), (2, "nothing")], "id int, t string")
    got = {(r["id"], r["aspect"]): r["sentiment"] for r in
           tx.aspect_sentiment(df, "id", "t", {"p": ["price"], "s": ["setup"]}, lexicon(spark)).collect()}
    assert got == {(1, "p"): "positive", (1, "s"): "negative", (2, "p"): "unknown", (2, "s"): "unknown"}


def test_polarity_learning(spark):
    docs = spark.createDataFrame([(i, "awful the" if i < 6 else "lovely the") for i in range(20)], "id int, t string")
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(20)], "id int, bad int")
    assert rows(tx.learn_polarity(docs, labels, "id", "t", "bad")) == [("awful", -1), ("lovely", 1)]


def test_gate_cascade_frontier(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(40)], "id int, v double")
    gate = {r["approach"]: r["treated"] for r in tx.gate_volume(df, df.limit(8), F.col("v") < 1).collect()}
    assert gate["analyze_all"] == 40 and 0 <= gate["targeted_filter"] <= 40
    routed = tx.cascade(df, F.col("v") / 4, F.lit(0.9)).collect()
    assert {(r["v"], r["escalated"], r["model_used"]) for r in routed} == {
        (0.0, False, "cheap"), (1.0, False, "cheap"), (2.0, True, "strong"), (3.0, False, "cheap")}
    c = spark.createDataFrame([("a", 1.0, 0.5), ("b", 2.0, 0.5), ("c", 3.0, 0.9)], "m string, cost double, q double")
    assert rows(tx.pareto_frontier(c, "cost", "q").select("m", "on_frontier")) == [("a", True), ("b", False), ("c", True)]


def test_write_back(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id int, s double")
    new = spark.createDataFrame([(2, 0.9)], "id int, s double")
    assert rows(tx.write_back(df, new, "id", "s")) == [(1, 0.1), (2, 0.9)]


def test_chunk_spans_cover_the_text():
    rnd = random.Random(1)
    for _ in range(2000):
        text = "".join(rnd.choice(["a", "bb ", "ccc\n", "d\n\n", " ", "e" * 23]) for _ in range(rnd.randint(1, 60)))
        size, overlap = rnd.choice([5, 10, 30]), rnd.choice([0, 2, 4])
        spans = ck.chunk_spans(text, size, overlap)
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        assert all(0 < b - a <= size for a, b in spans)
        for (a, b), (c, d) in zip(spans, spans[1:]):
            assert a < c <= b < d and b - c <= overlap


def test_chunks_in_spark(spark):
    df = spark.createDataFrame([(1, "one two three four five"), (2, "x"), (3, "")], "id int, t string")
    got = rows(ck.recursive_chunks(df, ["id"], "t", 10, 4))
    assert got == [(1, 0, "one two "), (1, 1, "two three "), (1, 2, "four five"), (2, 0, "x")]
    fixed = rows(ck.fixed_chunks(df, ["id"], "t", 10, 2))
    assert fixed[:3] == [(1, 0, "one two th"), (1, 1, "three four"), (1, 2, "ur five")] and (3, 0, "") in fixed


def test_headers(spark):
    df = spark.createDataFrame([("CALL_ID: CE-1\nhello",), ("CALL_ID:  ZZ-2",), ("none",)], "t string")
    assert rows(ck.header_fields(df, "t").select("call_id", "call_type")) == [
        ("CE-1", "compliance"), ("ZZ-2", "other"), (None, "other")]


DOCS = [(1, "red fox red", "a"), (2, "blue fox", "b"), (3, "green owl", "a"), (4, "red owl and a fox in the sun", "b")]


def bm25(query):
    docs = {i: t.split() for i, t, _ in DOCS}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, w in docs.items():
        s = 0.0
        for q in se.query_terms(query):
            df = sum(q in d for d in docs.values())
            tf = w.count(q)
            s += math.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(w) / mean))
        if s > 0:
            out[i] = s
    return out


def test_keyword_search_equals_brute_force(spark):
    df = spark.createDataFrame(DOCS, "id int, t string, g string")
    want = bm25("Red, OWL red!")
    got = {r["id"]: r["keyword_score"] for r in se.keyword_search(df, "id", "t", "Red, OWL red!", 10, ["g"]).collect()}
    assert got == {i: round(s, 6) for i, s in want.items()}
    only = se.keyword_search(df, "id", "t", "red owl", 10, [], {"g": "a"}).collect()
    assert {r["id"]: r["keyword_score"] for r in only} == {i: round(s, 6) for i, s in bm25("red owl").items() if i in (1, 3)}
    stored = se.search_index(se.build_index(df, "id", "t"), se.corpus_size(df, "t"), "id", "red owl", 10)
    assert {r["id"]: r["keyword_score"] for r in stored.collect()} == {i: round(s, 6) for i, s in bm25("red owl").items()}
    assert se.keyword_search(df, "id", "t", "zebra", 5, []).count() == 0


def test_vector_and_hybrid(spark):
    vec = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])]
    v = spark.createDataFrame(vec, "id int, v array<float>")
    q = se.vector_of(v, "id", "v", 1)
    got = [(r["id"], r["vector_score"]) for r in se.vector_search(v, "id", "v", q, 3).collect()]
    assert got == [(1, 1.0), (3, 0.707107), (2, 0.0)]
    docs = spark.createDataFrame(DOCS + [(9, "a fox without a vector", "c")], "id int, t string, g string")
    top = se.hybrid_search(docs, v, "id", "t", "v", "blue fox", q, 9, ["g", "t"]).collect()
    assert len(top) == 5 and top[0]["score"] >= top[-1]["score"]
    ranks = {r["id"]: (r["keyword_rank"], r["vector_rank"]) for r in top}
    assert ranks[2][0] == 1 and ranks[3][0] is None and ranks[9][1] is None and ranks[9][0] is not None
    only = se.hybrid_search(docs, v, "id", "t", "v", "blue fox", q, 9, ["g"], {"g": "a"}).collect()
    assert {r["id"] for r in only} == {1, 3} and {r["keyword_rank"] for r in only} == {1, None}
    text = se.cited_context(spark.createDataFrame(top).limit(2).withColumn("_o", -F.col("score")), "g", "id", "t", ["_o", "id"]).first()[0]
    assert text.count("\n---\n") == 1


def test_long_turns_stay_in_order(spark):
    lines = [(1, -1, 0, "CALL_ID: CS-1")] + [(1, t, p, f"{t}.{p}") for t in range(2) for p in range(1500)]
    df = spark.createDataFrame(lines, "id int, turn long, pos int, line string").repartition(4)
    text = ck.reassemble(df, "id", ["turn", "pos"], "line", "t").first()["t"]
    assert text == "\n".join(x[3] for x in lines)


def test_threshold_algorithm_equals_full_fusion(spark):
    import random

    rng = random.Random(5)
    for case in range(6):
        lists = []
        for _ in range(2):
            rows = [(d, rng.choice([None, round(rng.random(), 1 + case % 3)])) for d in range(700) if rng.random() < (0.9, 0.05)[case % 2]]
            rng.shuffle(rows)
            lists.append(rows)
        ranks = [{d: i for i, (d, _) in enumerate(sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else -9), r[0])), 1)}
                 for rows in lists]
        want = sorted(((-round(sum(1 / (60 + r[d]) for r in ranks if d in r), 8), d) for d in {*ranks[0], *ranks[1]}))
        k = (1, 10, 40, 300)[case % 4]
        frames = {n: spark.createDataFrame(rows, "id int, _s double") for n, rows in zip(("x", "y"), lists)}
        got = se.fused_top(frames, "id", k).collect()
        assert [(r["id"], r["x"], r["y"]) for r in got] == [(d, ranks[0].get(d), ranks[1].get(d)) for _, d in want[:k]]
        assert all(abs(r["score"] + s) < 2e-8 for r, (s, _) in zip(got, want))
    empty = {n: f.limit(0) for n, f in frames.items()}
    assert se.fused_top(empty, "id", 3).count() == 0


@pytest.mark.parametrize("digits", [6, 2])
def test_cells_are_exact_and_mostly_unread(spark, digits):
    import numpy as np

    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 3000)] + 0.1 * rng.normal(size=(3000, 16))
    x[5], x[6] = 0, x[7]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)] + [(3000, None, 0), (3001, [float("nan")] * 16, 0), (None, x[8].tolist(), 1)]
    table = spark.createDataFrame(rows, "id long, v array<double>, mark int").repartition(3)
    path = scratch_path(spark, "cells")
    cells.build_cells(table, "v", path, 30)
    assert spark.read.parquet(f"{path}/rows").count() == len(rows)
    unit = x / np.maximum(np.sqrt((x ** 2).sum(1)), 1e-300)[:, None]
    for q in (7, 100):
        cosine = [(-round(float(unit[i] @ unit[q]), digits), i) for i in range(3000) if i != 5]
        cosine.append((-round(float(unit[8] @ unit[q]), digits), -1))  # the null id sorts first
        want = [None if i < 0 else i for _, i in sorted(cosine)[:10]]
        got, read, there = cells.nearest_in_cells(spark, path, "id", "v", x[q].tolist(), 10, ["mark"], digits)
        assert [r["id"] for r in got.collect()] == want
        assert there == 31 and read < there / 2
    everything, read, there = cells.nearest_in_cells(spark, path, "id", "v", x[7].tolist(), 4000)
    assert everything.count() == len(rows) and read == there
    cells.build_cells(table.limit(0), "v", scratch_path(spark, "cells"), 4)


def test_keyword_search_carries_text(spark):
    docs = spark.createDataFrame([(1, "red owl", "a"), (2, "owl", "b"), (3, "fox", "a")], "id int, t string, g string")
    got = se.keyword_search(docs, "id", "t", "owl", 5, ["g", "t"]).collect()
    assert [(r["id"], r["g"], r["t"]) for r in got] == [(2, "b", "owl"), (1, "a", "red owl")]


def test_bitmaps_are_filters(spark):
    rng = random.Random(7)
    rows = [(rng.randint(-100_000, 100_000), rng.choice(["a", "b", "c", None]), rng.choice([True, False, None])) for _ in range(5000)]
    rows = list({r[0]: r for r in rows}.values()) + [(None, "a", True)]
    table = spark.createDataFrame(rows, "id long, x string, y boolean")
    stored = bitmaps.store_bitmaps(bitmaps.build_bitmaps(table, "id", {"x": F.col("x"), "y": F.col("y")}), scratch_path(spark, "bitmaps"))
    allowed = bitmaps.matching(stored, {"x": ["a", "b"], "y": ["true"]})
    want = sorted(i for i, x, y in rows if i is not None and x in ("a", "b") and y)
    assert sorted(r["id"] for r in bitmaps.restrict(table, "id", allowed).collect()) == want
    assert bitmaps.size_of(allowed).first()[0] == len(want)
    assert bitmaps.size_of(bitmaps.matching(stored, {"x": ["z"]})).first()[0] == 0
    plan = bitmaps.matching(stored, {"x": ["a"]})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters: [" in plan


def test_postings_are_shuffled_once(spark):
    data = [(1, "red owl Red"), (1, "owl red red"), (2, ""), (3, None), (None, "b a"), (None, "a c"), (4, "x")]
    df = spark.createDataFrame(data, "id long, t string").repartition(3)
    want = Counter((w, i, len(t.split())) for i, t in data if t for w in t.lower().split())
    for by_term in (False, True):
        index = se.build_index(df, "id", "t", by_term)
        assert {(r["term"], r["id"], r["doc_len"]): r["tf"] for r in index.collect()} == want
    plan = index.sortWithinPartitions("term")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1
