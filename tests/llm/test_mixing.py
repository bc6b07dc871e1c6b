from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from beaconry.llm import mixing as m
from tests.llm.conftest import docs


def test_targets():
    got = m.targets([100, 100, 100], [3, 1, 2], 1.5, 2.0)
    assert np.allclose(got, [200, 250 / 3, 500 / 3])
    assert m.targets([10, 0, 1000], [3, 1, 2], 1.5, 2.0) == [20, 0, 1515 - 20]
    assert m.targets([], [], 1.5, 2.0) == [] and m.targets([0], [3], 1.5, 2.0) == [0.0]


def test_permutation():
    for n in (1, 2, 3, 17, 100, 1025):
        got = m.permuted(np.arange(n), n, 3, 1, 20)
        assert sorted(got.tolist()) == list(range(n))
        for at in {0, n // 2, n - 1}:
            assert m.place_of(int(got[at]), n, 3, 1, 20) == at


def test_slot_plan_meets_targets():
    for size in (1, 7, 8, 9, 100, 1000):
        for target in (0, 1, size * 0.4, size, size * 1.3, size * 2):
            plan = m.slot_plan(size, target, 2, 8, 20)
            n, words = plan["blocks"], 0
            for i in range(plan["slots"]):
                block = int(m.permuted(np.array([i % n]), n, 2, i // n, 20)[0])
                have = min(8, size - block * 8)
                words += min(have, plan["last"]) if i == plan["slots"] - 1 else have
            assert words == round(target)


def test_deal():
    rows = m.deal([50, 0, 7, 130], 20, 1)
    assert rows.sum(axis=0).tolist() == [50, 0, 7, 130] and set(rows.sum(axis=1)[:-1]) == {20}
    assert m.deal([], 20, 1).shape[0] == 0


def table(spark):
    return docs(spark, [" ".join(f"d{i}w{j}" for j in range((i * 37) % 300)) for i in range(90)] + [None, ""])


def test_mix(spark):
    placed, pieces = m.mix(table(spark), block=32, per_shard=16)
    rows = m.taken(placed, pieces).collect()
    assert len(rows) == 92 and all(r["taken"] <= 2 * r["size"] for r in rows)
    per = Counter()
    for r in rows:
        per[r["source"], r["target"]] += r["taken"]
    assert all(n == round(t) for (_, t), n in per.items())
    again = m.taken(*m.mix(table(spark).repartition(5), block=32, per_shard=16)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixed_texts(spark):
    df = table(spark)
    placed, pieces = m.mix(df, block=32, per_shard=16)
    want = {r["doc_id"]: r["taken"] for r in m.taken(placed, pieces).collect() if r["taken"]}
    out = m.mixed_documents(df, block=32, per_shard=16)
    assert out.columns == df.columns
    words, texts = Counter(), {r["doc_id"]: r["text"] for r in df.collect()}
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(texts[r["doc_id"]].split())
    assert words == want


def test_odd_rows(odd, none):
    placed, pieces = m.mix(odd, block=64)
    rows = m.taken(placed, pieces).collect()
    assert len(rows) == odd.count() and all(r["taken"] <= 2 * r["size"] for r in rows)
    out = m.mixed_documents(odd, block=64)
    assert out.columns == odd.columns
    assert sum(len(r["text"].encode().split()) for r in out.collect()) == sum(r["taken"] for r in rows)
    assert m.taken(*m.mix(none)).count() == 0 and m.mixed_documents(none).count() == 0


def test_word_count(odd):
    for r in odd.select("text", m.word_count("text").alias("n")).collect():
        assert r["n"] == len((r["text"] or "").encode().split())
    assert odd.agg(F.sum(m.word_count("text"))).first()[0] > 36_000
