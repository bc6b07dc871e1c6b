import random

import numpy as np
import pytest
import xxhash

from beaconry.llm import simhash as s
from tests.llm.conftest import Union, docs


def plain(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashed = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def groups(ids, prints, distance):
    union = Union()
    for i, a in enumerate(prints):
        union.find(i)
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                union.join(j, i)
    roots = [union.find(i) for i in range(len(ids))]
    return [min((ids[j] for j in range(len(ids)) if roots[j] == r and ids[j] is not None), default=None) for r in roots]


def check(df, distance=4):
    rows = [(r["doc_id"], plain(r["text"], 4)) for r in df.select("doc_id", "text").collect()]
    want = sorted(zip([r[0] for r in rows], [r[1] for r in rows], groups(*zip(*rows), distance)), key=str)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"])
                  for r in s.simhash_groups(df, distance=distance).collect()), key=str)
    assert got == want


def test_whole_table(spark, data):
    check(spark.read.parquet(f"{data}/documents.parquet"))


def test_odd_rows(odd, none):
    check(odd)
    assert s.simhash_groups(none).count() == 0


def near_prints(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 12)]
    out = set()
    for b in base:
        for _ in range(rng.choice((1, 2, 40))):
            out.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (2**64 - 1))
    return sorted(out)


@pytest.mark.parametrize(("distance", "large"), [(4, s.LARGE_BUCKET), (4, 3), (8, s.LARGE_BUCKET), (8, 5)])
def test_links_connect_like_brute_force(spark, distance, large):
    prints = near_prints(random.Random(11), 240)
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long")
    union = Union()
    for r in s.link_fingerprints(df, distance, large).collect():
        a, b = r["a"] % 2**64, r["b"] % 2**64
        assert (a ^ b).bit_count() <= distance
        union.join(a, b)
    got = [union.find(p) for p in prints]
    assert got == [prints[g] for g in np.array([groups(list(range(len(prints))), prints, distance)]).ravel()]


def test_allocation_obeys_the_principle():
    rng = np.random.default_rng(12)
    x = rng.random((500, 64)) < rng.random(64)
    joint = x.T.astype(float) @ x
    for distance in (0, 1, 4, 9):
        plan = s.allocate(10**6, joint * 2000, distance)
        assert sum(t + 1 for _, t in plan) == distance + 1
        assert len({b for bits, _ in plan for b in bits}) == sum(len(bits) for bits, _ in plan)


def test_forest():
    rng = random.Random(13)
    x = np.array(near_prints(rng, 200), dtype=np.uint64)
    i, j = s.forest(x, 4)
    assert len(i) < len(x)
    union, want = Union(), Union()
    for a, b in zip(i.tolist(), j.tolist()):
        union.join(a, b)
    for a in range(len(x)):
        for b in range(a):
            if int(x[a] ^ x[b]).bit_count() <= 4:
                want.join(b, a)
    assert [union.find(k) for k in range(len(x))] == [want.find(k) for k in range(len(x))]


def test_keep_one(spark, odd, none):
    rng = random.Random(14)
    words = [f"word{i}" for i in range(2000)]
    clean = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(40)]
    copies = list(clean[:10])
    near = []
    for t in clean[10:20]:
        w = t.split()
        w[150] = "changed"
        near.append(" ".join(w))
    df = docs(spark, clean + copies + near)
    out = s.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(40))
    kept = s.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "2", "None", "5", "6", "7", "8"])
    assert s.keep_one(none).count() == 0


def test_similarity():
    a, b = (s.sketch(s.shingle_bytes(t, 2)) for t in ("a b c d e", "a b c d f"))
    assert s.similarity(a, b) == 3 / 5
    assert s.similarity(b"", b"") == 1 and s.similarity(a, b"") == 0


def test_alike_is_similarity():
    rng = np.random.default_rng(15)
    shared = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate((shared[:n], rng.integers(0, 2**63, m).astype(np.uint64))))[:s.SKETCH].tobytes()
            for n in (3, 90, 250, 300) for m in (1, 20, 40, 200)]
    for least in (0.5, 0.8):
        alike = s.Alike(sets, np.zeros(len(sets), int), least, 0)
        for i in range(len(sets)):
            want = [s.similarity(sets[i], x) >= least for x in sets]
            assert alike(i, np.arange(len(sets))).tolist() == want


def template(n, planted, seed):
    """Texts of one template, no two alike, and near copies of the first ``planted``."""
    rng = random.Random(seed)
    frame = [f"frame{i}" for i in range(240)]
    texts = [" ".join(frame + [f"own{rng.getrandbits(40)}" for _ in range(60)]) for _ in range(n)]
    return texts, [t.replace("frame7 ", f"other{i} ", 1) for i, t in enumerate(texts[:planted])]


def test_similar_pairs_in_a_template_cluster(spark):
    """Unlike texts within the distance must not hide the true links between others."""
    texts, copies = template(1500, 150, 16)
    prints = [s.fingerprint(t, 5) % 2**64 for t in texts[:40]]
    assert sum((a ^ b).bit_count() <= 12 for a in prints for b in prints) > 40 * 8
    kept = {r["doc_id"] for r in s.keep_one(docs(spark, texts + copies)).select("doc_id").collect()}
    union = Union()
    rows = [(s.fingerprint(t, 5) % 2**64, s.sketch(s.shingle_bytes(t, 5))) for t in texts + copies]
    for i, (a, x) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][0]).bit_count() <= 12 and s.similarity(x, rows[j][1]) >= 0.8:
                union.join(i, j)
    want = {i for i in range(len(rows)) if union.find(i) == i}
    assert kept == want and len(want) < len(rows) - 140


def test_a_repeated_line_does_not_merge_texts(spark):
    """One line sets all bits of the fingerprint; the rest says which texts are alike."""
    rng = random.Random(17)
    line = " ".join(f"line{i}" for i in range(7))
    rest = [[f"own{rng.getrandbits(40)}" for _ in range(400)] for _ in range(60)]
    rest += [[*r[:-1], "changed"] for r in rest[:20]]
    texts = [" ".join([line] * 80 + r) for r in rest]
    assert len({s.fingerprint(t, 5) for t in texts}) < 10
    assert sorted(r["doc_id"] for r in s.keep_one(docs(spark, texts)).select("doc_id").collect()) == list(range(60))
