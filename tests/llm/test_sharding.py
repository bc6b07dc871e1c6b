import zlib
from collections import Counter, defaultdict

import numpy as np

from beaconry.llm import sharding as s
from tests.llm.conftest import docs


def check(df, shards, spread):
    rows = s.shard_records(df, shards).collect()
    texts = Counter((r["doc_id"], (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        {(i, len(t) + 8, zlib.crc32(t)): n for (i, t), n in texts.items()})
    places, sizes = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r["shard"] < shards
        places[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert max(sizes.values()) - min(sizes[i] for i in range(shards)) <= spread


def test_shards(spark, data, odd, none):
    check(spark.read.parquet(f"{data}/documents.parquet"), 24, 60)
    check(docs(spark, ["x" * (i % 50) for i in range(3000)]), 7, 5)
    check(odd, 3, 300_000)  # one text is larger than a fair share
    assert s.shard_records(none, 4).count() == 0


def test_repeated_rows_spread(spark, monkeypatch):
    """600 equal rows beside 1,000 others: the law of equal bytes holds all the same."""
    for run in (4096, 100):
        monkeypatch.setattr(s, "RUN", run)
        rows = [(7, "copy " * 20)] * 600 + [(i, "x" * (i % 90)) for i in range(1000)] + [(None, None)] * 50
        check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 24, 60)


def test_map_versions(spark, tmp_path):
    folder = str(tmp_path / "maps")
    s.shard_records(docs(spark, ["word " * (i % 9) for i in range(500)]), 5, slots=64, folder=folder).count()
    first, edited = ({r[0]: r[1] for r in s.load_map(spark, folder, v).collect()} for v in (0, 1))
    assert first == {i: i % 5 for i in range(64)} and set(edited) == set(range(64))
    assert any(first[i] != edited[i] for i in first)


def test_rebalance_and_grow():
    rng = np.random.default_rng(8)
    loads = rng.integers(0, 1000, 512).astype(float)
    placed = s.rebalance(s.first_map(10, 512), loads, 10)
    totals = np.bincount(placed, weights=loads, minlength=10)
    assert totals.max() - totals.min() <= 2
    more = s.grow(placed, loads, 10)
    moved = more != placed
    assert (more[moved] == 10).all() and moved.any()
    totals = np.bincount(more, weights=loads, minlength=11)
    assert totals.max() / totals.mean() < 1.1
    hot = np.zeros(64)
    hot[3] = 1e9  # one slot with nearly everything ends all the same
    assert len(s.rebalance(s.first_map(4, 64), hot + 1, 4)) == 64
