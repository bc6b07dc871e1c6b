import numpy as np
import pytest

from beaconry.llm import embedding_dedup as e
from tests.llm.conftest import Union

SCHEMA = "vec_id long, embedding array<float>, label int, node int, place int, copies int"


def rows_of(rng):
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(60):
            base = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 4))):
                rows.append((n, (base + rng.normal(size=8) * 0.1).tolist(), label, 1, 2, 3))
                n += 1
        dense = rng.normal(size=8)
        for _ in range(150):
            rows.append((n, (dense + rng.normal(size=8) * 0.05).tolist(), label, 1, 2, 3))
            n += 1
        for _ in range(30):  # exact copies
            rows.append((n, dense.tolist(), label, 1, 2, 3))
            n += 1
    return rows


def brute(rows, threshold):
    x = np.array([np.asarray(r[1], dtype=np.float32) for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= threshold) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows]))
    np.fill_diagonal(near, False)
    plain = Union()
    for i, j in zip(*np.nonzero(near)):
        plain.join(rows[i][0], rows[j][0])
    return {r[0]: (int(near[i].sum()), plain.find(r[0]), plain.find(r[0]) == r[0]) for i, r in enumerate(rows)}


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(e, "COMPONENT_BLOCK", 64)
    rows = rows_of(np.random.default_rng(6))
    got = e.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), window=8).collect()
    want = brute(rows, 0.93)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    right = sum(found[k] == want[k] for k in want) / len(want)
    links = sum(v[0] for v in found.values()) / sum(v[0] for v in want.values())
    assert right >= 0.97 and 0.98 <= links <= 1


@pytest.mark.parametrize("common", [0.0, 0.5, 0.8])
def test_recall_in_a_cone(spark, common):
    """Vectors around one direction, mean cosine ``common``; planted pairs just above the threshold."""
    rng, dim, n, planted = np.random.default_rng(17), 64, 6000, 200

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    axis = unit(rng.normal(size=dim))

    def apart(x):  # unit vectors at right angles to the axis
        return unit(x - np.outer(x @ axis, axis))

    side = apart(rng.normal(size=(n, dim)))
    inner = (0.935 - common) / (1 - common)
    other = apart(rng.normal(size=(planted, dim)))
    other = unit(other - side[:planted] * np.sum(other * side[:planted], axis=1, keepdims=True))
    near = inner * side[:planted] + np.sqrt(1 - inner**2) * other
    x = np.sqrt(common) * axis + np.sqrt(1 - common) * np.concatenate((side, near))
    rows = [(i, v.tolist(), 1, 1, 2, 3) for i, v in enumerate(x)]
    want = brute(rows, 0.93)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in e.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    links = sum(v[0] for v in want.values())
    assert links >= 2 * planted and all(got[k][0] <= want[k][0] for k in want)
    assert sum(v[0] for v in got.values()) >= 0.99 * links
    assert sum(got[k] == want[k] for k in want) >= 0.995 * len(want)


def test_threshold_judged_alike():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(300, 64)), rng.normal(size=(200, 64))
    at = float(e.row_cosines(x[7:8], y[9:10])[0])
    want = np.array([e.row_cosines(np.repeat(x[i:i + 1], len(y), 0), y) >= at for i in range(len(x))])
    assert (e.block_near(x, y, at) == want).all()


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1),
               (6, [1.0, nan], 1), (7, [inf, 0.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [], 1),
               (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (12, [3e38, 0.0], 1)]
    got = e.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")).collect()
    found = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in got)
    assert found == sorted([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (12, 3, 1, False), (-1, 0, None, True)]
                           + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)])


def test_empty(spark):
    assert e.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [10, 10**6, 10**9])
def test_passes_follow_the_data(n):
    assert 2 <= e.passes_needed(n, 0.93, 32, 0.005) < 400
    assert e.passes_needed(n, 0.93, 32, 0.005) <= e.passes_needed(10 * n, 0.93, 32, 0.005)
