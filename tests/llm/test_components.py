import random

from beaconry.llm.components import components
from tests.llm.conftest import Union


def check(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    plain = Union()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            plain.join(a, b)
    assert got == {n: plain.find(n) for n in plain.up}


def test_random_and_shapes(spark):
    rng = random.Random(1)
    check(spark, [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)])
    check(spark, [(i, i + 1) for i in range(40)])  # a chain
    check(spark, [(99, i) for i in range(60)] + [(200, 201)])  # a hot centre
    check(spark, [(5, 5), (None, 3), (2, 1), (2, 1)])


def test_empty(spark):
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
