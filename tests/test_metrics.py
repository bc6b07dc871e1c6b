import pytest
from conftest import rows

from beaconry.operators.metrics import (Dimension, Fact, Metric, MetricModelError, Model, Ratio,
                                        Relationship, Table, catalog, check_enums, check_keys,
                                        query, resolve_path)


@pytest.fixture(scope="module")
def model(spark):
    brands = spark.createDataFrame([(1, "A"), (2, "B")], "b int, brand string")
    people = spark.createDataFrame([(1, 1, "N"), (2, 1, None), (3, 2, "S")], "p int, pb int, region string")
    camps = spark.createDataFrame([(1, 2, "flow")], "c int, cb int, kind string")
    orders = spark.createDataFrame([(1, 1, 1, 10.0), (2, 1, 1, 20.0), (3, 2, None, 5.0), (4, 9, 1, 7.0)],
                                   "o int, op int, oc int, amount double")
    sends = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 2)], "s int, sp int")
    return Model(
        "m", (Table("brands", brands, ("b",), True, ("stores",)), Table("people", people, ("p",)),
              Table("camps", camps, ("c",), True), Table("orders", orders, ("o",)), Table("sends", sends, ("s",))),
        (Relationship("people_brands", "people", ("pb",), "brands"), Relationship("camps_brands", "camps", ("cb",), "brands"),
         Relationship("orders_people", "orders", ("op",), "people"), Relationship("orders_camps", "orders", ("oc",), "camps"),
         Relationship("sends_people", "sends", ("sp",), "people")),
        (Fact("orders", "big", "IF(amount >= 10, 1, 0)"),),
        (Dimension("brands", "brand", "brand"), Dimension("people", "region", "region", ("geo",), ("N", "S")),
         Dimension("camps", "kind", "kind")),
        (Metric("orders", "revenue", "sum", "amount", ("sales",)), Metric("orders", "orders_n", "count", "o"),
         Metric("orders", "avg_amount", "avg", "amount"), Metric("orders", "largest", "max", "amount"),
         Metric("orders", "big_n", "sum", "big"), Metric("sends", "sends_n", "count", "s"),
         Metric("people", "people_n", "count", "p")),
        (Ratio("per_send", ("revenue",), ("sends_n",), ("rps",)),),
        {"by_region": lambda m: query(m, ["per_send"], ["geo"])})


def test_two_facts_do_not_fan_out(model):
    got = rows(query(model, ["revenue", "sends_n", "people_n", "per_send"], ["region"]))
    # The order of an unknown person and the person without region share the NULL group.
    assert got == rows_of([("N", 30.0, 3, 1, 10.0), (None, 12.0, 1, 1, 12.0), ("S", None, 0, 1, 0.0)])


def rows_of(items):
    return sorted(items, key=repr)


def test_measures_and_global(model):
    got = query(model, ["sales", "orders_n", "avg_amount", "largest", "big_n"]).collect()
    assert tuple(got[0]) == (42.0, 4, 10.5, 20.0, 2)


def test_path_rules(model):
    with pytest.raises(MetricModelError, match="several paths"):
        query(model, ["revenue"], ["brand"])
    assert [r.name for r in resolve_path(model, "orders", "brands", ("orders_camps",))] == ["orders_camps", "camps_brands"]
    assert rows(query(model, ["revenue"], ["brand"], via=("orders_camps",))) == rows_of([("B", 37.0), (None, 5.0)])
    assert rows(query(model, ["revenue"], ["brand"], via=("orders_people",))) == rows_of([("A", 35.0), (None, 7.0)])
    with pytest.raises(MetricModelError, match="cannot be reached"):
        query(model, ["sends_n"], ["kind"])
    with pytest.raises(MetricModelError, match="unknown"):
        query(model, ["nope"])


def test_verified_and_catalog(model, spark):
    assert model.run("by_region").columns == ["region", "per_send"]
    assert model.table("stores").name == "brands"
    names = {r["name"] for r in catalog(spark, model).collect()}
    assert {"revenue", "per_send", "region"} <= names
    with pytest.raises(MetricModelError):
        model.run("other")


def test_key_and_enum_checks(model, spark):
    got = dict(rows(check_keys(model)))
    assert got["key:orders"] == 0 and got["reference:orders_people"] == 1 and got["reference:orders_camps"] == 0
    assert check_enums(model).count() == 0
    twice = Model("t", (Table("x", spark.createDataFrame([(1,), (1,)], "k int"), ("k",)),))
    assert dict(rows(check_keys(twice))) == {"key:x": 1}


def test_hot_key_is_one_row_per_task_before_the_join(model):
    plan = query(model, ["revenue"], ["region"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert "Aggregate" in plan[join:]
