"""Query registry: name → Spark plan, oracle SQL and the inventory rows covered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beaconry.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``plan(t: Tables) -> DataFrame`` under ``name``."""

    def register(plan: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(Tables(spark, sf_dir))

        QUERIES[name] = run
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
