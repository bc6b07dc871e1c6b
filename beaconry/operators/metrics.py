"""Governed metric layer: declare tables, keys, facts, dimensions and metrics
once, then ask for any metrics at any dimensions every metric can reach.

How a request becomes a plan. Each base metric is aggregated on its own table:
facts are never joined to facts, so nothing fans out. Before a fact climbs to a
large parent table its rows are pre-aggregated on the foreign key; a hot key
therefore meets the join as one row per task, not as a third of the table.
Parents declared ``bounded`` (a list of countries, say) are joined directly and
Catalyst broadcasts them if their size allows. The branches, reduced to partial
aggregates, are stacked and merged by one ``groupBy`` on the dimensions, which
also plays the part of a null-safe full outer join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.functions.safe import div0


class MetricModelError(ValueError):
    """A name that does not resolve, or a path that is missing or ambiguous."""


@dataclass(frozen=True)
class Table:
    name: str
    frame: DataFrame
    key: tuple[str, ...]
    bounded: bool = False
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``child.columns`` refer to the key of ``parent``."""

    name: str
    child: str
    columns: tuple[str, ...]
    parent: str


@dataclass(frozen=True)
class Fact:
    table: str
    name: str
    expr: str


@dataclass(frozen=True)
class Dimension:
    table: str
    name: str
    expr: str
    synonyms: tuple[str, ...] = ()
    enum: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """Aggregate (``sum count avg min max``) of a fact or column of one table."""

    table: str
    name: str
    agg: str
    of: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ratio:
    """Sum of base metrics over sum of base metrics; 0 on a zero denominator."""

    name: str
    numerator: tuple[str, ...]
    denominator: tuple[str, ...]
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Model:
    name: str
    tables: tuple[Table, ...]
    relationships: tuple[Relationship, ...] = ()
    facts: tuple[Fact, ...] = ()
    dimensions: tuple[Dimension, ...] = ()
    metrics: tuple[Metric, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    verified: dict[str, Callable[["Model"], DataFrame]] = field(default_factory=dict)

    def table(self, name: str) -> Table:
        return _find(self.tables, name, "table")

    def dimension(self, name: str) -> Dimension:
        return _find(self.dimensions, name, "dimension")

    def metric(self, name: str) -> Metric | Ratio:
        return _find(self.metrics + self.ratios, name, "metric")

    def run(self, verified_query: str) -> DataFrame:
        if verified_query not in self.verified:
            raise MetricModelError(f"no verified query {verified_query!r}")
        return self.verified[verified_query](self)


def _find(items, name: str, kind: str):
    wanted = name.lower()
    exact = [i for i in items if i.name.lower() == wanted]
    if exact:
        return exact[0]
    found = [i for i in items if wanted in (s.lower() for s in i.synonyms)]
    if len(found) != 1:
        state = "ambiguous" if found else "unknown"
        raise MetricModelError(f"{state} {kind} {name!r}")
    return found[0]


def paths(model: Model, start: str, goal: str, seen: tuple[str, ...] = ()) -> list[tuple[Relationship, ...]]:
    """All many-to-one paths from one table to another; a cycle is an error."""
    if start in seen:
        raise MetricModelError(f"relationships form a cycle: {' > '.join([*seen, start])}")
    if start == goal:
        return [()]
    found = []
    for rel in model.relationships:
        if rel.child == start:
            found += [(rel, *rest) for rest in paths(model, rel.parent, goal, (*seen, start))]
    return found


def resolve_path(model: Model, start: str, goal: str,
                 via: tuple[str, ...] = ()) -> tuple[Relationship, ...]:
    """The one path to use; ``via`` names relationships to prefer when several fit."""
    options = paths(model, start, goal)
    if not options:
        raise MetricModelError(f"{goal!r} cannot be reached from {start!r}")
    if len(options) > 1:
        options = [p for p in options if any(r.name in via for r in p)]
    if len(options) != 1:
        raise MetricModelError(f"several paths from {start!r} to {goal!r}; name one in via")
    return options[0]


_PARTS = {"sum": ("sum",), "count": ("count",), "avg": ("sum", "count"),
          "min": ("min",), "max": ("max",)}
# Every part of a row is itself a partial aggregate, so any number of folds may follow.
_ROW = {"sum": lambda c: c, "count": lambda c: F.when(c.isNotNull(), 1).otherwise(0).cast("long"),
        "min": lambda c: c, "max": lambda c: c}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _branch(model: Model, table_name: str, metrics: list[Metric],
            dims: list[Dimension], via: tuple[str, ...]) -> DataFrame:
    """Partial aggregates of one table's metrics with the dimensions attached.

    Without a large parent on the way this is a plain projection: the merge over
    all branches combines its rows map-side.
    """
    table = model.table(table_name)
    edges: list[Relationship] = []
    for dim in dims:
        for rel in resolve_path(model, table_name, dim.table, via):
            if rel not in edges:
                edges.append(rel)

    def needed(name: str) -> dict[str, Column]:
        """Foreign keys and dimensions to carry out of one table."""
        columns = {f"{e.name}.{c}": F.col(c)
                   for e in edges if e.child == name for c in e.columns}
        columns.update({f"dim.{d.name}": F.expr(d.expr) for d in dims if d.table == name})
        return columns

    facts = {f.name: F.expr(f.expr) for f in model.facts if f.table == table_name}
    parts = {f"{m.name}.{p}": (p, _ROW[p](facts.get(m.of, F.col(m.of))))
             for m in metrics for p in _PARTS[m.agg]}
    frame = table.frame.select(
        *[c.alias(n) for n, c in needed(table_name).items()],
        *[c.alias(n) for n, (_, c) in parts.items()])
    carried = list(needed(table_name))
    for edge in edges:
        parent = model.table(edge.parent)
        if not parent.bounded:
            frame = frame.groupBy(*[f"`{c}`" for c in carried]).agg(
                *[_MERGE[p](F.col(f"`{n}`")).alias(n) for n, (p, _) in parts.items()])
        extra = needed(edge.parent)
        keys = [f"{edge.name}.key{i}" for i in range(len(parent.key))]
        side = parent.frame.select(
            *[F.col(k).alias(a) for k, a in zip(parent.key, keys)],
            *[c.alias(n) for n, c in extra.items()])
        fks = [f"{edge.name}.{c}" for c in edge.columns]
        on = [F.col(f"`{f}`") == F.col(f"`{k}`") for f, k in zip(fks, keys)]
        frame = frame.join(side, on, "left").drop(*keys, *fks)
        carried = [c for c in carried if c not in fks] + list(extra)
    return frame


def query(model: Model, metrics: list[str], dimensions: list[str] = (),
          via: tuple[str, ...] = ()) -> DataFrame:
    """Metrics at dimensions; filter and order the result as any DataFrame."""
    dims = [model.dimension(d) for d in dimensions]
    wanted = [model.metric(m) for m in metrics]
    base: dict[str, Metric] = {}
    for item in wanted:
        names = (item.numerator + item.denominator) if isinstance(item, Ratio) else (item.name,)
        for n in names:
            metric = model.metric(n)
            if isinstance(metric, Ratio):
                raise MetricModelError(f"{item.name!r} must refer to base metrics")
            base[metric.name] = metric

    by_table: dict[str, list[Metric]] = {}
    for metric in base.values():
        by_table.setdefault(metric.table, []).append(metric)
    stacked = None
    for table_name, group in by_table.items():
        part = _branch(model, table_name, group, dims, via)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)

    merged = stacked.groupBy(*[F.col(f"`dim.{d.name}`").alias(d.name) for d in dims]).agg(
        *[_MERGE[p](F.col(f"`{m.name}.{p}`")).alias(f"{m.name}.{p}")
          for m in base.values() for p in _PARTS[m.agg]])

    def value(metric: Metric) -> Column:
        if metric.agg == "avg":
            return (F.col(f"`{metric.name}.sum`")
                    / F.nullif(F.col(f"`{metric.name}.count`"), F.lit(0)))
        column = F.col(f"`{metric.name}.{metric.agg}`")
        return F.coalesce(column, F.lit(0)).cast("long") if metric.agg == "count" else column

    def total(names: tuple[str, ...]) -> Column:
        columns = [value(model.metric(n)) for n in names]
        return columns[0] if len(columns) == 1 else sum(columns[1:], columns[0])

    return merged.select(
        *[d.name for d in dims],
        *[(div0(total(i.numerator), total(i.denominator)) if isinstance(i, Ratio)
           else value(i)).alias(i.name) for i in wanted])


def check_keys(model: Model) -> DataFrame:
    """One row per declared key and relationship with its violations.

    Duplicates are counted by a key aggregate (map-side combined); orphans by an
    anti join of the distinct foreign keys, so a hot key is one row.
    """
    rows = None
    for table in model.tables:
        doubles = (table.frame.groupBy(*table.key).count().filter("count > 1")
                   .agg(F.count("*").alias("violations")))
        row = doubles.select(F.lit(f"key:{table.name}").alias("check_name"), "violations")
        rows = row if rows is None else rows.unionByName(row)
    for rel in model.relationships:
        parent = model.table(rel.parent)
        keys = [f"p{i}" for i in range(len(parent.key))]
        refs = (model.table(rel.child).frame.select(*rel.columns)
                .dropna().distinct().toDF(*[f"c{i}" for i in range(len(rel.columns))]))
        side = parent.frame.select(*parent.key).toDF(*keys)
        orphans = refs.join(side, [F.col(f"c{i}") == F.col(f"p{i}") for i in range(len(keys))],
                            "left_anti").agg(F.count("*").alias("violations"))
        rows = rows.unionByName(
            orphans.select(F.lit(f"reference:{rel.name}").alias("check_name"), "violations"))
    return rows


def check_enums(model: Model) -> DataFrame:
    """Values found in the data that an enumerated dimension does not list."""
    rows = None
    for dim in model.dimensions:
        if not dim.enum:
            continue
        found = (model.table(dim.table).frame.groupBy(F.expr(dim.expr).alias("value"))
                 .agg(F.count("*").alias("rows"))
                 .filter(~F.col("value").isin(*dim.enum))
                 .select(F.lit(dim.name).alias("dimension"), "value", "rows"))
        rows = found if rows is None else rows.unionByName(found)
    if rows is None:
        raise MetricModelError("no enumerated dimension declared")
    return rows


def catalog(spark: SparkSession, model: Model) -> DataFrame:
    """Metrics and dimensions with their table and synonyms."""
    rows = [("dimension", d.name, d.table, list(d.synonyms)) for d in model.dimensions]
    rows += [("metric", m.name, m.table, list(m.synonyms)) for m in model.metrics]
    rows += [("metric", r.name, None, list(r.synonyms)) for r in model.ratios]
    return spark.createDataFrame(
        rows, "kind string, name string, table_name string, synonyms array<string>")
