"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors of a label are ordered by the concatenated signs of
random projections, and every vector is compared with a bounded window of its
successors. The verified pairs of all passes are united to components. Vectors
are centred by their label's mean before they are projected, so that the signs
tell apart vectors that lie in a cone. Passes come in rounds that double their
number, label by label, until a round joins nearly nothing new: what half of the
passes missed and the other half found measures what both missed. A label whose
windows would compare as many pairs as it holds is compared whole, in blocks.

Inside a component all pairs are then checked block against block, so that the
number of links of a vector does not depend on the window. Identical vectors are
one node with a count throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import arrow_schema, map_rows
from beaconry.llm.components import components
from beaconry.operators.ordering import global_row_number
from beaconry.session import shared_root

#: Signs per pass, rows per block of a sorted pass, rows per block of a component.
SIGNS, BLOCK, COMPONENT_BLOCK = 63, 2048, 512
#: Numbers of a table of label means that is broadcast, and labels whose sums a task holds at a time.
SMALL, AT_ONCE = 1_000_000, 256


def passes_needed(n: int, threshold: float, window: int, missed: float) -> int:
    """Passes after which a pair at the threshold is missed with chance ``missed``.

    Two vectors at angle a agree in a sign with chance 1 - a / pi; they share a
    window when the first log2(n / window) signs agree.
    """
    agree = 1 - math.acos(threshold) / math.pi
    hit = agree ** max(1.0, math.log2(max(n, 2) / window))
    return max(2, math.ceil(math.log(missed) / math.log1p(-hit)))


def nodes(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, v, node)`` per row; node is null for rows that link with nothing."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    some = F.exists("v", lambda x: x != 0.0)
    valid = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
             & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False)))
    return rows.withColumn("node", F.when(valid, F.xxhash64("label", "v")))


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Unit vectors in double precision; scaled first, so that no square overflows."""
    out = []
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(ends[:-1], ends[1:]):
        v = flat[a:b] / np.abs(flat[a:b]).max()
        out.append(v / np.sqrt(v @ v))
    return out


def projection(dim: int, turn: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, turn, dim]).normal(size=(dim, SIGNS))


def _plan(threshold: float, window: int, missed: float):
    """Passes of the first round from the size and mean of each label.

    Centring takes the mean's squared length off the cosine of a pair and off both
    squared lengths. The first round may miss the root of ``missed``, the second
    squares that. ``whole``: the window holds the label.
    """
    def work(groups, sizes, means):
        turns = []
        for n, mean in zip(sizes, means, strict=True):
            common = float(np.dot(mean, mean))
            centred = max((threshold - common) / max(1 - common, 1e-9), 0.0)
            most = max(1, math.ceil(n / (2 * window)))
            turns.append(min(passes_needed(n, centred, window, math.sqrt(missed)), most))
        whole = [n <= window + 1 for n in sizes]
        return groups, sizes, means, [1 if w else t for w, t in zip(whole, turns)], whole

    return work


def label_means(distinct: DataFrame) -> DataFrame:
    """``(group, n, mean)``: number and mean of the unit vectors of each label and length."""
    schema = "group long, n long, sums array<double>"
    out = arrow_schema(schema)

    def run(batches):
        held: dict = {}

        def given():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([n for n, _ in held.values()]),
                                               pa.array([t for _, t in held.values()], type=out.field(2).type)], schema=out)
            held.clear()
            return rows

        for batch in batches:
            for g, unit in zip(batch.column(0).to_pylist(), unit_rows(batch.column(1))):
                n, total = held.get(g, (0, 0.0))
                held[g] = n + 1, total + unit
                if len(held) > AT_ONCE:
                    yield given()
        if held:
            yield given()

    parts = distinct.select("group", "v").mapInArrow(run, schema)
    each = parts.select("group", "n", F.posexplode("sums").alias("at", "x")).groupBy("group", "at")
    return (each.agg(F.sum("n").alias("n"), (F.sum("x") / F.sum("n")).alias("x")).groupBy("group")
            .agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))),
                                                    lambda s: s["x"]).alias("mean")))


def _keys(vectors: DataFrame, seed: int) -> DataFrame:
    """``(turn, group, key, node)``: the place of each node in each pass of the round.

    ``vectors``: node, group, v, mean, start, stop.
    """
    schema = "turn int, group long, key long, node long"
    out = arrow_schema(schema)
    weights = np.int64(1) << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)

    def run(batches):
        planes: dict = {}
        for batch in batches:
            node, group, start, stop = (batch.column(c).to_numpy(zero_copy_only=False)
                                        for c in ("node", "group", "start", "stop"))
            units, means = unit_rows(batch.column("v")), batch.column("mean")
            _, first, member = np.unique(group, return_index=True, return_inverse=True)
            for k, i in enumerate(first.tolist()):
                mine = np.flatnonzero(member == k)
                x = np.stack([units[r] for r in mine]) - np.array(means[i].as_py())
                for turn in range(start[i], stop[i]):
                    if (x.shape[1], turn) not in planes:
                        if len(planes) >= 64:
                            planes.clear()
                        planes[x.shape[1], turn] = projection(x.shape[1], turn, seed)
                    key = ((x @ planes[x.shape[1], turn]) > 0) @ weights
                    n = len(mine)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, turn, np.int32)), pa.array(group[mine]),
                                                      pa.array(key), pa.array(node[mine])], schema=out)

    return vectors.select("node", "group", "v", "mean", "start", "stop").mapInArrow(run, schema)


def row_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, y)


def block_near(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y link; pairs at the threshold are judged as ``row_cosines`` does."""
    product = x @ y.T
    near = product >= threshold
    i, j = np.nonzero(np.abs(product - threshold) < 1e-12)
    near[i, j] = row_cosines(x[i], y[j]) >= threshold
    return near


def connect(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n places over the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _runs(batches, keys: int):
    """Rows of a sorted stream, group by group: ``(key tuple, columns)``.

    The first ``keys`` columns form the key; a group is one bounded block.
    """
    held: list = []
    for batch in batches:
        table = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in table:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a].item() for c in table)
            if held and held[0] != key:
                yield held[0], pa.Table.from_batches(held[1]).combine_chunks()
                held = []
            if not held:
                held = [key, []]
            held[1].append(batch.slice(a, b - a))
    if held:
        yield held[0], pa.Table.from_batches(held[1]).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name)
    return chunks.chunk(0) if chunks.num_chunks == 1 else pa.concat_arrays(chunks.chunks)


def _windows(rows: DataFrame, threshold: float, window: int) -> DataFrame:
    """Edges that connect what links within the windows of each block."""
    schema = "a long, b long"
    out = arrow_schema(schema)

    def run(batches):
        for _, table in _runs(batches, 1):
            node = _column(table, "node").to_numpy(zero_copy_only=False)
            place = [_column(table, c).to_numpy(zero_copy_only=False) for c in ("turn", "group")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in place], axis=0)) + 1
            units, pairs = unit_rows(_column(table, "v")), []
            for a, b in zip([0, *change], [*change, len(node)]):
                if b - a < 2:
                    continue
                x = np.stack(units[a:b])
                for lag in range(1, min(window, b - a - 1) + 1):
                    hit = np.flatnonzero(row_cosines(x[:-lag], x[lag:]) >= threshold) + a
                    pairs.append((hit, hit + lag))
            i, j = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, int)]) for k in (0, 1))
            root = connect(len(node), i, j)
            moved = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], schema=out)

    return rows.mapInArrow(run, schema)


def _links(rows: DataFrame, threshold: float) -> DataFrame:
    """``(node, links)`` partial counts from pairs of blocks of one component."""
    schema = "node long, links long"
    out = arrow_schema(schema)

    def run(batches):
        for (_, i, j), table in _runs(batches, 3):
            block = _column(table, "block").to_numpy(zero_copy_only=False)
            node = _column(table, "node").to_numpy(zero_copy_only=False)
            copies = _column(table, "copies").to_numpy(zero_copy_only=False)
            units = unit_rows(_column(table, "v"))
            one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(one) or not len(two):
                continue
            near = block_near(np.stack([units[k] for k in one]), np.stack([units[k] for k in two]), threshold)
            if i == j:
                np.fill_diagonal(near, False)
                got = [(one, near @ copies[one])]
            else:
                got = [(one, near @ copies[two]), (two, near.T @ copies[one])]
            for rows_, n in got:
                yield pa.RecordBatch.from_arrays([pa.array(node[rows_]), pa.array(n.astype(np.int64))], schema=out)

    return rows.mapInArrow(run, schema).groupBy("node").agg(F.sum("links").alias("links"))


def _block_edges(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges that connect what links within pairs of blocks of one label."""
    schema = "a long, b long"
    out = arrow_schema(schema)

    def run(batches):
        for (_, i, j), table in _runs(batches, 3):
            block = _column(table, "block").to_numpy(zero_copy_only=False)
            node = _column(table, "node").to_numpy(zero_copy_only=False)
            units = unit_rows(_column(table, "v"))
            one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(one) or not len(two):
                continue
            a, b = np.nonzero(block_near(np.stack([units[k] for k in one]), np.stack([units[k] for k in two]), threshold))
            root = connect(len(node), one[a], two[b])
            moved = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], schema=out)

    return rows.mapInArrow(run, schema)


def block_pairs(members: DataFrame, whole: str, block: int) -> DataFrame:
    """``members`` dealt to all pairs (i, j) of blocks of their ``whole``, sorted by it.

    A whole of m nodes is cut into m / block blocks by a hash; every pair of blocks
    is a unit of work of bounded size, spread over all tasks.
    """
    sizes = members.groupBy(whole).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    paired = (members.join(sizes, whole)
              .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(whole, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "node", "copies", "v"))
    return paired.repartition(whole, "i", "j").sortWithinPartitions(whole, "i", "j")


def link_counts(distinct: DataFrame, roots: DataFrame, threshold: float,
                block: int | None = None) -> DataFrame:
    """``(node, links)``: rows at the threshold or above, checked over each whole component.

    The work is quadratic in the nodes of one component, since it is their pairs that count.
    """
    return _links(block_pairs(distinct.join(roots, "node"), "root", block or COMPONENT_BLOCK), threshold)


def _pass_edges(vectors: DataFrame, threshold: float, window: int, seed: int) -> DataFrame:
    """Edges of the passes ``start`` to ``stop`` of each label."""
    placed = global_row_number(_keys(vectors, seed),
                               [F.col(c) for c in ("turn", "group", "key", "node")], "place")
    spread = (placed.withColumn("block", F.expr(f"(place - 1) div {BLOCK}"))
              .withColumn("block", F.explode(F.when(
                  ((F.col("place") - 1) % BLOCK < window) & (F.col("block") > 0),
                  F.array("block", F.col("block") - 1)).otherwise(F.array("block")))))
    blocks = (spread.join(vectors.select("node", "v"), "node")
              .select("block", "place", "turn", "group", "node", "v")
              .repartition("block").sortWithinPartitions("block", "place"))
    return _windows(blocks, threshold, window)


def linked(distinct: DataFrame, threshold: float, window: int, missed: float, seed: int) -> DataFrame:
    """``(node, root)`` of the nodes that link, by rounds of passes (see the module).

    The labels still open are counted on the driver; all else about them stays in Spark.
    """
    means = label_means(distinct)
    state = map_rows(means, _plan(threshold, window, missed),
                     "group long, n long, mean array<double>, stop int, whole boolean")
    state = state.withColumns({"start": F.lit(0), "merged": F.lit(0).cast("long")}).checkpoint()
    roots = None
    while True:
        seen = state.agg(F.count("*").alias("n"), F.sum(F.size("mean") + 5).alias("numbers")).first()
        if not seen["n"] and roots is not None:
            return roots
        # Means grow with the labels: broadcast only what is small.
        plan = state.withColumn("all_pairs", (F.col("start") > 0) & (F.col("stop") * (2 * window) >= F.col("n")))
        plan = F.broadcast(plan) if (seen["numbers"] or 0) <= SMALL else plan
        vectors = distinct.join(plan, "group")
        edges = (_pass_edges(vectors.filter("NOT all_pairs"), threshold, window, seed)
                 .unionByName(_block_edges(block_pairs(vectors.filter("all_pairs"), "group", COMPONENT_BLOCK), threshold)))
        if roots is not None:
            edges = edges.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(edges)
        merged = (roots.filter("node != root").join(distinct.select("node", "group"), "node")
                  .groupBy("group").agg(F.count("*").alias("now")))
        now = F.coalesce("now", F.lit(0).cast("long"))
        settled = F.col("whole") | F.col("all_pairs") | (
            (F.col("start") > 0) & (now - F.col("merged") <= missed * now))
        state = (plan.join(merged, "group", "left").filter(~settled)
                 .select("group", "n", "mean", (F.col("stop") * 2).alias("stop"), "whole",
                         F.col("stop").alias("start"), now.alias("merged")).checkpoint())


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93, window: int = 32,
                    missed: float = 0.005, seed: int = 3) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Rows link when their labels are equal and the cosine is ``threshold`` or more.
    n_links counts linked rows, the row itself not included; component_id is the
    smallest vec_id reachable; kept is true where it is the row's own. Passes go on in
    every label until a round as long as all before it adds at most the share ``missed``
    of its joins. Rows with a
    null label or id, or a vector that is null, empty, zero or holds null or
    non-finite components, link with nothing and are their own component. Vectors
    of different lengths never link. Repeated rows link with each other. An empty
    table gives no rows.
    """
    shared_root(df.sparkSession)
    rows = nodes(df, id_col, vector_col, label_col)
    distinct = (rows.filter("node IS NOT NULL").groupBy("node")
                .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"),
                     F.xxhash64(F.first("label"), F.size(F.first("v"))).alias("group"), F.first("v").alias("v")).checkpoint())
    roots = linked(distinct, threshold, window, missed, seed)
    links = link_counts(distinct, roots, threshold)
    known = (distinct.join(roots, "node", "left").join(links, "node", "left")
             .select("node", "least", "copies", F.coalesce("root", "node").alias("root"),
                     F.coalesce("links", F.lit(0)).alias("links")))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(smallest, "root").select(
        "node", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    return (rows.select("vec_id", "node").join(named, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
