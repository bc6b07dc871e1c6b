"""SimHash fingerprints and their near-duplicate groups by generalised pigeonhole.

64 bits are cut into m parts; if the thresholds t_i of the parts obey
``sum(t_i + 1) = d + 1``, two fingerprints within d bits differ in at most t_i
bits in at least one part. Bits that vary together are put into the same part,
and a dynamic program deals unequal thresholds by estimated candidate counts.
A part with threshold t is probed under every mask of t of its bits: two values
within t bits agree under the mask that covers their difference. All members of
a probed bucket are verified on the full fingerprint.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.llm.common import arrow_schema, keyed_texts, map_rows, unused
from beaconry.llm.components import components
from beaconry.llm.embedding_dedup import _runs
from beaconry.session import shared_root

BITS = 64
SEED = 42
#: Buckets beyond this many members are cut further by their remaining bits.
LARGE_BUCKET = 20_000


def shingle_bytes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each word shingle of a text as rows of 8 bytes, repeats included."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros((0, 8), dtype=np.uint8)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(words, len(tokens)) - 1
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[s:e], SEED)
                    for s, e in zip(starts[:len(starts) - last].tolist(), ends[last:].tolist())])
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8)


def majority(rows: np.ndarray) -> int:
    """Bits set in over half the hashes, as a signed number; 0 without any."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(rows), 1 << 15):
        counts += np.unpackbits(rows[at:at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprint(text: str | None, words: int) -> int:
    """Majority bits over the XXH64 of all word shingles, repeats included."""
    return majority(shingle_bytes(text, words))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 4) -> DataFrame:
    """``(doc_id, fp)`` per row, fp a signed long.

    Null and wordless texts give 0; texts with fewer words than a shingle hash
    their whole sequence. Repeated rows stay.
    """
    return map_rows(keyed_texts(df, id_col, text_col),
                    lambda ids, texts: (ids, [fingerprint(t, words) for t in texts]),
                    "doc_id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Count and 64 x 64 joint bit counts over all fingerprints (4,096 sums)."""
    def joint(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8")
            for at in range(0, len(x), 1 << 14):
                part = x[at:at + (1 << 14)]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
                total += bits.T @ bits
                n += len(part)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(BITS * BITS + 1), pa.int32()),
             "n": pa.array([*total.ravel().astype(np.int64).tolist(), n], pa.int64())})

    sums = (prints.select("fp").mapInArrow(joint, "i int, n long")
            .groupBy("i").agg(F.sum("n").alias("n")).toPandas().set_index("i")["n"])
    if not len(sums):
        return 0, np.zeros((BITS, BITS))
    flat = sums.sort_index().to_numpy()
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS).astype(float)


def correlated_parts(n: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal width; a part is grown from the bits that vary together."""
    p = np.diag(joint) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    free, parts = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        grown = [max(free, key=lambda b: sum(corr[b, f] for f in free if f != b))]
        free.remove(grown[0])
        while len(grown) < width:
            grown.append(max(free, key=lambda b: (sum(corr[b, g] for g in grown), -b)))
            free.remove(grown[-1])
        parts.append(sorted(grown))
    return parts


def bucket_pairs(p: np.ndarray, t: int) -> float:
    """Expected buckets that a random pair shares under all masks of t of the part's bits.

    p: the rate of ones per bit. A pair that differs in h <= t bits meets under
    every mask that covers them: C(width - h, t - h) of them.
    """
    row = np.zeros(t + 1)
    row[0] = 1.0
    for d in 2 * p * (1 - p):
        row[1:], row[0] = row[1:] * (1 - d) + row[:-1] * d, row[0] * (1 - d)
    return float(sum(row[h] * math.comb(len(p) - h, t - h) for h in range(t + 1)))


def allocate(n: int, joint: np.ndarray, distance: int,
             probe_cost: float = 2_000.0) -> list[tuple[list[int], int]]:
    """Parts and thresholds of least estimated work: ``[(bits, t), ...]``, t >= 0.

    Work of a part at t: its candidate pairs by the bit rates of all
    fingerprints, plus what its masks cost to emit (a row is worth about as much
    as ``probe_cost`` comparisons). The dynamic program runs
    over parts and the thresholds left; -1 leaves a part out.
    """
    p = np.diag(joint) / max(n, 1)
    best = (math.inf, [])
    for m in range(1, min(distance + 1, 12) + 1):
        parts = correlated_parts(n, joint, m)
        budget = distance + 1
        table = {0: (0.0, [])}
        for bits in parts:
            step = {}
            for t in range(-1, min(distance, len(bits), 4) + 1):
                work = 0.0 if t < 0 else (n * n / 2 * bucket_pairs(p[bits], t)
                                          + probe_cost * n * math.comb(len(bits), t))
                for used, (cost, chosen) in table.items():
                    at, total = used + t + 1, cost + work
                    if at <= budget and (at not in step or total < step[at][0]):
                        step[at] = (total, [*chosen, (bits, t)])
            table = step
        if budget in table and table[budget][0] < best[0]:
            best = table[budget]
    return [(bits, t) for bits, t in best[1] if t >= 0]


def probes(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """Bit masks (uint64) under which fingerprints are bucketed, one per probe."""
    one = np.uint64(1)
    masks = []
    for bits, t in plan:
        for gone in itertools.combinations(bits, t):
            masks.append(sum(1 << (BITS - 1 - b) for b in bits if b not in gone))
    return np.array(masks, dtype=np.uint64) if masks else np.array([one - one])


def forest(x: np.ndarray, distance: int, alike=None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that connect what links within one bucket, at most len(x) - 1.

    A search from each unvisited member compares with the unvisited rest only:
    a dense group is emptied in a few vector steps and is never paired out.
    ``alike(at, others)``: which of the others within the distance link with ``at``.
    """
    left, right, rest = [], [], np.arange(len(x))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(x[rest] ^ x[at]) <= distance
            if alike is not None and near.any():
                near[near] = alike(at, rest[near])
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found.tolist())
                rest = rest[~near]
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def _verify(batches, distance: int, most: int | None = None):
    """Links within buckets of rows sorted by bucket; buckets may cross batches.

    With ``most``, pairs are not thinned to a forest: every pair within the distance
    is emitted, unless both ends have more than ``most`` neighbours in a large
    bucket. Those members are emitted as pairs with themselves.
    """
    out = arrow_schema("a long, b long")

    def large(x):
        if most is None:
            i, j = forest(x, distance)
            return [x[i]], [x[j]]
        left, right, step = [], [], max(1, (1 << 21) // len(x))
        for at in range(0, len(x), step):
            near = np.bitwise_count(x[at:at + step, None] ^ x[None, :]) <= distance
            dense = near.sum(axis=1) > most + 1
            i, j = np.nonzero(near & ~dense[:, None])
            i += at
            own, i, j = x[at:at + step][dense], i[i != j], j[i != j]
            left += [own, np.minimum(x[i], x[j])]
            right += [own, np.maximum(x[i], x[j])]
        return left, right

    def links(key, fp):
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(key)))
        left, right = [], []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= 8)]):
            rows = np.sort(fp[starts[sizes == size][:, None] + np.arange(size)], axis=1)
            for i, j in itertools.combinations(range(size), 2):
                hit = np.bitwise_count(rows[:, i] ^ rows[:, j]) <= distance
                left.append(rows[hit, i])
                right.append(rows[hit, j])
        for s, n in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
            i, j = large(fp[s:s + n])
            left += i
            right += j
        if left:
            return [np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)]
        return [np.zeros(0, np.int64)] * 2

    keys, prints = [], []
    for batch in batches:
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)], axis=1)
        fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(key):
            continue
        change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
        same = not keys or (keys[-1][-1] == key[0]).all()
        cut = int(change[-1]) + 1 if len(change) else (0 if same else None)
        if cut is None or cut:  # the open bucket ends in this batch
            head = 0 if cut is None else cut
            k, f = np.concatenate([*keys, key[:head]]), np.concatenate([*prints, fp[:head]])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in links(k, f)], schema=out)
            keys, prints = [key[head:]], [fp[head:]]
        else:
            keys.append(key)
            prints.append(fp)
    if keys:
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in links(np.concatenate(keys), np.concatenate(prints))], schema=out)


def _bucketed(distinct: DataFrame, plan) -> DataFrame:
    """``(probe, bucket, fp)``: one row per fingerprint and mask, by native bit operations."""
    masks = [int(m) for m in probes(plan).view(np.int64)]
    table = F.array(*[F.lit(m) for m in masks])
    return (distinct.select("fp", F.posexplode(table).alias("probe", "mask"))
            .select(F.col("probe").cast("long").alias("probe"),
                    F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"), "fp"))


def _split_large(rows: DataFrame, plan, distance: int, limit: int) -> DataFrame:
    """Cut buckets of more than ``limit`` members by their remaining bits, exactly.

    The bits outside a probe's mask are cut into distance + 1 pieces; members
    that link agree in one of them, so they meet in a sub-bucket.
    """
    large = (rows.groupBy("probe", "bucket").count().filter(F.col("count") > limit)
             .select("probe", "bucket", F.lit(True).alias("_large")))
    if large.isEmpty():
        return rows
    every = (1 << BITS) - 1
    pieces = []
    for m in probes(plan):
        open_bits = [b for b in range(BITS) if not int(m) >> b & 1]
        cuts = [sum(1 << b for b in open_bits[i::distance + 1]) for i in range(distance + 1)]
        pieces.append([c - (1 << BITS) if c > every >> 1 else c for c in cuts])
    table = F.array(*[F.array(*[F.lit(c) for c in row]) for row in pieces])
    joined = rows.join(large, ["probe", "bucket"], "left")
    small = joined.filter(F.col("_large").isNull()).select("probe", "bucket", "fp")
    cut = (joined.filter("_large")
           .select("probe", "bucket", "fp", F.posexplode(F.get(table, F.col("probe").cast("int"))).alias("piece", "mask"))
           .select((F.col("probe") * (distance + 2) + F.col("piece") + len(pieces)).alias("probe"),
                   F.xxhash64("bucket", "piece", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"), "fp"))
    return small.unionByName(cut)


def link_fingerprints(distinct: DataFrame, distance: int,
                      large_bucket: int = LARGE_BUCKET, most: int | None = None) -> DataFrame:
    """``(a, b)`` edges that connect all fingerprints within ``distance`` bits.

    ``distinct`` has unique longs in ``fp``. Every link is verified; links that
    connect nothing new inside a bucket are not emitted. With ``most`` all pairs
    are emitted but those between members of dense neighbourhoods, which come as
    ``(a, a)``: see ``_verify``.
    """
    n, joint = bit_statistics(distinct)
    if n < 2:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    plan = allocate(n, joint, distance)
    rows = _split_large(_bucketed(distinct, plan), plan, distance, large_bucket)
    return (rows.repartition("probe", "bucket").sortWithinPartitions("probe", "bucket", "fp")
            .mapInArrow(lambda it: _verify(it, distance, most), "a long, b long").distinct())


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 4, distance: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: near-duplicate groups over all rows.

    component_id is the smallest doc_id reachable over links of at most
    ``distance`` differing bits, itself included; equal fingerprints (also 0 of
    wordless texts) are one group whatever their number. A null id takes part
    and is never the smallest; if all ids of a group are null, so is its
    component. Repeated rows stay, an empty table gives no rows.
    """
    shared_root(df.sparkSession)
    prints = fingerprints(df, id_col, text_col, words).checkpoint()
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    roots = components(link_fingerprints(distinct.select("fp"), distance))
    classes = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
               .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


#: Smallest shingle hashes kept to verify the similarity of candidates.
SKETCH = 128
#: Neighbours in a large bucket beyond which a fingerprint is linked by its shingles instead.
NEAR = 8
#: Members of one block of a shared shingle; blocks are compared pair by pair.
SHARED_BLOCK = 1024


def sketch(rows: np.ndarray) -> bytes:
    """The SKETCH smallest distinct shingle hashes, ascending."""
    return np.unique(rows.view(">u8").ravel().astype(np.uint64))[:SKETCH].tobytes()


def node_of(rows: np.ndarray, fp: int) -> int:
    """Hash of a fingerprint and the whole set of distinct shingle hashes, a signed number."""
    whole = np.unique(rows.view(">u8").ravel().astype(np.uint64)).tobytes()
    return int.from_bytes(xxhash.xxh64_digest(whole, fp % (1 << BITS)), "big", signed=True)


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two shingle sets, estimated from their smallest hashes;
    exact for sets that the sketches hold whole. Two empty sets are alike."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    least = np.union1d(x, y)[:SKETCH]
    return float(np.isin(least, np.intersect1d(x, y, assume_unique=True), assume_unique=True).mean())


def similar_edges(edges: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The edges whose ends have similar shingle sets. sketches: ``(node, sketch)``."""
    one = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    two = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    both = edges.join(one, "a").join(two, "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            a, b, x, y = batch.columns
            keep = [similarity(p, q) >= least for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


class Alike:
    """``similarity(a, b) >= least`` of one sketch against many, as ``forest`` asks it.

    ranks: the place of the shared shingle in each sketch. The smallest shingle that
    two similar sketches share has at most ``far`` others of the two before it, so
    other pairs are left to the bucket of their own smallest shared shingle.
    """

    def __init__(self, sketches: list[bytes], ranks: np.ndarray, least: float, far: int):
        self.size = np.array([len(s) // 8 for s in sketches])
        self.rows = np.full((len(sketches), SKETCH), np.iinfo(np.uint64).max, dtype=np.uint64)
        for row, s, n in zip(self.rows, sketches, self.size):
            row[:n] = np.frombuffer(s, np.uint64)
        self.ranks, self.least, self.far = ranks, least, far

    def __call__(self, at: int, others: np.ndarray) -> np.ndarray:
        out = self.ranks[others] + self.ranks[at] <= self.far
        mine, rows, sizes = self.rows[at][:self.size[at]], self.rows[others[out]], self.size[others[out]]
        places = np.arange(SKETCH)
        place = np.searchsorted(mine, rows)
        shared = (mine[np.minimum(place, len(mine) - 1)] == rows) & (places < sizes[:, None])
        rank = place + places - (np.cumsum(shared, axis=1) - shared)  # in the union of both
        union = np.minimum(len(mine) + sizes - shared.sum(axis=1), SKETCH)
        out[out] = (shared & (rank < SKETCH)).sum(axis=1) / union >= self.least
        return out


def dense_links(dense: DataFrame, distance: int, least: float, block: int = SHARED_BLOCK) -> DataFrame:
    """``(a, b)`` edges that connect the similar among ``(node, fp, sketch)`` rows.

    Of the SKETCH smallest shingles of two texts with similarity ``least``, at most a
    share of 1 - least belongs to one only; so among that many and one of each sketch
    there is a shared one, and rows meet in the bucket of each of these. A frequent
    shingle is cut into blocks, and every pair of blocks is a unit of work.
    """
    far = SKETCH - math.ceil(least * SKETCH - 1e-9)

    def first(batches):
        for batch in batches:
            nodes, sketches = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for at in range(0, len(nodes), 4096):
                heads = [np.frombuffer(s, np.int64)[:far + 1] for s in sketches[at:at + 4096]]
                sizes = [len(h) for h in heads]
                yield pa.RecordBatch.from_pydict({
                    "shingle": pa.array(np.concatenate(heads)), "node": pa.array(np.repeat(nodes[at:at + 4096], sizes)),
                    "place": pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]))})

    rows = dense.select("node", "sketch").mapInArrow(first, "shingle long, node long, place int")
    cuts = (rows.groupBy("shingle").count().filter("count > 1")
            .select("shingle", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    met = (rows.join(cuts, "shingle")
           .withColumn("own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("shingle", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "place")
           .join(dense.select("node", "fp", "sketch"), "node")
           .select("shingle", "i", "j", "node", "place", "fp", "sketch"))
    out = arrow_schema("a long, b long")

    def run(batches):
        for _, table in _runs(batches, 3):
            node, place, fp = (table.column(c).to_numpy() for c in ("node", "place", "fp"))
            alike = Alike(table.column("sketch").to_pylist(), place, least, far)
            i, j = forest(fp.view(np.uint64), distance, alike)
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], schema=out)

    keys = ["shingle", "i", "j"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def similar_links(classes: DataFrame, distance: int, least: float) -> DataFrame:
    """``(a, b)`` edges that connect all ``(node, fp, sketch)`` rows within ``distance``
    bits whose sketches are similar; node is unique.

    Few nodes of linked fingerprints are paired out; a fingerprint of more than NEAR
    nodes and its neighbours count as dense.
    """
    prints = classes.groupBy("fp").count()
    found = link_fingerprints(prints.select("fp"), distance, most=NEAR).checkpoint()
    crowded = prints.filter(F.col("count") > NEAR).select("fp", F.lit(True).alias("_many"))
    ends = (found.filter("a <> b").join(crowded.toDF("a", "_a"), "a", "left").join(crowded.toDF("b", "_b"), "b", "left")
            .withColumn("many", F.coalesce("_a", "_b", F.lit(False))).select("a", "b", "many"))
    own = prints.filter(F.col("count").between(2, NEAR)).select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    named = classes.select("node", "fp")
    pairs = (ends.filter("NOT many").select("a", "b").unionByName(own)
             .join(named.toDF("x", "a"), "a").join(named.toDF("y", "b"), "b")
             .filter("a <> b OR x < y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    dense = (found.filter("a = b").select("a").union(crowded.select("fp"))
             .union(ends.filter("many").select(F.explode(F.array("a", "b")))).distinct().toDF("fp"))
    sparse = similar_edges(pairs, classes.select("node", "sketch"), least)
    return sparse.unionByName(dense_links(classes.join(dense, "fp"), distance, least))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
             distance: int = 12, least: float = 0.8) -> DataFrame:
    """One row of each near-duplicate group of ``df``, all columns unchanged.

    Texts link when their fingerprints differ in at most ``distance`` bits and their
    word shingles have a Jaccard similarity of ``least`` or more, estimated from the
    smallest SKETCH hashes. Only texts of equal fingerprint and shingle set are one
    group unchecked. The row with the smallest id stays (null ids last, then by text
    hash). Texts without words are one group; an empty table gives no rows. Columns
    of any name and type pass through.
    """
    shared_root(df.sparkSession)
    names = own, hashed_text, _, _, turn = unused(df, "own", "hashed", "first_id", "first_key", "turn")
    text = F.col(f"`{text_col}`").cast("string")
    keyed = df.select(F.xxhash64(text).alias("text_key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      text.alias("text"))

    def work(keys, ids, texts):
        hashed = [shingle_bytes(t, words) for t in texts]
        prints = [majority(h) for h in hashed]
        return keys, ids, [node_of(h, f) for h, f in zip(hashed, prints)], prints, [sketch(h) for h in hashed]

    prints = map_rows(keyed, work, "text_key long, doc_id long, node long, fp long, sketch binary").checkpoint()
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = (prints.groupBy("node").agg(F.min(first).alias("first"), F.min("fp").alias("fp"),
                                          F.min("sketch").alias("sketch")).checkpoint())
    roots = components(similar_links(classes, distance, least))
    kept = (classes.join(roots, "node", "left")
            .groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
            .select(F.col("first.doc_id").alias(names[2]), F.col("first.text_key").alias(names[3])))
    # A repeated row has the same id and text as the one that stays: number them.
    numbered = (df.withColumns({own: F.col(f"`{id_col}`").cast("long"), hashed_text: F.xxhash64(text)})
                .join(kept, F.col(own).eqNullSafe(F.col(names[2])) & (F.col(hashed_text) == F.col(names[3])))
                .withColumn(turn, F.row_number().over(W.partitionBy(own, hashed_text).orderBy(own))))
    return numbered.filter(F.col(turn) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
