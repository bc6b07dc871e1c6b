"""Mixing sources to target weights.

The words of a source are packed, document after document, into blocks of fixed
length. A mix is a list of slots dealt to output shards: per shard the number of
slots of each source is drawn multinomially, without replacement, so that the
totals meet the targets. The i-th slot of a source takes the block that a
pseudorandom permutation of the source's block numbers gives for i; slots and
block pieces meet in a join by block number, which is even whatever the sources'
sizes. All draws follow from the seed, so a rerun agrees.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.llm.common import arrow_schema, mix64, unused
from beaconry.session import shared_root

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def word_count(text: str):
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """``share`` of all sizes dealt by weight; a target stops at ``most`` times its size
    and its excess is dealt on by weight until none is above."""
    total, got = share * sum(sizes), [0.0] * len(sizes)
    open_, left = [i for i, n in enumerate(sizes) if n > 0], total
    while open_:
        each = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if each * weights[i] > most * sizes[i]]
        for i in above or open_:
            got[i] = most * sizes[i] if above else each * weights[i]
        if not above:
            break
        left -= sum(got[i] for i in above)
        open_ = [i for i in open_ if got[i] == 0.0]
    return got


def _keys(source: int, lap: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        start = mix64(np.array([seed], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + np.uint64(source * 8 + lap))
        return mix64(start + np.arange(1, 7, dtype=np.uint64))


def _rounds(x: np.ndarray, keys: np.ndarray, half: int) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    a, b = x >> np.uint64(half), x & mask
    for k in keys:
        a, b = b, a ^ (mix64(b + k) & mask)
    return (a << np.uint64(half)) | b


def permuted(index: np.ndarray, n: int, source: int, lap: int, seed: int) -> np.ndarray:
    """Image of each index below n under a keyed permutation of 0..n-1.

    A balanced Feistel network over the next even power of two; values beyond n
    are sent through again until they fall below it.
    """
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    keys = _keys(source, lap, seed)
    with np.errstate(over="ignore"):
        x = _rounds(index.astype(np.uint64), keys, half)
        out = np.flatnonzero(x >= n)
        while len(out):
            x[out] = _rounds(x[out], keys, half)
            out = out[x[out] >= n]
    return x.astype(np.int64)


def place_of(block: int, n: int, source: int, lap: int, seed: int) -> int:
    """The index that ``permuted`` sends to ``block``."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask, keys, x = (1 << half) - 1, _keys(source, lap, seed), block
    while True:
        a, b = x >> half, x & mask
        for k in keys[::-1]:
            with np.errstate(over="ignore"):
                f = int(mix64(np.array([a], dtype=np.uint64) + k)[0]) & mask
            a, b = b ^ f, a
        x = a << half | b
        if x < n:
            return x


def slot_plan(size: int, target: float, source: int, block: int, seed: int) -> dict:
    """How many slots a source gets, and how many words of the last one count.

    Whole laps take every block once; the last lap stops at the block in which
    the target is reached. The source's last block may be short.
    """
    want = round(target)
    n = -(-size // block)
    laps, rest = divmod(want, size) if size else (0, 0)
    slots, last = laps * n, block
    if rest:
        tail = size - (n - 1) * block
        at = place_of(n - 1, n, source, laps, seed)
        more = -(-rest // block)
        words = more * block - (block - tail) * (at < more)
        if words < rest:
            more += 1
            words = more * block - (block - tail) * (at < more)
        last = (tail if at == more - 1 else block) - (words - rest)
        slots += more
    return {"blocks": n, "slots": slots, "last": last}


def deal(slots: list[int], per_shard: int, seed: int) -> np.ndarray:
    """Slots of each source (columns) per output shard (rows).

    Each row is a multinomial draw from the slots that are left, so the columns
    add up to ``slots`` exactly.
    """
    left = np.array(slots, dtype=np.int64)
    rng, rows = np.random.default_rng(seed), []
    while left.sum():
        row = rng.multivariate_hypergeometric(left, min(per_shard, int(left.sum())), method="marginals")
        rows.append(row)
        left = left - row
    return np.array(rows, dtype=np.int64).reshape(len(rows), len(slots))


def sized_documents(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, text_key, source, size)``: what the plan needs of a document."""
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"),
                      F.col(f"`{source_col}`").cast("string").alias("source"))
            .select("doc_id", F.xxhash64("text").alias("text_key"), "source", word_count("text").alias("size")))


def source_table(spark: SparkSession, sized: DataFrame, share: float, most: float,
                 block: int, seed: int) -> tuple[DataFrame, list[dict]]:
    """One row per source: number, weight, size, target and slots.

    A mix is configured per source, so this table has to fit one process; only
    sums per source reach it.
    """
    rows = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
            .orderBy(F.col("source").asc_nulls_last()).collect())
    sizes = [r["source_size"] for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    plan = []
    for i, (r, goal) in enumerate(zip(rows, targets(sizes, weights, share, most), strict=True)):
        plan.append({"source": r["source"], "source_no": i, "source_size": r["source_size"],
                     "n_rows": r["n_rows"], "target": float(goal),
                     **slot_plan(r["source_size"], goal, i, block, seed)})
    table = spark.createDataFrame(
        [(p["source"], p["source_no"], p["source_size"], p["n_rows"], p["target"]) for p in plan],
        "source string, source_no long, source_size long, n_rows long, target double")
    return table, plan


def offsets(sized: DataFrame, sources: DataFrame, slice_rows: int = 4096) -> DataFrame:
    """Adds the source's columns and ``offset``: words of the source before the document.

    A source is cut into slices by a hash, so a hot source is summed by many
    tasks; the order inside a source is (slice, doc_id, text_key).
    """
    placed = (sized.join(sources, sized["source"].eqNullSafe(sources["source"]))
              .drop(sources["source"])
              .withColumn("_slice", F.pmod(F.xxhash64("doc_id", "text_key"),
                                           F.ceil(F.col("n_rows") / slice_rows))))
    before = W.partitionBy("source_no").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy("source_no", "_slice").agg(F.sum("size").alias("_n"))
              .select("source_no", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = (W.partitionBy("source_no", "_slice").orderBy("doc_id", "text_key")
              .rowsBetween(W.unboundedPreceding, -1))
    return (placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["source_no", "_slice"])
            .withColumn("offset", F.col("_start") + F.col("_inside"))
            .drop("_slice", "_start", "_inside", "n_rows"))


def block_pieces(placed: DataFrame, block: int) -> DataFrame:
    """One row per document and block it reaches into: ``first_word`` of the document,
    ``at`` in the block, ``n_words``."""
    ends = F.col("offset") + F.col("size")
    start = F.greatest(F.col("block") * block, F.col("offset"))
    return (placed.filter("size > 0")
            .withColumn("block", F.explode(F.sequence(F.expr(f"offset div {block}"),
                                                      F.expr(f"(offset + size - 1) div {block}"))))
            .select("source_no", "block", "doc_id", "text_key", "offset",
                    (start - F.col("offset")).alias("first_word"),
                    (start - F.col("block") * block).alias("at"),
                    (F.least((F.col("block") + 1) * block, ends) - start).alias("n_words")))


def slot_rows(spark: SparkSession, plan: list[dict], block: int, per_shard: int, seed: int) -> DataFrame:
    """``(shard, place, source_no, lap, block, words)``: every slot of the mix.

    ``place`` orders the slots of a shard at random; ``words`` is how many words
    of the block count.
    """
    dealt = deal([p["slots"] for p in plan], per_shard, seed)
    first = np.cumsum(dealt, axis=0) - dealt
    shards, which = np.nonzero(dealt)
    counts = [(int(s), int(p), int(first[s, p]), int(dealt[s, p]), plan[p]["blocks"], plan[p]["slots"], plan[p]["last"])
              for s, p in zip(shards, which)]
    table = spark.createDataFrame(counts, "shard long, source_no long, first long, n long, blocks long, slots long, last long")
    schema = "shard long, place long, source_no long, lap long, block long, words long"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                index = r["first"] + np.arange(r["n"], dtype=np.int64)
                lap, at = np.divmod(index, r["blocks"])
                got = np.empty_like(at)
                for one in np.unique(lap).tolist():
                    got[lap == one] = permuted(at[lap == one], r["blocks"], r["source_no"], one, seed)
                words = np.where(index == r["slots"] - 1, r["last"], block)
                with np.errstate(over="ignore"):
                    place = mix64(index.astype(np.uint64) + _keys(r["source_no"], 7, seed)[0])
                full = np.full(len(index), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (full * r["shard"], (place >> np.uint64(1)).astype(np.int64),
                                           full * r["source_no"], lap, got, words)], schema=out)

    return table.mapInArrow(run, schema)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, most: float = 2.0, block: int = 1024, per_shard: int = 1024,
        seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """The mix as ``(documents, pieces)``.

    documents: ``doc_id, text_key, source, size, source_size, target, source_no,
    offset``, one row per input row. pieces: ``shard, place, source_no, lap, block,
    doc_id, text_key, offset, first_word, n_words``: which words each slot takes,
    repeats included. Sources are weighed 3, 1, 2 in code point order, null last.
    Every source's words add up to its target, rounded; a document is taken at
    most twice (``most`` laps). Texts without words (also null) take nothing;
    repeated rows are documents of their own; an empty table gives no rows.
    """
    spark = df.sparkSession
    shared_root(spark)
    sized = sized_documents(df, id_col, text_col, source_col).checkpoint()
    sources, plan = source_table(spark, sized, share, most, block, seed)
    placed = offsets(sized, sources).checkpoint()
    slots = slot_rows(spark, plan, block, per_shard, seed)
    pieces = (block_pieces(placed, block).join(slots, ["source_no", "block"])
              .withColumn("n_words", F.least(F.col("n_words"), F.col("words") - F.col("at")))
              .filter("n_words > 0").drop("words", "at"))
    return placed, pieces


def taken(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """documents of ``mix`` with ``taken``: words the mix takes of each."""
    got = pieces.groupBy("source_no", "offset").agg(F.sum("n_words").alias("taken"))
    # Documents without words share an offset with their successor.
    some = placed.withColumn("_at", F.when(F.col("size") > 0, F.col("offset")))
    got = got.select(F.col("source_no").alias("_no"), F.col("offset").alias("_offset"), "taken")
    return (some.join(got, (some["source_no"] == got["_no"]) & (some["_at"] == got["_offset"]), "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0))).drop("_at", "_no", "_offset"))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", length_col: str | None = "n_chars", **how) -> DataFrame:
    """The documents of a mix: the columns of ``df``, a row per document and lap.

    A document that the mix takes whole appears unchanged, once or twice. One that it
    takes in part appears with the words taken: neighbouring words keep what
    stands between them, pieces that are apart are joined by a line break. What
    the mix does not take is gone. ``length_col`` gets the new number of characters.
    Null texts and texts without words are never taken; repeated rows are documents of
    their own; an empty table gives no rows. Other columns, of any name, pass through.
    """
    placed, pieces = mix(df, id_col, text_col, source_col, **how)
    own, hashed, nth, wanted_id, wanted_key, turn, cuts = unused(
        df, "own", "hashed", "nth", "wanted_id", "wanted_key", "turn", "cuts")
    # Repeated rows have one id and text: the n-th place belongs to the n-th row.
    places = W.partitionBy("doc_id", "text_key").orderBy("source_no", "offset")
    numbers = (placed.filter("size > 0").withColumn("turn", F.row_number().over(places))
               .select("source_no", "offset", "turn"))
    wanted = (pieces.join(numbers, ["source_no", "offset"])
              .groupBy(F.col("doc_id").alias(wanted_id), F.col("text_key").alias(wanted_key), F.col("turn").alias(turn))
              .agg(F.collect_list(F.struct("lap", "first_word", "n_words")).alias(cuts)))
    rows = (df.withColumns({own: F.col(f"`{id_col}`").cast("long"), hashed: F.xxhash64(F.col(f"`{text_col}`").cast("string"))})
            .withColumn(nth, F.row_number().over(W.partitionBy(own, hashed).orderBy(own))))
    joined = rows.join(wanted, F.col(own).eqNullSafe(F.col(wanted_id)) & (F.col(hashed) == F.col(wanted_key))
                       & (F.col(nth) == F.col(turn))).select(*[F.col(f"`{c}`") for c in df.columns], cuts)
    at = df.columns.index(text_col)
    size = df.columns.index(length_col) if length_col else None
    schema, word = df.schema, re.compile(WORD)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows_, texts = [], []
                for i, (text, cuts) in enumerate(zip(part.column(at).to_pylist(), part.column(len(schema)).to_pylist(), strict=True)):
                    spans = [m.span() for m in word.finditer(text)]
                    for lap in sorted({c["lap"] for c in cuts}):
                        rows_.append(i)
                        texts.append(_taken_text(text, spans, sorted(
                            (c["first_word"], c["n_words"]) for c in cuts if c["lap"] == lap)))
                columns = [c.take(pa.array(rows_, pa.int64())) for c in part.columns[:-1]]
                columns[at] = pa.array(texts, columns[at].type)
                if size is not None:
                    columns[size] = pa.array([len(t) for t in texts], columns[size].type)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            pa.default_memory_pool().release_unused()

    return joined.mapInArrow(run, schema)


def _taken_text(text: str, spans: list[tuple[int, int]], pieces: list[tuple[int, int]]) -> str:
    """The words of ``pieces`` (first word, number of words; ascending) of a text."""
    runs: list[list[int]] = []
    for first, n in pieces:
        if runs and runs[-1][1] == first:
            runs[-1][1] = first + n
        else:
            runs.append([first, first + n])
    if runs == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in runs)
