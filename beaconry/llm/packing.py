"""Best-fit decreasing packing of documents into sequences of fixed length.

Lengths are whole numbers up to the capacity, so documents of one length are
interchangeable: what best-fit decreasing does to all of them follows from their
number alone. Tasks code the texts and number their pieces within each length;
the driver gets one count per length (never more rows than the capacity), runs
best-fit decreasing over the counts with a segment tree over the remaining
capacities, and describes the places as runs of ranks. Tasks then look every
piece's place up by its rank. The result has as many sequences as best-fit
decreasing over the single documents.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import SLICE_ROWS, keyed_texts
from beaconry.llm.words import byte_coder
from beaconry.session import scratch_path

RUN_COLUMNS = ("length", "rank", "items", "bin", "per_bin", "offset")


class OpenBins:
    """Numbers of open bins by remaining capacity, in a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.ranges: list[deque] = [deque() for _ in range(capacity + 1)]

    def add(self, room: int, first: int, bins: int) -> None:
        """``bins`` bins from number ``first`` on now have ``room`` left."""
        if bins and room:
            self.ranges[room].append((first, bins))
            self._change(room, bins)

    def take(self, room: int, bins: int) -> tuple[int, int]:
        """At most ``bins`` neighbouring bins of this room: ``(first, number)``."""
        first, there = self.ranges[room].popleft()
        if there > bins:
            self.ranges[room].appendleft((first + bins, there - bins))
            there = bins
        self._change(room, -there)
        return first, there

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """Smallest room of an open bin that is not below ``least``."""
        at = least + self.leaves
        while not self.tree[at]:
            # To the next subtree on the right.
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            at += not self.tree[at]
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Places of ``counts[length]`` items of each length, as runs of ranks.

    One row per run with ``RUN_COLUMNS``: items ``rank`` to ``rank + items - 1`` of
    the length fill bins from ``bin`` on, ``per_bin`` in each, from ``offset`` on.
    A bin that takes one more item of a length stays the tightest for it while
    the item fits, so equal bins are filled together. Each time a range of bins
    is filled its room at least halves, which bounds the runs by the capacity
    (about log2(capacity) for each range, four new ranges for each length).
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths lie between 1 and the capacity")
    tree, runs, new = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            fits = (capacity if room is None else room) // length
            whole = max(1, left // fits)
            if room is None:
                first, bins, room = new, whole, capacity
                new += whole
            else:
                first, bins = tree.take(room, whole)
            per_bin = min(fits, left)
            items = per_bin * bins
            runs.append((length, rank, items, first, per_bin, capacity - room))
            tree.add(room - per_bin * length, first, bins)
            left, rank = left - items, rank + items
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, len(RUN_COLUMNS))


def place(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of the item of each length and rank."""
    step = np.int64(1) << 48
    at = np.searchsorted(runs[:, 0] * step + runs[:, 1], length * step + rank, side="right") - 1
    _, start, _, first, per_bin, offset = runs[at].T
    turn = rank - start
    return first + turn // per_bin, offset + turn % per_bin * length


def packed_ids(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as packed little-endian 32-bit integers; none for null and empty ones.

    Strings of added tokens in a text are treated as the library does by default.
    """
    found = byte_coder(path, plain=False).encode([t or "" for t in texts])
    return [np.array(ids, dtype="<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes() for ids in found]


def cuts(n: int, capacity: int) -> list[int]:
    """Ends of the pieces of a document of ``n`` ids; only the first piece may be shorter."""
    return list(range(n - (n - 1) // capacity * capacity, n + 1, capacity))


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, [ids], task, nth)`` per piece of each row.

    ``task`` and ``nth`` number the pieces of one length: ``nth`` counts within the task.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if with_ids else []),
              ("task", pa.int32()), ("nth", pa.int64())]
    schema = pa.schema(fields)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), packed_ids(part.column(1).to_pylist(), tokenizer_path)):
                    ids += end
                    start = 0
                    for k, stop in enumerate(cuts(len(ids) // 4, capacity)):
                        own = ids[4 * start:4 * stop]
                        rows.append((doc, k, start, stop - start, zlib.crc32(own),
                                     *([np.frombuffer(own, dtype=np.int32)] if with_ids else []),
                                     task, seen[stop - start]))
                        seen[stop - start] += 1
                        start = stop
                columns = zip(*rows) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)
        pa.default_memory_pool().release_unused()

    kinds = {pa.int64(): "long", pa.int32(): "int"}
    return keyed_texts(df, id_col, text_col).mapInArrow(
        run, ", ".join(f"{name} {kinds.get(kind, 'array<int>')}" for name, kind in fields))


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all rows with their place: ``(doc_id, piece, start, length, ids_crc32,
    [ids], sequence_id, offset)``.

    A document is its ids by the library without added special tokens, then
    ``end_id``. One of more than ``capacity`` ids is cut from its end into pieces of
    ``capacity``, so its first piece may be shorter; other documents are never cut.
    Null and empty texts are the end id alone. Null ids, ties and repeated rows
    are packed as rows of their own; an empty table gives no rows; other columns
    are not read. Which of the pieces of one length takes which place is arbitrary.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "pieces")
    pieces(df, tokenizer_path, capacity, end_id, id_col, text_col, with_ids).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(best_fit_decreasing(totals, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = stored.join(before, ["task", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    columns = [c for c in stored.columns if c not in ("task", "nth")]
    ranked = ranked.select(*columns, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(columns.index("length")).to_numpy(),
                            batch.column(len(columns)).to_numpy())
            placed = place(runs.value, length, rank) if batch.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(v, pa.int64()) for v in placed)],
                names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")
