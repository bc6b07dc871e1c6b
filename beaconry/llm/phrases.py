"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed from left to right into the shortest phrases not seen before
(LZ78). Texts that compress each other share many phrases, so the overlap of
their phrase sets stands for compression-like similarity. A phrase set is kept
as the smallest hashes of its phrases; two such signatures estimate the overlap
of the sets, and give it exactly while the sets are small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import arrow_schema, keyed_texts, mix64

#: Smallest hashes kept per document, and phrases hashed at a time.
KEPT, CHUNK = 128, 1 << 14
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def parse(text: str, start: int, seen: set[str], word: str = "") -> tuple[list[int], str]:
    """Ends of the phrases of ``text[start:]`` and the open rest; ``seen`` grows.

    ``word`` is the open rest of what came before ``start``.
    """
    ends, add = [], seen.add
    for at, char in enumerate(text[start:], start + 1):
        word += char
        if word not in seen:
            add(word)
            ends.append(at)
            word = ""
    return ends, word


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """64-bit hash of each phrase, from differences of running sums, piece by piece."""
    out, begin = [], 0
    with np.errstate(over="ignore"):
        for i in range(0, len(ends), CHUNK):
            stop = np.array(ends[i:i + CHUNK], dtype=np.int64) - begin
            start = np.concatenate(([0], stop[:-1]))
            c = np.frombuffer(text[begin:ends[min(i + CHUNK, len(ends)) - 1]].encode("utf-32-le", "surrogatepass"), "<u4")
            power, back = np.full(len(c), BASE, np.uint64), np.full(len(c), INVERSE, np.uint64)
            power[0] = back[0] = 1
            power, back = np.cumprod(power), np.cumprod(back)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((c.astype(np.uint64) + np.uint64(1)) * power)))
            h = (sums[stop] - sums[start]) * back[start]
            out.append(mix64(h ^ mix64((stop - start).astype(np.uint64))))
            begin += int(stop[-1])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The KEPT smallest distinct hashes, ascending, as 32-bit values."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * KEPT:
        short = np.partition(short, 2 * KEPT)[:2 * KEPT + 1]
    return np.unique(short)[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smallest hashes of both sets together that both sets hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    first = np.concatenate(([True], both[1:] != both[:-1]))
    rank = np.cumsum(first)
    n = min(KEPT, int(rank[-1]))
    return float(np.count_nonzero(~first & (rank <= n)) / n)


def text_form(signature: np.ndarray) -> str:
    """Hexadecimal, eight digits per hash; empty for an empty text."""
    return signature.astype(">u4").tobytes().hex()


def fingerprint(text: str | None) -> np.ndarray:
    """Signature of one text; null counts as empty."""
    text = text or ""
    return smallest(phrase_hashes(text, parse(text, 0, set())[0]))


def compare_edit(text: str, other: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Signatures of ``text`` and of its edit, and the edit: the last third makes
    way for as many first characters of ``other``.

    The kept part is parsed once; its phrases serve both endings.
    """
    cut = len(text) - len(text) // 3
    edited = text[:cut] + other[:len(text) - cut]
    seen: set[str] = set()
    ends, word = parse(text[:cut], 0, seen)
    tail, _ = parse(text, cut, seen, word)
    begins = ([ends[-1] if ends else 0] + tail)[:-1]
    for a, b in zip(begins, tail):
        seen.discard(text[a:b])
    swapped, _ = parse(edited, cut, seen, word)
    shared = phrase_hashes(text[:cut], ends)
    last = ends[-1] if ends else 0

    def whole(t: str, more: list[int]) -> np.ndarray:
        return smallest(np.concatenate((shared, phrase_hashes(t[last:], [e - last for e in more]))))

    return whole(text, tail), whole(edited, swapped), edited


def _buckets(cuts: list[int]):
    bounds = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        place = np.searchsorted(bounds, ids.fillna(0).to_numpy(dtype=np.int64), side="left")
        return pd.Series(np.where(known, place, 0)).astype("int32")

    return bucket


def in_turn(rows: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, text) rows by descending id, nulls last, in buckets of an id range each.

    Every bucket ends with a copy of the row that follows it (``tail``), so that a
    task sees each row's successor; the first row follows the last one. Rows with
    the same id follow by descending text. Bucket bounds are approximate quantiles
    of the ids, fixed before the rows are dealt, so a retried task gets the same rows.
    """
    steps = [i / (4 * partitions) for i in range(1, 4 * partitions)]
    cuts = rows.agg(F.percentile_approx("doc_id", steps, max(10_000, 40 * partitions)).alias("q")).first()["q"]
    bucketed = rows.withColumn("bucket", _buckets(sorted(set(cuts or [])))("doc_id"))
    # One row per bucket: the first of each. Only the buckets' numbers reach the driver.
    heads = bucketed.groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head"))
    used = sorted(r["bucket"] for r in bucketed.select("bucket").distinct().collect())
    links = [(b, used[(i + 1) % len(used)]) for i, b in enumerate(used)]
    follow = rows.sparkSession.createDataFrame(links, "bucket int, _to int")
    tails = (heads.join(follow, "bucket")
             .select("head.doc_id", "head.text", F.col("_to").alias("bucket"), F.lit(1).alias("tail")))
    return (bucketed.withColumn("tail", F.lit(0)).unionByName(tails)
            .repartition(partitions, "bucket")
            .sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(),
                                  F.col("text").desc_nulls_last()))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """Fingerprint of each row, of its edited text, and how alike they and the next row's are.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``. Null texts count as empty, with an empty fingerprint; two empty
    fingerprints are alike (1), an empty and another one are not (0). The only row
    of a table follows itself. Repeated rows stay; an empty table gives no rows.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    out = arrow_schema(schema)

    def results(rows) -> Iterator[tuple]:
        """One task's rows, in order: at most two documents are held at a time."""
        before = waiting = None
        for doc_id, text, tail in rows:
            text = text or ""
            if before is not None:
                own, edited_print, edited = compare_edit(before[1], text)
                if waiting:
                    yield (*waiting[0], likeness(waiting[1], own))
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                waiting = ((before[0], len(before[1]), digest, text_form(own), text_form(edited_print),
                            likeness(own, edited_print)), own)
            if tail:
                yield (*waiting[0], likeness(waiting[1], fingerprint(text)))
                before = waiting = None
            else:
                before = doc_id, text

    def run(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(*(part.column(i).to_pylist() for i in range(3)), strict=True)

        held = []
        for row in results(rows()):
            held.append(row)
            if len(held) == 256:
                yield _batch(held, out)
                held = []
        if held:
            yield _batch(held, out)

    ordered = in_turn(keyed_texts(df, id_col, text_col), partitions)
    return ordered.select("doc_id", "text", "tail").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
