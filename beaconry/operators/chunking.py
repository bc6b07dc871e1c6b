"""Text chunks, transcript reassembly and header fields."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = ("\n\n", "\n", " ")  # fixed values: paragraph, line, word


def fixed_chunks(docs: DataFrame, keys: list[str], text: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` characters, each sharing ``overlap`` with the one before."""
    step = size - overlap
    n = F.greatest(F.ceil((F.char_length(text) - overlap) / step), F.lit(1)).cast("int")
    rows = docs.select(*keys, text, F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_index"))
    return rows.select(*keys, "chunk_index",
                       F.substring(F.col(text), F.col("chunk_index") * step + 1, F.lit(size)).alias("chunk_text"))


def _pieces(text: str, lo: int, hi: int, size: int, level: int = 0) -> Iterator[int]:
    """Ends of consecutive pieces of text[lo:hi], none longer than ``size``."""
    if hi - lo <= size:
        yield hi
    elif level == len(SEPARATORS):
        yield from range(lo + size, hi, size)
        yield hi
    else:
        sep, start = SEPARATORS[level], lo
        while start < hi:
            found = text.find(sep, start, hi)
            end = hi if found < 0 else found + len(sep)
            yield from _pieces(text, start, end, size, level + 1)
            start = end


def chunk_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Chunks of at most ``size`` characters cut at the coarsest boundary that fits.

    Every chunk is a piece of the text; the next one starts at the first
    boundary within the last ``overlap`` characters of the previous.
    """
    ends = list(_pieces(text, 0, len(text), size))
    starts = [0, *ends[:-1]]
    chunks, first = [], 0
    while first < len(ends):
        last = first
        while last + 1 < len(ends) and ends[last + 1] - starts[first] <= size:
            last += 1
        chunks.append((starts[first], ends[last]))
        nxt = last + 1
        while nxt - 1 > first and ends[last] - starts[nxt - 1] <= overlap:
            nxt -= 1
        # Step back only as far as the next new piece still fits.
        while last + 1 < len(ends) and nxt <= last and ends[last + 1] - starts[nxt] > size:
            nxt += 1
        first = nxt if last + 1 < len(ends) else len(ends)
    return chunks


def recursive_chunks(docs: DataFrame, keys: list[str], text: str, size: int = 1200,
                     overlap: int = 200) -> DataFrame:
    """Paragraph → line → word chunks; the split runs inside the reading tasks."""
    schema = docs.select(*keys).schema.add("chunk_index", T.IntegerType()).add("chunk_text", T.StringType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):  # bounds the output held at once
                part = batch.iloc[start:start + 256].reset_index(drop=True)
                part["chunk_text"] = [[v[a:b] for a, b in chunk_spans(v, size, overlap)]
                                      for v in part.pop(text)]
                out = part.explode("chunk_text")
                out.insert(len(keys), "chunk_index", out.groupby(level=0).cumcount().astype("int32"))
                yield out

    return docs.select(*keys, text).filter(F.char_length(text) > 0).mapInPandas(run, schema)


def reassemble(lines: DataFrame, key: str, order: list[str], line: str, text: str) -> DataFrame:
    """Lines of each document joined in the order of the columns ``order``."""
    items = F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("_line"))))
    return lines.groupBy(key).agg(F.array_join(F.transform(items, lambda x: x["_line"]), "\n").alias(text))


# Call type by id prefix.
CALL_TYPES = {"CS": "support", "SD": "sales", "SE": "sales", "CE": "compliance"}


def header_fields(docs: DataFrame, text: str) -> DataFrame:
    """call_id from the ``CALL_ID:`` header and call_type from its prefix."""
    call_id = F.nullif(F.regexp_extract(text, r"CALL_ID:\s*(\S+)", 1), F.lit(""))
    kind = F.lit("other")
    for prefix, name in CALL_TYPES.items():
        kind = F.when(F.left(call_id, F.lit(2)) == prefix, name).otherwise(kind)
    return docs.withColumns({"call_id": call_id, "call_type": kind})
