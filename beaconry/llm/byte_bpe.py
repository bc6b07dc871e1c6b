"""Byte-level BPE over Arrow batches with the tokenizers library.

A rank file is turned into the library's vocabulary and merges: bytes become
characters by the byte-level table, and every way to cut a token into two known
tokens is a merge of that token's rank. Each match of the split pattern is one
unit; the distinct units of a slice of rows go to the library in one batch, and
a cache of fixed size keeps their ids. Decoding looks ids up in the reversed
table; a character whose bytes lie in several tokens is put together again from
the joined bytes.
"""

from __future__ import annotations

import base64
import codecs
import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from beaconry.llm.common import SLICE_ROWS, Memo

#: Entries of the per-task cache, and the longest unit it holds.
CACHED, CACHED_CHARS = 200_000, 48


def byte_table() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def ascii_form(pattern: str) -> str:
    """The same pattern for texts of ASCII alone, in terms of the standard library."""
    sets = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r" \t\n\x0b\f\r"}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        inside = part == "[" or inside and part != "]"
        if part == r"\S":
            out.append(f"[^{sets[chr(92) + 's']}]")
        else:
            out.append((sets[part] if inside else f"[{sets[part]}]") if part in sets else part)
    return "".join(out)


class ByteBpe:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        chars = byte_table()

        def shown(token: bytes) -> str:
            return "".join([chars[b] for b in token])

        merges = [(shown(token[:cut]), shown(token[cut:]))
                  for token in sorted(ranks, key=ranks.get) for cut in range(1, len(token))
                  if token[:cut] in ranks and token[cut:] in ranks]
        self.tokenizer = Tokenizer(models.BPE({shown(t): r for t, r in ranks.items()}, merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern, self.ascii = regex.compile(pattern), re.compile(ascii_form(pattern))
        back = {c: b for b, c in enumerate(chars)}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for text, i in self.tokenizer.get_vocab().items():
            self.tokens[i] = bytes([back[c] for c in text])
        self.memo = Memo(CACHED)

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        return (self.ascii if text.isascii() else self.pattern).findall(text)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as packed 32-bit integers."""
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.int32).tobytes() for e in found]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as packed 32-bit integers."""
        self.memo.room()
        memo, rows = self.memo, [self.units(t) for t in texts]
        new = [u for u in set(itertools.chain.from_iterable(rows)) if u not in memo]
        long = {}
        for unit, ids in zip(new, self.encode_units(new)):
            (memo if len(unit) <= CACHED_CHARS else long)[unit] = ids
        if long:
            return [b"".join([memo[u] if u in memo else long[u] for u in row]) for row in rows]
        return [b"".join(map(memo.__getitem__, row)) for row in rows]

    def offsets(self, text: str | None) -> list[tuple[int, int]]:
        """Characters (start, end) that each token touches; tokens of a split
        character all carry its place."""
        spans, at = [], 0
        for unit in self.units(text):
            spans += [(at + a, at + b) for a, b in self.tokenizer.encode(unit).offsets]
            at += len(unit)
        return spans

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def stream(self, ids) -> Iterator[str]:
        """Text of each token as soon as its last character is whole; bytes that
        never make one become U+FFFD at the end."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield decoder.decode(self.tokens[i])
        yield decoder.decode(b"", final=True)


@functools.lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id",), offsets: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids array<int>`` per row, with ``offsets`` also ``starts``
    and ``ends``: the characters that each token touches.

    No special tokens: their strings are ordinary text. Null and empty texts
    give an empty array. Null ids, ties and repeated rows stay, an empty table
    gives no rows; other columns are not read.
    """
    kind = pa.list_(pa.int32())
    added = ["ids", *(["starts", "ends"] if offsets else [])]
    if set(added) & set(keep):
        raise ValueError(f"kept columns may not be called {added}")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
                       + [f"{c} array<int>" for c in added])

    def run(batches):
        model = coder(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = part.column(len(keep)).to_pylist()
                packed = model.encode(texts)
                ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
                columns = [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), ids)]
                if offsets:
                    spans = [model.offsets(t) for t in texts]
                    columns += [pa.array([[s[k] for s in row] for row in spans], kind) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])
        model.memo.clear()  # an idle worker keeps the vocabulary, not the cache
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids",
           name: str = "decoded") -> DataFrame:
    """``df`` with ids replaced by the bytes (column ``name``) that they stand for.

    A null or empty array gives no bytes; the other columns pass unchanged. An
    id outside the vocabulary is an error.
    """
    rest = [c for c in df.columns if c != ids_col]
    plain = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{ids_col}`").alias("_ids"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1]]
                       + [f"`{name}` binary"])

    def run(batches):
        model = coder(ranks_path, pattern)
        for batch in batches:
            rows = batch.column(batch.num_columns - 1)
            ends, ids = rows.offsets.to_pylist(), rows.values.to_numpy(zero_copy_only=False)
            # A null row spans no values.
            texts = [model.decode(ids[a:b].tolist()) for a, b in itertools.pairwise(ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())],
                                             names=[*rest, name])

    return plain.mapInArrow(run, schema)
