"""Alignment of two tokenizers over the bytes of each text.

Each tokenizer's tokens and the text's bytes make an incidence matrix, token by
byte, built by hand as compressed sparse rows. Gustavson's row-by-row product of
A with the transpose of B links the tokens that overlap, with the number of
bytes they share. Byte offsets where tokens of both end cut the text into groups;
the product of the token-group matrices links the tokens that share a group.

No token of either side spans a cut of ``words.parts``, so the matrices of a text
are block-diagonal in its parts. The blocks of the distinct parts of a slice of
rows are multiplied together, once, and kept in a cache of fixed size.

How often a pair of ids is linked in the corpus is counted in Spark over each
document's distinct pairs. Pairs that hold at least one in ``HOT`` of all rows are
at most ``HOT`` by count, so their counts are broadcast; all others are joined.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import Memo, keyed_texts, map_rows
from beaconry.llm.words import byte_coder, parts
from beaconry.session import scratch_path

SPACE = "▁"
#: A pair of ids is ``a << B_BITS | b``.
B_BITS = 24
#: Most pair counts that are broadcast: 65,536 of 17 bytes.
HOT = 1 << 16
#: Entries of the cache that a worker keeps from task to task, and the longest part it holds.
CACHED, CACHED_CHARS = 300_000, 48
#: Entries of a product that are held at a time.
BLOCK = 1 << 20


@dataclass
class Csr:
    """A sparse 0-1 matrix: the columns of row ``i`` are ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @classmethod
    def of_spans(cls, lengths: np.ndarray) -> Csr:
        """Row ``i`` covers the next ``lengths[i]`` columns."""
        indptr = np.concatenate(([0], np.cumsum(lengths)))
        return cls(indptr, np.arange(indptr[-1]), int(indptr[-1]))

    @classmethod
    def of_labels(cls, labels: np.ndarray, columns: int) -> Csr:
        """Row ``i`` has the one column ``labels[i]``."""
        return cls(np.arange(len(labels) + 1), labels, columns)

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        row = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        sizes = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.concatenate(([0], np.cumsum(sizes))), row[order], self.rows)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Terms of each row of ``a @ b`` before equal columns are added up."""
    terms = np.concatenate(([0], np.cumsum(np.diff(b.indptr)[a.indices])))
    return terms[a.indptr[1:]] - terms[a.indptr[:-1]]


def gustavson(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries ``(row, column, value)`` of ``a @ b`` by row and column, in blocks of rows.

    Row ``i`` of the product is the sum of the rows of ``b`` that row ``i`` of ``a`` names.
    """
    ends = np.cumsum(product_sizes(a, b))
    start = 0
    while start < a.rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        named = a.indices[a.indptr[start]:a.indptr[stop]]
        of_row = np.repeat(np.arange(start, stop), np.diff(a.indptr[start:stop + 1]))
        size = b.indptr[named + 1] - b.indptr[named]
        first = np.repeat(b.indptr[named] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        column = b.indices[first + np.arange(len(first))]
        key = np.repeat(of_row, size) * b.columns + column
        key, value = np.unique(key, return_counts=True)
        yield key // b.columns, key % b.columns, value
        start = stop


@dataclass
class Blocks:
    """Several texts laid end to end: ids, byte lengths and owners of both sides' tokens."""

    a_ids: np.ndarray
    a_len: np.ndarray
    a_text: np.ndarray
    b_ids: np.ndarray
    b_len: np.ndarray
    b_text: np.ndarray

    def __post_init__(self):
        a_end, b_end = np.cumsum(self.a_len), np.cumsum(self.b_len)
        cut = np.intersect1d(a_end, b_end, assume_unique=True)
        self.groups = len(cut)
        self.a_group, self.b_group = np.searchsorted(cut, a_end), np.searchsorted(cut, b_end)
        first = np.concatenate(([True], self.a_group[1:] != self.a_group[:-1])) if self.groups else np.zeros(0, bool)
        self.group_text = self.a_text[first]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Overlapping tokens ``(a, b, bytes)``: the product of the byte incidences."""
        blocks = list(gustavson(Csr.of_spans(self.a_len), Csr.of_spans(self.b_len).transposed()))
        return tuple(np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3

    def _by_group(self) -> tuple[Csr, Csr]:
        return (Csr.of_labels(self.a_group, self.groups),
                Csr.of_labels(self.b_group, self.groups).transposed())

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens that share a group, in blocks: the product of the group incidences."""
        return gustavson(*self._by_group())

    def group_link_counts(self) -> np.ndarray:
        """How many such links each A token has; a token lies in one group, so terms are links."""
        return product_sizes(*self._by_group())

    def group_strings(self, a_name: list[str], b_name: list[str]) -> list[str]:
        """``a1,a2|b1`` of every group, with the names of the ids."""
        a, b = [a_name[i] for i in self.a_ids.tolist()], [b_name[i] for i in self.b_ids.tolist()]
        a_at = np.searchsorted(self.a_group, np.arange(self.groups + 1)).tolist()
        b_at = np.searchsorted(self.b_group, np.arange(self.groups + 1)).tolist()
        return [f"{a[i] if j == i + 1 else ','.join(a[i:j])}|{b[k] if n == k + 1 else ','.join(b[k:n])}"
                for i, j, k, n in zip(a_at, a_at[1:], b_at, b_at[1:])]


class Aligner:
    """Byte-level BPE of a tokenizer file (A) beside a piece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        self.a = byte_coder(a_path, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        if self.b.encode("A  b", out_type=str) != self.b.encode("A", out_type=str) + [SPACE, SPACE + "b"]:
            raise ValueError("only piece models that keep white space and put one space before a text are aligned")
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in names):
            raise ValueError("pieces that hold a space after another character are not supported")
        if not any(map(self.b.is_byte, range(len(names)))):
            raise ValueError("only piece models that fall back to bytes are aligned")
        self.b_len = np.array([1 if self.b.is_byte(i) else len(p.replace(SPACE, " ").encode())
                               for i, p in enumerate(names)], dtype=np.int64)
        self.a_len = np.zeros(max(self.a.tokens) + 1, dtype=np.int64)
        self.a_len[list(self.a.tokens)] = list(map(len, self.a.tokens.values()))
        self.a_name, self.b_name = (list(map(str, range(len(x)))) for x in (self.a_len, self.b_len))
        self.memo = Memo(CACHED)

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides for each text that is not empty; none where their bytes
        are not those of space and text.

        A gives every byte back. B does so but for its sign of a space, which has three
        bytes in a text and one as a token: their bytes agree if their number does.
        """
        a = self.a.encode([" " + t for t in texts])
        b = self.b.encode(texts, num_threads=1) if texts else []
        sizes = [np.bincount(np.repeat(np.arange(len(texts)), list(map(len, ids))), minlength=len(texts),
                             weights=length[np.fromiter(itertools.chain.from_iterable(ids), np.int64)])
                 for ids, length in ((a, self.a_len), (b, self.b_len))]
        return [x if n == m else None for x, n, m in zip(zip(a, b), *sizes)]

    def blocks(self, tokens: list[tuple[list[int], list[int]]]) -> Blocks:
        a_ids = np.fromiter(itertools.chain.from_iterable(t[0] for t in tokens), np.int64)
        b_ids = np.fromiter(itertools.chain.from_iterable(t[1] for t in tokens), np.int64)
        number = np.arange(len(tokens))
        return Blocks(a_ids, self.a_len[a_ids], np.repeat(number, [len(t[0]) for t in tokens]),
                      b_ids, self.b_len[b_ids], np.repeat(number, [len(t[1]) for t in tokens]))

    def _aligned(self, texts: list[str]) -> list[tuple | None]:
        """``(pairs, groups, n_a, n_b, n_groups, n_links, n_shared)`` of each part."""
        coded = self.tokens(texts)
        good = [c for c in coded if c]
        if not good:
            return [None] * len(texts)
        x = self.blocks(good)
        a, b, _ = x.links()
        pairs = (x.a_ids[a] << B_BITS | x.b_ids[b]).astype("<i8")
        of = x.a_text[a]
        at = np.searchsorted(of, np.arange(len(good) + 1)).tolist()
        groups, g_at = x.group_strings(self.a_name, self.b_name), np.searchsorted(x.group_text, np.arange(len(good) + 1)).tolist()
        shared = np.bincount(x.a_text, weights=x.group_link_counts(), minlength=len(good)).astype(np.int64).tolist()
        found = iter([(pairs[at[k]:at[k + 1]].tobytes(), ";".join(groups[g_at[k]:g_at[k + 1]]), len(ids_a), len(ids_b),
                       g_at[k + 1] - g_at[k], at[k + 1] - at[k], shared[k]) for k, (ids_a, ids_b) in enumerate(good)])
        return [next(found) if c else None for c in coded]

    def align(self, texts: list[str | None]) -> list[tuple | None]:
        """Digest of each text, put together from its parts: ``(distinct pairs, their
        numbers, groups string, n_a, n_b, n_groups, n_links, n_shared)``; None without tokens.

        B's bytes only ever get shorter (a space for the three bytes of its sign), so
        the whole agrees just when all parts do.
        """
        self.memo.room()
        memo, long = self.memo, {}
        rows = [parts(t) if t else [] for t in texts]
        new = [p for p in set(itertools.chain.from_iterable(rows)) if p not in memo]
        for part, got in zip(new, self._aligned(new)):
            (memo if len(part) <= CACHED_CHARS else long)[part] = got
        look = (lambda p: memo[p] if p in memo else long[p]) if long else memo.__getitem__
        out = []
        for row in rows:
            got = list(map(look, row))
            if not got or None in got:
                out.append(None)
                continue
            pairs, groups, *numbers = zip(*got)
            distinct, times = np.unique(np.frombuffer(b"".join(pairs), dtype="<i8"), return_counts=True)
            out.append((distinct, times.astype(np.int32), ";".join(groups), *map(sum, numbers)))
        return out


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def alignments(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Whole alignment of each row: ids (``a_ids``, ``b_ids``), the group of every token
    (``a_groups``, ``b_groups``), and the links (``link_a``, ``link_b``: places of the
    tokens, from 0; ``link_bytes``: bytes they share).

    Texts that are null, empty or not given back by their tokens' bytes have empty
    arrays. Null ids, ties and repeated rows stay, an empty table gives no rows;
    other columns are not read.
    """
    def work(ids, texts):
        model = aligner(a_path, b_path)
        rows = []
        for text in texts:
            coded = model.tokens([text])[0] if text else None
            if coded is None:
                rows.append(([],) * 7)
                continue
            x = model.blocks([coded])
            rows.append((x.a_ids, x.b_ids, x.a_group, x.b_group, *x.links()))
        return (ids, *zip(*rows)) if rows else ([],) * 8

    names = ("a_ids", "b_ids", "a_groups", "b_groups", "link_a", "link_b", "link_bytes")
    return map_rows(keyed_texts(df, id_col, text_col), work,
                    "doc_id long, " + ", ".join(f"{n} array<long>" for n in names))


def digests(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Counts, hash of the groups and distinct linked pairs of each row."""
    def work(ids, texts):
        model = aligner(a_path, b_path)
        empty = np.zeros(0, np.int64)
        rows = [x or (empty, empty, None, 0, 0, 0, 0, 0) for x in model.align(texts)]
        pairs, times, groups, *numbers = zip(*rows) if rows else ([],) * 8
        return (ids, *numbers, [hashlib.sha256(g.encode()).hexdigest() if g is not None else "" for g in groups],
                pairs, times)

    return map_rows(keyed_texts(df, id_col, text_col), work,
                    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, "
                    "groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(stored: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked, and whether no pair of
    its A id is in more of them (at most one row per A id is broadcast)."""
    spark, path = stored.sparkSession, scratch_path(stored.sparkSession, "pair-counts")
    (stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
     .withColumn("a", F.shiftright("pair", B_BITS)).write.parquet(path))
    counts = spark.read.parquet(path)
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_corpus(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256)``.

    ``n_links`` counts the overlapping tokens, ``n_shared`` those of one group. A
    pair's count is the number of rows that hold it linked; ``n_best`` counts the
    links whose count no other pair of the A id exceeds, ``count_sum`` adds the counts
    up over the links. Texts that are null, empty or not given back by their
    tokens' bytes have zeros and an empty ``groups_sha256``. Null ids, ties and repeated
    rows stay and count each; an empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    path, counted = scratch_path(spark, "digests"), scratch_path(spark, "pair-ranks")
    (digests(df, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(path))
    stored = spark.read.parquet(path)
    pair_counts(stored).write.parquet(counted)
    counts = spark.read.parquet(counted)
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.filter(F.col("n") * HOT >= total).orderBy("pair").toPandas()  # at most HOT rows
    hot = spark.sparkContext.broadcast((known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64),
                                        known["best"].to_numpy(bool)))
    digest = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document with the sums over broadcast pairs (a negative key of its
        own as pair), and one per pair that is left."""
        pair_of, n_of, best_of = hot.value
        for batch in batches:
            rows, pairs, times = batch.column(0), batch.column(1), batch.column(2)
            size = np.diff(pairs.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), size)
            pair, many = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pair_of, pair), max(len(pair_of) - 1, 0))
            hit = pair_of[at] == pair if len(pair_of) else np.zeros(len(pair), bool)
            n, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            n[hit], best[hit] = n_of[at[hit]], best_of[at[hit]]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], owner, many * best)
            np.add.at(sums[1], owner, many * n)
            number = rows.to_numpy()
            rest, none = np.flatnonzero(~hit), pa.nulls
            head = [rows, pa.array(-1 - number), none(len(rows), pa.int64()), *map(pa.array, sums)]
            tail = [pa.array(number[owner[rest]]), pa.array(pair[rest]), pa.array(many[rest]),
                    *(none(len(rest), pa.int64()) for _ in sums)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.concat_arrays([h, t]) for h, t in zip(head, tail)),
                 *(pa.concat_arrays([c, none(len(rest), c.type)]) for c in batch.columns[3:])],
                names=["row", "pair", "many", "n_best", "count_sum", *digest])

    kinds = ", ".join("groups_sha256 string" if c == "groups_sha256" else f"{c} long" for c in digest)
    looked = stored.select("row", "pairs", "times", *digest).mapInArrow(
        run, f"row long, pair long, many long, n_best long, count_sum long, {kinds}")
    rare = counts.filter(F.col("n") * HOT < total)
    link = F.coalesce(F.col("many"), F.lit(0))
    joined = looked.join(rare, "pair", "left").groupBy("row").agg(
        F.sum(F.coalesce("n_best", F.when(F.col("best"), link), F.lit(0))).alias("n_best"),
        F.sum(F.coalesce("count_sum", link * F.col("n"), F.lit(0))).alias("count_sum"),
        *[F.max(c).alias(c) for c in digest])
    return joined.select(*digest[:-1], "n_best", "count_sum", "groups_sha256")
