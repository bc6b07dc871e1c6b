"""Removal of repeated passages by suffix automata.

A window of ``length`` consecutive words is removed where the same words start
anywhere else. The reference is the whole table, so its automata can't be sent to
every task. Each window is routed instead by its anchor, the run of words of lowest
hash inside it: equal windows have equal anchors. Consecutive windows of one
anchor are a segment. Segments whose anchor occurs once are done; the others are
the reference shards: a task builds the suffix automaton of the distinct segments of
its anchors, weighted by how often they occur, and streams them for matching
statistics. What matches over at least ``length`` words and occurs twice is removed.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import arrow_schema, mix64
from beaconry.session import shared_root

#: Words of a window and of an anchor.
LENGTH, ANCHOR = 35, 12
#: Bytes of text that a task hashes at a time, words of a reference shard, and the
#: distinct segments of an anchor beyond which its windows are counted one by one.
BYTES, SHARD_WORDS, MANY = 1 << 20, 16_384, 4_096
#: Bits of the document bitmap: a fixed size, see ``_bitmap``.
BITS = 1 << 23
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            up, down = np.full(size, self.base, np.uint64), np.full(size, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


BYTE_POWERS, WORD_POWERS = Powers(BASES[0]), Powers(BASES[1])


def _sums(values: np.ndarray, powers: Powers) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers.get(len(values))[0])))


def _between(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each half-open range, independent of its place."""
    down = powers.get(len(sums))[1]
    return mix64((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of some bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = np.concatenate(([True], SPACE[raw], [True]))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    out, first = [], 0
    while first < len(starts):  # pieces of whole words, so that no table grows with a text
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BYTES // 4, side="right")))
        at = int(starts[first])
        sums = _sums(raw[at:int(ends[last - 1])].astype(np.uint64) + np.uint64(1), BYTE_POWERS)
        out.append(_between(sums, starts[first:last] - at, ends[first:last] - at, BYTE_POWERS))
        first = last
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), starts, ends


def lowest_ahead(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the first lowest value among h[i], ..., h[i + width - 1], for each i."""
    low, at, have = h, np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        left, right = slice(0, len(low) - step), slice(step, len(low))
        keep = low[left] <= low[right]
        at = np.where(keep, at[left], at[right])
        low = np.where(keep, low[left], low[right])
        have += step
    return at


def segments(words: np.ndarray, owner: np.ndarray, length: int = LENGTH,
             anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchors of word hashes: anchor hash, segment hash, owner, first window, windows.

    ``owner`` is the text of each word (ascending); windows lie within one text.
    A segment is a run of windows with the same anchor; places count words.
    """
    if len(words) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    sums = _sums(words, WORD_POWERS)
    place = np.arange(len(words) - anchor + 1)
    h = _between(sums, place, place + anchor, WORD_POWERS)
    chosen = lowest_ahead(h, length - anchor + 1)
    whole = np.flatnonzero(owner[:len(words) - length + 1] == owner[length - 1:])
    if not len(whole):
        return segments(words[:0], owner)
    p = chosen[whole]
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (whole[1:] != whole[:-1] + 1)
                          | (owner[whole[1:]] != owner[whole[:-1]])))
    first = whole[new]
    count = np.diff(np.append(np.flatnonzero(new), len(whole)))
    p = p[new]
    s = _between(sums, first, first + count + length - 1, WORD_POWERS) ^ mix64((p - first).astype(np.uint64))
    return h[p].view(np.int64), s.view(np.int64), owner[first], first, count


def _texts(rows: list) -> tuple[bytes, np.ndarray]:
    """Texts as one byte string, a space after each, and where each begins."""
    parts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in rows]
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])
    return b" ".join([*parts, b""]), begins


def _slices(batch: pa.RecordBatch, column: int):
    """Slices of a batch with about BYTES of text each."""
    start, total = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        total += n or 0
        if total > BYTES:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def documents_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text_key, text)``; the first two tell different documents apart."""
    text = F.col(f"`{text_col}`").cast("string")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.xxhash64(text).alias("text_key"), text.alias("text"))


def anchors(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(a, s, doc_id, text_key, lo)``: every segment of every text; about one per
    ``(length - anchor + 2) / 2`` words."""
    schema = "a long, s long, doc_id long, text_key long, lo long"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 2):
                data, begins = _texts(part.column(2).to_pylist())
                with np.errstate(over="ignore"):
                    words, starts, _ = word_hashes(data)
                    owner = np.searchsorted(begins, starts, side="right") - 1
                    a, s, text, first, _ = segments(words, owner, length, anchor)
                lo = first - np.searchsorted(owner, text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(s), part.column(0).take(pa.array(text)),
                     part.column(1).take(pa.array(text)), pa.array(lo)], schema=out)

    return docs.mapInArrow(run, schema)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with weighted occurrences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state that ends where p continues with ``word``, cut from q if need be."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words, weight: int) -> None:
        """Add a sequence that occurs ``weight`` times."""
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p != -1:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            self.count[last] += weight

    def close(self) -> None:
        """Hand occurrences on to shorter endings, once after the last ``add``."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]
        self.count[0] = 0

    def matching(self, words, least: int) -> list[int]:
        """Matching statistics: at each word, how many words up to it occur together
        at least ``least`` times."""
        out, state, size = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            often, held = state, size
            while often and self.count[often] < least:
                often = self.link[often]
                held = self.length[often]
            out.append(held if often else 0)
        return out


def repeated_windows(shard: list[tuple[list, int]], length: int) -> list[int]:
    """Bit mask of the repeated windows of each (words, weight) segment of a shard."""
    automaton = SuffixAutomaton()
    for words, weight in shard:
        automaton.add(words, weight)
    automaton.close()
    masks = []
    for words, _ in shard:
        match = automaton.matching(words, 2)
        masks.append(sum(1 << i for i, m in enumerate(match[length - 1:]) if m >= length))
    return masks


def _bitmap(keys: DataFrame) -> DataFrame:
    """Hashed (doc_id, text_key) pairs as at most BITS / 64 rows ``(word, bits)``.

    A document that isn't in it can't be among the keys, so its text need not be
    shuffled to meet them. It only saves work: when full, every document passes.
    """
    h = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(BITS))
    return (keys.select(F.shiftright(h, 6).alias("word"), h.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def _flagged(docs: DataFrame, bitmap: DataFrame) -> DataFrame:
    """docs with ``maybe``: false where the bitmap rules the document out."""
    h = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(BITS))
    bit = F.getbit(F.coalesce("bits", F.lit(0).cast("long")), h.bitwiseAND(F.lit(63)).cast("int"))
    return (docs.withColumn("word", F.shiftright(h, 6)).join(F.broadcast(bitmap), "word", "left")
            .withColumn("maybe", bit == 1).drop("word", "bits"))


def _cut(docs: DataFrame, wanted: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(a, s, n, words)``: the words of one occurrence of each wanted segment."""
    schema = "a long, s long, n long, words string"
    out = arrow_schema(schema)
    listed = (wanted.groupBy("doc_id", "text_key")
              .agg(F.collect_list(F.struct("lo", "a", "s", "n")).alias("cuts")))
    some = _flagged(docs, _bitmap(wanted)).filter("maybe")
    joined = _with(some, listed, "inner").select("text", "cuts")

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 0):
                texts, cuts = part.column(0).to_pylist(), part.column(1).to_pylist()
                data, begins = _texts(texts)
                with np.errstate(over="ignore"):
                    words, starts, ends = word_hashes(data)
                    owner = np.searchsorted(begins, starts, side="right") - 1
                    _, _, text, first, count = segments(words, owner, length, anchor)
                begin = np.searchsorted(owner, np.arange(len(texts)))
                size = dict(zip(first.tolist(), count.tolist()))
                rows = []
                for i, some in enumerate(cuts):
                    for c in some:
                        at = int(begin[i]) + c["lo"]
                        stop = at + size[at] + length - 2
                        span = b" ".join(data[starts[at]:ends[stop]].split())
                        rows.append((c["a"], c["s"], c["n"], span.decode("utf-8", "surrogatepass")))
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    return joined.mapInArrow(run, schema)


def _with(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """docs joined with rows of their (doc_id, text_key); a null id matches a null id."""
    right = per_doc.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    return docs.join(right, docs["doc_id"].eqNullSafe(right["_id"])
                     & (docs["text_key"] == right["_key"]), how).drop("_id", "_key")


def _decide(cut: DataFrame, length: int) -> DataFrame:
    """``(a, s, mask)`` by the automata of shards of whole anchors, sorted by anchor."""
    schema = "a long, s long, mask long"
    out = arrow_schema(schema)

    def run(batches):
        shard, size = [], 0

        def decided():
            masks = repeated_windows([(w, n) for _, _, n, w in shard], length)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in shard]), pa.array([r[1] for r in shard]), pa.array(masks, pa.int64())],
                schema=out)

        for batch in batches:
            for a, s, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard and shard[-1][:2] == (a, s):
                    continue  # the same segment cut from a repeated row
                if size > SHARD_WORDS and shard[-1][0] != a:
                    yield decided()
                    shard, size = [], 0
                words = text.encode("utf-8", "surrogatepass").split()
                shard.append((a, s, n, words))
                size += len(words)
        if shard:
            yield decided()

    return cut.repartition("a").sortWithinPartitions("a", "s").mapInArrow(run, schema)


def _windows(cut: DataFrame, length: int) -> DataFrame:
    """``(a, s, n, j, k)``: hash k of each window j of segments."""
    schema = "a long, s long, n long, j int, k long"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for a, s, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with np.errstate(over="ignore"):
                    words = word_hashes(text.encode("utf-8", "surrogatepass"))[0]
                    place = np.arange(len(words) - length + 1)
                    k = _between(_sums(words, WORD_POWERS), place, place + length, WORD_POWERS).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), v)) for v in (a, s, n)]
                    + [pa.array(place.astype(np.int32)), pa.array(k)], schema=out)

    return cut.mapInArrow(run, schema)


def _by_window(cut: DataFrame, length: int) -> DataFrame:
    """``(a, s, mask)`` for anchors with very many distinct segments: their windows are
    summed by hash, so that no task holds all of an anchor."""
    windows = _windows(cut, length).dropDuplicates(["a", "s", "j"])
    often = windows.groupBy("a", "k").agg(F.sum("n").alias("_times")).filter("_times > 1").select("a", "k")
    return (windows.join(often, ["a", "k"])
            .groupBy("a", "s").agg(F.sum(F.expr("shiftleft(1L, j)")).alias("mask")))


def repeated_segments(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR,
                      many: int = MANY) -> DataFrame:
    """``(doc_id, text_key, lo, mask)``: windows ``lo + j`` of a document, for the bits j
    of ``mask``, whose words start elsewhere too."""
    every = anchors(docs, length, anchor)
    # Stored first, so that the join below sees two plain shuffles and a hot anchor's
    # rows, all on one side, can be split among tasks.
    shared = every.groupBy("a").agg(F.count("*").alias("_n")).filter("_n > 1").select("a").checkpoint()
    found = anchors(docs, length, anchor).join(shared, "a").checkpoint()
    distinct = (found.groupBy("a", "s")
                .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "lo")).alias("one")))
    wanted = distinct.select("a", "s", "n", "one.doc_id", "one.text_key", "one.lo")
    large = (distinct.groupBy("a").agg(F.count("*").alias("_m")).filter(F.col("_m") > many)
             .select("a").checkpoint())
    if large.isEmpty():
        masks = _decide(_cut(docs, wanted, length, anchor), length)
    else:
        masks = _decide(_cut(docs, wanted.join(large, "a", "left_anti"), length, anchor), length).unionByName(
            _by_window(_cut(docs, wanted.join(large, "a", "left_semi"), length, anchor), length))
    return found.join(masks.filter("mask <> 0"), ["a", "s"]).select("doc_id", "text_key", "lo", "mask")


def remove_repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH, anchor: int = ANCHOR, many: int = MANY) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, one row per input row.

    kept: the words that no repeated window covers, joined by one space. Words are
    runs between white space, unchanged; windows are judged on the input. Null texts
    have no words; texts with fewer words than a window keep all. Every row of a
    repeated row loses what it shares with the others. Null ids stay, an empty
    table gives no rows.
    """
    shared_root(df.sparkSession)
    docs = documents_of(df, id_col, text_col)
    repeated = repeated_segments(docs, length, anchor, many).checkpoint()
    spans = repeated.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("lo", "mask")).alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept string"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 1):
                rows = []
                for doc_id, text, found in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = text.encode("utf-8", "surrogatepass").split() if text else []
                    n = len(words)
                    if found:
                        lo = np.array([f["lo"] for f in found])
                        mask = np.array([f["mask"] for f in found])
                        which, j = np.nonzero((mask[:, None] >> np.arange(length - anchor + 1)) & 1)
                        edge = np.zeros(n + 1, dtype=np.int64)
                        np.add.at(edge, lo[which] + j, 1)
                        np.add.at(edge, lo[which] + j + length, -1)
                        words = list(itertools.compress(words, (np.cumsum(edge)[:n] == 0).tolist()))
                    rows.append((doc_id, n, n - len(words), b" ".join(words).decode("utf-8", "surrogatepass")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    flagged = _flagged(docs, _bitmap(repeated))
    clean = flagged.filter("NOT maybe").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    columns = ["doc_id", "text", "spans"]
    return (_with(flagged.filter("maybe"), spans, "left").select(*columns)
            .unionByName(clean.select(*columns)).mapInArrow(run, schema))
