"""Language identification by interpolated Kneser-Ney character models.

A word is its letters in lower case between spaces; the model predicts each
letter and the closing space from the three characters before it. Four-gram
counts of the learning rows are summed by Spark; lower orders count distinct
left neighbours. Grams are folded to 22-bit hashes before they leave Spark, so
a model has at most 2**22 rows per order and language however large the corpus
is. It is kept as sorted hash arrays with one column of probabilities per
language. A text goes to the language of lowest cross-entropy per character,
unless that lies beyond the language's calibrated limit.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import Memo, arrow_schema, map_rows, mix64
from beaconry.session import scratch_path

ORDER = 4
HASH_BITS = 22
UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")
#: Entries of the per-task cache of token scores, and tokens that are cut into grams at a time.
CACHED, AT_ONCE = 150_000, 8_192


def padded(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-grams (packed in 64 bits) of the words in each token, and the token of each."""
    parts = ["".join([f"   {w} " for w in LETTERS.findall(t)]) for t in tokens]
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(tokens)), [len(p) for p in parts])
    if len(chars) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    c = np.minimum(chars, 0xFFFF).astype(np.uint64)
    grams = (c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:]
    # A word's first three characters are the spaces before it and are not predicted.
    real = (owner[3:] == owner[:-3]) & ~((c[3:] == 32) & (c[2:-1] == 32))
    return grams[real], owner[3:][real]


def fold(gram: np.ndarray, length: int) -> np.ndarray:
    """22-bit hash of the last ``length`` characters of packed grams."""
    with np.errstate(over="ignore"):
        kept = gram & np.uint64((1 << 16 * length) - 1)
        return (mix64(kept + np.uint64(length * 0x9E37)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


@dataclass
class Model:
    """Sorted hashes and per-language columns of each order, and what a text may cost."""

    languages: list[str]
    base: np.ndarray
    grams: list[np.ndarray] = field(default_factory=list)
    chances: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    limits: np.ndarray | None = None

    def log2(self, gram: np.ndarray) -> np.ndarray:
        """log2 probability of each packed gram's last character, a column per language."""
        p = np.repeat(self.base[None, :], len(gram), axis=0)
        for k in range(1, ORDER + 1):
            h = fold(gram, k)
            at = np.minimum(np.searchsorted(self.grams[k - 1], h), len(self.grams[k - 1]) - 1)
            hit = self.grams[k - 1][at] == h
            if k > 1 and not hit.all():
                miss = np.flatnonzero(~hit)
                x = fold(gram[miss] >> np.uint64(16), k - 1)
                where = np.minimum(np.searchsorted(self.contexts[k - 1], x), len(self.contexts[k - 1]) - 1)
                known = self.contexts[k - 1][where] == x
                p[miss[known]] *= self.backoff[k - 1][where[known]]
            p[hit] = self.chances[k - 1][at[hit]]
        return np.log2(np.maximum(p, 1e-30))


def _counted(df: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` partial counts of (lang, text) rows."""
    schema = "lang string, gram long, n long"
    out = arrow_schema(schema)

    def flush(held):
        parts = [(lang, tokens[i:i + AT_ONCE], counts) for lang, counts in held.items()
                 for tokens in [list(counts)] for i in range(0, len(tokens), AT_ONCE)]
        for lang, tokens, counts in parts:
            grams, owner = padded(tokens)
            times = np.array([counts[t] for t in tokens], dtype=np.int64)[owner]
            kinds, which = np.unique(grams, return_inverse=True)
            sums = np.bincount(which, weights=times, minlength=len(kinds)).astype(np.int64)
            if len(kinds):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds.view(np.int64)), pa.array(sums)],
                    schema=out)

    def run(batches):
        held: dict[str, Counter] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.setdefault(lang, Counter()).update(text.lower().split())
                    if sum(map(len, held.values())) > CACHED:
                        yield from flush(held)
                        held.clear()
            pa.default_memory_pool().release_unused()
        yield from flush(held)

    return df.mapInArrow(run, schema)


def _folded(grams: DataFrame, order: int) -> DataFrame:
    """Counts of one order by hash, with the hashes of context and suffix."""
    schema = "lang string, h long, x long, s long, n long"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            g = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            zero = np.zeros(len(g), np.int64)
            x = fold(g >> np.uint64(16), order - 1) if order > 1 else zero
            s = fold(g, order - 1) if order > 1 else zero
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fold(g, order)), pa.array(x), pa.array(s), batch.column(2)], schema=out)

    return (grams.select("lang", "gram", "n").mapInArrow(run, schema)
            .groupBy("lang", "h").agg(F.min("x").alias("x"), F.min("s").alias("s"), F.sum("n").alias("n")))


def estimate(tables: list[pd.DataFrame], languages: list[str], alphabet: int) -> Model:
    """Interpolated Kneser-Ney columns from the folded counts of orders 1 to 4."""
    column = {name: i for i, name in enumerate(languages)}
    model = Model(languages, np.zeros(len(languages)))
    lower = None
    for k, table in enumerate(tables, 1):
        keys, at = np.unique(table["h"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(keys), len(languages)))
        np.add.at(counts, (at, table["lang"].map(column).to_numpy()), table["n"].to_numpy())
        x, s = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        x[at], s[at] = table["x"].to_numpy(), table["s"].to_numpy()
        contexts, of = np.unique(x, return_inverse=True)
        total, kinds = np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages)))
        np.add.at(total, of, counts)
        np.add.at(kinds, of, counts > 0)
        once, twice = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
        discount = np.clip(np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.1, 0.9)
        safe = np.maximum(total, 1)
        backoff = np.where(total > 0, discount * kinds / safe, 1.0)
        if k == 1:
            model.base = backoff[0] / alphabet
            under = np.full(counts.shape, 1.0 / alphabet)
        else:
            under = lower[np.minimum(np.searchsorted(model.grams[-1], s), len(lower) - 1)]
        lower = np.maximum(counts - discount, 0) / safe[of] + backoff[of] * under
        model.grams.append(keys)
        model.chances.append(lower)
        model.contexts.append(contexts)
        model.backoff.append(backoff)
    return model


def _labelled(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return (df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
            .filter("lang IS NOT NULL AND text IS NOT NULL"))


def _fit(rows: DataFrame) -> tuple[Model | None, DataFrame]:
    """A model without limits from the counts of all (lang, text) rows, and those counts."""
    counted = grams = _counted(rows).groupBy("lang", "gram").agg(F.sum("n").alias("n")).checkpoint()
    tables = []
    for k in range(ORDER, 0, -1):
        tables.insert(0, _folded(grams, k).toPandas())
        mask = (1 << 16 * (k - 1)) - 1
        if k > 1:  # the next order counts the distinct characters to the left
            grams = (grams.select("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
                     .groupBy("lang", "gram").agg(F.count("*").alias("n")))
    if not len(tables[0]):
        return None, counted
    languages = sorted(tables[0]["lang"].unique())
    return estimate(tables, languages, tables[0]["h"].nunique() + 1), counted


def _shuffled_costs(model: Model, counted: DataFrame) -> np.ndarray:
    """Bits per character of each language's texts with all their letters in random places,
    by the model that likes them most: an expectation over every row, without any draw.

    Words keep their lengths, letters are independent with their share of the language's
    letters. The logarithm of a probability is that of the next lower order, plus the
    back-off of a known context, plus what a seen gram changes; so its mean is a sum over
    known contexts and seen grams, each weighted by its chance. Terms are whole numbers of
    2**-40 bits, so the sum does not depend on its order.
    """
    column = {name: i for i, name in enumerate(model.languages)}
    size = len(column)

    def char(i: int) -> Column:
        return F.shiftright("gram", 16 * i).bitwiseAND(F.lit(0xFFFF))

    gaps = sum([F.when(char(i) == 32, 1 << i).otherwise(0) for i in range(1, ORDER)], F.when(char(0) == 32, 1).otherwise(0))
    patterns, letters = np.zeros((size, 1 << ORDER)), np.zeros((size, 1 << 16))
    for lang, gap, n in counted.groupBy("lang", gaps.alias("gap")).agg(F.sum("n")).collect():
        patterns[column[lang], gap] = n
    for lang, c, n in counted.groupBy("lang", char(0).alias("c")).agg(F.sum("n")).collect():
        letters[column[lang], c] = n
    patterns /= patterns.sum(axis=1, keepdims=True)
    letters[:, 32] = 0
    letters /= np.maximum(letters.sum(axis=1, keepdims=True), 1)
    letters[:, 32] = 1  # where spaces are is part of the pattern
    shared = counted.sparkSession.sparkContext.broadcast((model, patterns, letters))  # at most 2**22 rows per order
    schema = "k long, m long, bits long"
    out = arrow_schema(schema)

    def found(keys, values, h):
        return values[np.minimum(np.searchsorted(keys, h), len(keys) - 1)]

    def terms(k, first, gram):
        """Chance by language, and change in bits by model, of grams (``first`` 0) or contexts (1) of an order."""
        m, patterns, letters = shared.value
        chars = [(gram >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(first, k)]
        gap = sum((c == 32).astype(np.int64) << i for i, c in enumerate(chars, first))
        kept = ((1 << k) - 1) & ~first
        chance = np.zeros((size, 1 << ORDER))
        for p in range(1 << ORDER):
            chance[:, p & kept] += patterns[:, p]
        weight = chance[:, gap]
        for c in chars:
            weight = weight * letters[:, c.astype(np.int64)]
        if k == 1:
            return weight, np.log2(np.maximum(found(m.grams[0], m.chances[0], fold(gram, 1)), 1e-30))
        back = found(m.contexts[k - 1], m.backoff[k - 1], fold(gram >> np.uint64(16), k - 1))
        if first:
            return weight, np.log2(np.maximum(back, 1e-30))
        whole = found(m.grams[k - 1], m.chances[k - 1], fold(gram, k))
        under = found(m.grams[k - 2], m.chances[k - 2], fold(gram, k - 1))
        return weight, np.log2(np.maximum(whole, 1e-30)) - np.log2(np.maximum(back * under, 1e-30))

    def run(batches):
        total, at_once = np.zeros((size, size), np.int64), max(1, (1 << 18) // size ** 2)
        for batch in batches:
            order, first = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            grams = batch.column(2).to_numpy().view(np.uint64)
            for k, f in sorted(set(zip(order.tolist(), first.tolist()))):
                some = grams[(order == k) & (first == f)]
                for i in range(0, len(some), at_once):
                    weight, bits = terms(k, f, some[i:i + at_once])
                    total += np.rint(weight[:, None, :] * bits.T[None, :, :] * 2.0 ** 40).astype(np.int64).sum(axis=2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v.ravel()) for v in (*np.indices(total.shape), total)], schema=out)

    places = [(k, f) for k in range(1, ORDER + 1) for f in ((0, 1) if k > 1 else (0,))]
    every = counted.select(F.inline(F.array(*[F.struct(
        F.lit(k).cast("long").alias("k"), F.lit(f).cast("long").alias("first"),
        F.col("gram").bitwiseAND(F.lit(((1 << 16 * k) - 1 if k < ORDER else -1) & ~(0xFFFF * f))).alias("gram"))
        for k, f in places]))).distinct()
    total = np.zeros((size, size))
    for lang, other, bits in every.mapInArrow(run, schema).groupBy("k", "m").agg(F.sum("bits")).collect():
        total[lang, other] = -bits / 2.0 ** 40
    return total.min(axis=1)


def _limits(model: Model, counted: DataFrame, real: DataFrame, quantile: float) -> np.ndarray:
    """Rejection limit of each language; ``real`` has ``lang_pred, cost`` of the labelled rows
    that went to their own language."""
    # Null: rows of all languages, for one that none of its own rows went to.
    real = real.rollup("lang_pred").agg(F.percentile_approx("cost", quantile, 10_000).alias("q"))
    most = {r["lang_pred"]: r["q"] for r in real.collect()}

    def limit(name, apart):
        q = most.get(name, most.get(None))
        return np.inf if q is None else (q + max(apart, q)) / 2

    return np.array([limit(*pair) for pair in zip(model.languages, _shuffled_costs(model, counted).tolist())])


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
          calibration_rows: int = 20_000, quantile: float = 0.999) -> Model | None:
    """A model from all rows with a text and a language; None without any.

    Counts cover every row. The rejection limit of a language lies half way between
    the ``quantile`` of cross-entropy of all its rows and the mean of its texts with
    their letters shuffled, which follows from the counts of all rows too. Nothing is
    sampled; ``calibration_rows`` is kept for callers and bounds nothing.
    """
    rows = _labelled(df, text_col, lang_col)
    model, counted = _fit(rows)
    if model is not None:
        real = _scored(rows.select("lang", "text"), model).filter("lang_pred = id")
        model.limits = _limits(model, counted, real, quantile)
    return model


def _scored_once(df: DataFrame, learns: Column, text_col: str, lang_col: str, quantile: float) -> tuple[DataFrame, dict[str, Column], Column] | None:
    """All rows with their scores, stored, after learning from those where ``learns`` holds.

    Each text is scored once: the limits come from the same scores that they are
    applied to. The text is not stored, all other columns are. Also the stored score
    columns by name, and whether a row is accepted.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "scored")
    rows = _labelled(df.filter(learns), text_col, lang_col)
    model, counted = _fit(rows)
    if model is None:
        return None
    clear = "_" * (1 + max(map(len, df.columns)))
    added = {n: clear + n for n in ("lang", "learns", "lang_pred", "score", "cost", "n_letters")}
    at, width = df.columns.index(text_col), len(df.columns)
    marked = df.withColumns({added["lang"]: F.col(f"`{lang_col}`").cast("string"), added["learns"]: learns})
    kept = [k for k in range(width + 2) if k != at]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for k, f in enumerate(marked.schema) if k in kept]
                       + [f"{added['lang_pred']} string, {added['score']} double, {added['cost']} double, {added['n_letters']} long"])
    shared = spark.sparkContext.broadcast(model)  # at most 2**22 rows per order
    kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64()]
    names = [marked.columns[k] for k in kept] + list(added.values())[2:]

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                got = list(zip(*scorer.score(part.column(at).to_pylist())))[:4]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in kept), *(pa.array(v, t) for v, t in zip(got, kinds))], names=names)
            pa.default_memory_pool().release_unused()

    marked.mapInArrow(run, schema).write.parquet(path)
    stored = spark.read.parquet(path)
    score = {n: F.col(c) for n, c in added.items()}
    own = score["learns"] & (score["lang"] == score["lang_pred"])
    real = stored.filter(own).select(score["lang_pred"].alias("lang_pred"), score["cost"].alias("cost"))
    limits = _limits(model, counted, real, quantile)
    limit = F.create_map(*[F.lit(v) for pair in zip(model.languages, limits.tolist()) for v in pair])
    return stored, score, F.coalesce(score["cost"] <= limit[score["lang_pred"]], F.lit(False))


def learn_and_identify(df: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", calibration_rows: int = 20_000, quantile: float = 0.999) -> DataFrame:
    """``identify`` of all rows with the model that ``learn`` makes of those where ``learns``
    holds, each text scored once."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                     F.col(f"`{lang_col}`").alias("lang"), learns.alias("from"))
    got = _scored_once(rows, F.col("from"), "text", "lang", quantile)
    if got is None:
        return identify(rows, None, "id")
    stored, score, accepted_row = got
    return stored.select("id", *[score[c].alias(c) for c in ("lang_pred", "score", "cost", "n_letters")],
                         accepted_row.alias("accepted"))


def learn_and_accept(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     calibration_rows: int = 20_000, quantile: float = 0.999) -> DataFrame:
    """``accepted`` of all rows with the model that ``learn`` makes of them, each text scored
    once. Columns of any name and type pass unchanged; an empty table stays empty.

    Whether a row is accepted follows from its text alone, so what is stored is one digest
    and score per row; the digests of rejected texts are then joined to the rows, broadcast
    by Spark where they are few enough.
    """
    text = F.col(f"`{text_col}`").cast("string")
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = df.select(digest.alias("digest"), text.alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    got = _scored_once(rows, F.lit(True), "text", "lang", quantile)
    if got is None:
        return accepted(df, None)
    stored, _, accepted_row = got
    clear = "_" * (1 + max(map(len, df.columns))) + "digest"
    refused = stored.filter(~accepted_row).select(F.col("digest").alias(clear + "_of")).distinct()
    return (df.filter(text.isNotNull()).withColumn(clear, digest)
            .join(refused, F.col(clear) == F.col(clear + "_of"), "left_anti").drop(clear))


class Scorer:
    """Scores whole texts with a model; token sums are remembered up to a fixed number."""

    def __init__(self, model: Model):
        self.model, self.memo = model, Memo(CACHED)
        self.table = np.zeros((0, len(model.languages) + 1))

    def _learn(self, tokens: list[str]) -> None:
        grams, owner = padded(tokens)
        bits = self.model.log2(grams)
        got = np.zeros((len(tokens), self.table.shape[1]))
        for i in range(bits.shape[1]):
            got[:, i] = np.bincount(owner, weights=bits[:, i], minlength=len(tokens))
        got[:, -1] = np.bincount(owner, minlength=len(tokens))
        start = len(self.memo)
        if start + len(tokens) > len(self.table):
            self.table = np.concatenate((self.table[:start], np.zeros((CACHED // 4 + len(tokens), got.shape[1]))))
        self.table[start:start + len(tokens)] = got
        self.memo.update(zip(tokens, range(start, start + len(tokens))))

    def score(self, texts: list[str | None]) -> list[tuple]:
        """(lang_pred, score, cost, n_letters, accepted) of each text."""
        m = self.model
        if len(self.memo) > self.memo.limit:
            self.memo.clear()
        split = [t.lower().split() if t else [] for t in texts]
        new = [w for w in set().union(*split) if w not in self.memo]
        for i in range(0, len(new), AT_ONCE):
            self._learn(new[i:i + AT_ONCE])
        out = []
        for words in split:
            total = self.table[np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))].sum(axis=0)
            n = int(total[-1])
            if not n:
                out.append((UNKNOWN, 0.0, None, 0, False))
                continue
            cost = -total[:-1] / n
            best = int(cost.argmin())
            odds = np.exp2((cost[best] - cost) * np.sqrt(n))
            out.append((m.languages[best], float(1 / odds.sum()), float(cost[best]), n,
                        m.limits is None or bool(cost[best] <= m.limits[best])))
        return out


def _scored(df: DataFrame, model: Model) -> DataFrame:
    """(id, text) rows to ``id, lang_pred, score, cost, n_letters, accepted``."""
    key = df.schema.fields[0].dataType.simpleString().replace("bigint", "long")
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 2**22 rows per order
    scorers: list[Scorer] = []

    def work(ids, texts):
        if not scorers:
            scorers.append(Scorer(shared.value))
        return ids, *zip(*scorers[0].score(texts), strict=True)

    return map_rows(df, work, f"id {key}, lang_pred string, score double, cost double, n_letters long, accepted boolean")


def accepted(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text the model does not reject, all columns unchanged.

    Null texts and texts without a letter go; without a model every row goes.
    """
    if model is None:
        return df.limit(0)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at, schema = df.columns.index(text_col), df.schema

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield part.filter(pa.array([r[4] for r in scorer.score(part.column(at).to_pylist())], pa.bool_()))
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, cost, n_letters, accepted)``, one row per input row.

    lang_pred is a learned language, or ``und`` (score 0, not accepted) for null
    texts and texts without a letter. score: weight of the language against the
    others, 0 to 1; ties go to the first language in order. cost: bits per
    character, null for ``und``. Without a model every row is ``und``. Repeated
    rows and null ids stay; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if model is None:
        return rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cost"), F.lit(0).cast("long").alias("n_letters"),
                           F.lit(False).alias("accepted"))
    return _scored(rows, model)


def fold_of(id_col: str, folds: int = 4):
    """Fold of a row: CRC-32 of its id as text; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0))
