"""Keyword, vector and hybrid retrieval with attribute filters.

A query is a handful of terms and one vector, so a search is a scan: words
of the query are counted in the row that holds them, only sums and the top k of
each task travel. A stored index
turns the scan into reading the postings of the query terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.text import once, tokens
from beaconry.operators.bitmaps import restrict
from beaconry.session import scratch_path
from beaconry.sources.tables import replace_table

K1, B = 1.2, 0.75  # usual BM25 constants
RRF = 60           # usual rank-fusion constant


def query_terms(query: str) -> list[str]:
    """Distinct lower-case words of a query, in order."""
    words = "".join(c if c.isalpha() else " " for c in query.lower()).split()
    return list(dict.fromkeys(words))


def _idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def _saturated(tf: Column, length: Column, mean: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def matches(frame: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Equality filters on attributes, applied before anything is ranked."""
    for column, value in filters.items():
        frame = frame.filter(F.col(column) == value)
    return frame


def term_counts(docs: DataFrame, key: str, text: str, terms: list[str], carry: list[str]) -> DataFrame:
    """One row per document: length and the count of every query term, in the row itself."""
    def times(term: str) -> Column:
        return F.size(F.filter("_m", lambda w: w == term))

    words = once(docs.select(key, text, *carry), "_w", tokens(F.col(text)))
    # The words of the query are few: one pass over all words, the counts over these.
    found = once(words.select(key, *carry, F.greatest(F.size("_w"), F.lit(0)).alias("_len"), "_w"), "_m",
                 F.filter("_w", lambda w: w.isin(terms)))
    return found.select(key, *carry, "_len", *[times(q).alias(f"_tf{i}") for i, q in enumerate(terms)])


def scored_counts(counts: DataFrame, key: str, terms: list[str], carry: list[str], filters: dict[str, str]) -> DataFrame:
    """BM25 of the rows of ``term_counts`` that hold a query term."""
    stats = counts.agg(F.struct(
        F.count("*").alias("n"), F.avg("_len").alias("mean"),
        *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])).scalar()
    hit = F.greatest(F.lit(0), *[F.col(f"_tf{i}") for i in range(len(terms))]) > 0
    held = matches(counts, filters).filter(hit).withColumn("_s", stats)
    score = F.lit(0.0)
    for i in range(len(terms)):
        part = _saturated(F.col(f"_tf{i}"), F.col("_len"), F.col("_s.mean"))
        score = score + _idf(F.col("_s.n"), F.col(f"_s.df{i}")) * part
    return held.select(key, *carry, score.alias("keyword_score"))


def bm25_scores(docs: DataFrame, key: str, text: str, query: str, columns: list[str] = (),
                filters: dict[str, str] | None = None) -> DataFrame:
    """Documents with a positive BM25 score in ``keyword_score``.

    Statistics come from the whole corpus, filters only limit the candidates.
    No row is shuffled; the statistics are one row.
    """
    terms = query_terms(query)
    carry = list(dict.fromkeys([*columns, *(filters or {})]))
    return scored_counts(term_counts(docs, key, text, terms, carry), key, terms, carry, filters or {})


def keyword_search(docs: DataFrame, key: str, text: str, query: str, k: int, columns: list[str],
                   filters: dict[str, str] | None = None, digits: int = 6) -> DataFrame:
    """Top ``k`` by BM25. The texts are read once: their counts are stored with the carried
    columns; a carried text is fetched for the hits alone."""
    terms, filters = query_terms(query), filters or {}
    carry = [c for c in dict.fromkeys([*columns, *filters]) if c != text]
    counts = replace_table(term_counts(docs, key, text, terms, carry), scratch_path(docs.sparkSession, "term-counts"))
    hits = scored_counts(counts, key, terms, carry, filters).select(
        key, *carry, F.round("keyword_score", digits).alias("keyword_score"))
    best = hits.orderBy(F.desc("keyword_score"), key).limit(k)
    if text in columns:
        best = docs.select(key, text).join(F.broadcast(best), key).orderBy(F.desc("keyword_score"), key)
    return best.select(key, *columns, "keyword_score")


def build_index(docs: DataFrame, key: str, text: str, by_term: bool = False) -> DataFrame:
    """Inverted index: term, document, term frequency, document length.

    Words are counted in the row that holds them: the sorted words change where a run
    starts, so what is shuffled, once, is one row per document and distinct word.
    ``by_term`` deals the postings out by term alone, for a store clustered by term.
    """
    rows = once(docs.select(key, text), "_w", F.sort_array(tokens(F.col(text)))).filter(F.size("_w") > 0)
    changed = F.filter(F.sequence(F.lit(0), F.size("_w") - 1),
                       lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", F.greatest(i - 1, F.lit(0)))))
    runs = once(rows.select(key, "_w"), "_starts", changed).select(
        key, "_w", "_starts", F.size("_w").alias("doc_len"), F.posexplode("_starts").alias("_run", "_start"))
    ends = F.coalesce(F.get("_starts", F.col("_run") + 1), F.col("doc_len"))
    counts = runs.select(F.get("_w", F.col("_start")).alias("term"), key, "doc_len", (ends - F.col("_start")).alias("_tf"))
    counts = counts.repartition("term") if by_term else counts
    return counts.groupBy("term", key, "doc_len").agg(F.sum("_tf").cast("int").alias("tf"))


def lengths(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Words of every document, as ``corpus_size`` counts them."""
    return docs.select(key, F.size(tokens(F.col(text))).alias("doc_len"))


def corpus_size(docs: DataFrame, text: str) -> DataFrame:
    return docs.agg(F.count("*").alias("n"), F.avg(F.size(tokens(F.col(text)))).alias("mean"))


def search_index(index: DataFrame, size: DataFrame, key: str, query: str, k: int, digits: int = 6,
                 allowed: DataFrame | None = None) -> DataFrame:
    """BM25 from stored postings; only the rows of the query terms are read.

    ``allowed`` is a bitmap of keys (``bitmaps.matching``): other postings go before
    anything is ranked, while the statistics stay those of the whole corpus.
    """
    held = index.filter(F.col("term").isin(query_terms(query)))
    df = held.groupBy("term").agg(F.count("*").alias("df"))
    stats = size.agg(F.struct(F.sum("n").alias("n"), F.max("mean").alias("mean"))).scalar()
    # One row per query term: its size is the length of the query.
    found = held if allowed is None else restrict(held, key, allowed)
    scored = found.join(F.broadcast(df), "term").withColumn("_s", stats).select(
        key, (_idf(F.col("_s.n"), F.col("df"))
              * _saturated(F.col("tf"), F.col("doc_len"), F.col("_s.mean"))).alias("_x"))
    return (scored.groupBy(key).agg(F.round(F.sum("_x"), digits).alias("keyword_score"))
            .orderBy(F.desc("keyword_score"), key).limit(k))


def _total(x: Column, y: Column) -> Column:
    pairs = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)


def vector_of(vectors: DataFrame, key: str, vector: str, value: int) -> Column:
    """One stored vector, scaled to length 1, as a one-value subquery."""
    one = vectors.filter(F.col(key) == value).limit(1)
    length = F.sqrt(_total(F.col(vector), F.col(vector)))
    return one.select(F.transform(vector, lambda v: F.try_divide(v.cast("double"), length))).scalar()


def vector_scores(vectors: DataFrame, vector: str, query_vector: Column) -> DataFrame:
    """Cosine with a query vector of length 1, in double precision."""
    held, v = vectors.withColumn("_q", query_vector), F.col(vector)
    return once(held, "vector_score", F.try_divide(_total(v, F.col("_q")), F.sqrt(_total(v, v)))).drop("_q")


def vector_search(vectors: DataFrame, key: str, vector: str, query_vector: Column, k: int,
                  columns: list[str] = (), digits: int = 6) -> DataFrame:
    scored = vector_scores(vectors, vector, query_vector).select(
        key, *columns, F.round("vector_score", digits).alias("vector_score"))
    return scored.orderBy(F.desc("vector_score"), key).limit(k)


def hybrid_search(docs: DataFrame, vectors: DataFrame, key: str, text: str, vector: str, query: str,
                  query_vector: Column, k: int, columns: list[str],
                  filters: dict[str, str] | None = None) -> DataFrame:
    """Reciprocal-rank fusion of the complete keyword and vector rankings.

    A document counts in each ranking it occurs in: one without a vector is found
    by its words, one without a query word by its vector. Filters limit both
    rankings before they are numbered. The texts are read once; what the rankings
    need (a key and a number) is stored. See ``fused_top`` for the way to the top k.
    """
    spark, terms, filters = docs.sparkSession, query_terms(query), filters or {}
    counts = replace_table(term_counts(docs, key, text, terms, list(filters)), scratch_path(spark, "term-counts"))
    words = scored_counts(counts, key, terms, [], filters).select(key, F.round("keyword_score", 6).alias("_s"))
    held = matches(counts, filters).select(key)
    near = vector_scores(vectors.select(key, vector).join(held, key), vector, query_vector).select(
        key, F.round("vector_score", 6).alias("_s"))
    best = fused_top({"keyword_rank": words, "vector_rank": near}, key, k)
    # The k hits fetch their columns at the end, so texts are never sorted.
    return docs.select(key, *columns).join(F.broadcast(best), key).orderBy(F.desc("score"), key)


def fused_top(rankings: dict[str, DataFrame], key: str, k: int) -> DataFrame:
    """``(key, <a rank per ranking>, score)``: the top ``k`` by summed reciprocal ranks.

    ``rankings`` hold ``(key, _s)``, best is the largest ``_s``, then the smallest key.
    Threshold algorithm: the first ``depth`` of every ranking bound the score of all
    others, since a rank that is not seen is beyond ``depth``. The depth grows until the
    k-th best sure score exceeds what any unseen document can reach. Only then are
    the missing ranks of the few documents that may still be among the best
    counted, by one aggregate per ranking. Nothing is sorted but each task's first rows.
    """
    spark = next(iter(rankings.values())).sparkSession
    least = F.lit(float("-inf"))
    stored = {n: replace_table(r.select(key, F.coalesce("_s", least).alias("_s")), scratch_path(spark, n))
              for n, r in rankings.items()}
    depth = max(64, 4 * k)
    while True:
        tops = {n: [tuple(r) for r in df.orderBy(F.desc("_s"), key).limit(depth).collect()] for n, df in stored.items()}
        # A ranking that ends before the depth has no rank for others at all.
        beyond = {n: 1 / (RRF + depth + 1) if len(top) == depth else 0.0 for n, top in tops.items()}
        ranks = {n: {r[0]: i for i, r in enumerate(top, 1)} for n, top in tops.items()}
        seen = set().union(*ranks.values())
        sure = {d: sum(1 / (RRF + r[d]) for r in ranks.values() if d in r) for d in seen}
        most = {d: sure[d] + sum(beyond[n] for n, r in ranks.items() if d not in r) for d in seen}
        floor = sorted(sure.values(), reverse=True)[k - 1] if len(sure) >= k else 0.0
        if sum(beyond.values()) < floor - 1e-8 or not any(beyond.values()):  # scores are rounded to 8 digits
            break
        depth *= 4
    few = [d for d in seen if most[d] >= floor - 1e-8 and d is not None]
    for n, df in stored.items():
        lost = [d for d in few if d not in ranks[n]] if beyond[n] else []
        if lost:
            ranks[n] |= _ranks_of(df, key, lost)
    rows = [(d, *(ranks[n].get(d) for n in stored)) for d in few]
    kind = next(iter(stored.values())).schema[0].dataType.simpleString()
    known = spark.createDataFrame(rows, f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in stored))
    score = sum(F.coalesce(1 / (RRF + F.col(n)), F.lit(0.0)) for n in stored)
    return known.withColumn("score", F.round(score, 8)).orderBy(F.desc("score"), key).limit(k)


def _ranks_of(ranking: DataFrame, key: str, wanted: list) -> dict:
    """Rank of each wanted document that the ranking holds: one more than the rows before it."""
    score = {r[0]: r[1] for r in ranking.filter(F.col(key).isin(wanted)).groupBy(key).agg(F.max("_s")).collect()}
    if not score:
        return {}
    before = [F.count_if((F.col("_s") > s) | (F.col("_s") == s) & (F.col(key).isNull() | (F.col(key) < d)))
              for d, s in score.items()]
    return {d: n + 1 for d, n in zip(score, ranking.agg(*[b.alias(f"n{i}") for i, b in enumerate(before)]).first())}


def cited_context(hits: DataFrame, label: str, key: str, text: str, order: list[str]) -> DataFrame:
    """Hits as one context cell: ``label [key]: text`` blocks in rank order."""
    block = F.concat(F.col(label), F.lit(" ["), F.col(key).cast("string"), F.lit("]: "), F.col(text))
    items = F.array_sort(F.collect_list(F.struct(*order, block.alias("block"))))
    return hits.agg(F.array_join(F.transform(items, lambda x: x["block"]), "\n---\n").alias("context"))
