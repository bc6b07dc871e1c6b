"""Sentiment, topics, themes and gates over text columns.

Scoring never joins documents with each other. Word counts of a row come from its
own array; only words of the lexicon go on after the join with it. Per-group counts
are summed in the task that read the text, so a frequent word is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions.text import once, term_array, term_hits, token_set, tokens
from beaconry.operators.ordering import top_per_group
from beaconry.session import shared_root


def learn_polarity(docs: DataFrame, labels: DataFrame, key: str, text: str, negative: str,
                   min_docs: int = 1, lift: int = 2) -> DataFrame:
    """Word polarity (+1 / -1) from labelled documents.

    A word is negative when its document rate among negative documents is more
    than ``lift`` times the rate among the others, positive the other way round.
    Rates are compared as cross products of counts, hence exactly.
    """
    rows = docs.join(labels.select(key, negative), key).select(
        (F.col(negative) == 1).alias("_neg"), F.explode(token_set(F.col(text))).alias("token"))
    counts = rows.groupBy("token").agg(F.count_if("_neg").alias("n"), F.count_if(~F.col("_neg")).alias("p"))
    classes = docs.join(labels.select(key, negative), key).agg(
        F.struct(F.count_if(F.col(negative) == 1).alias("n"), F.count_if(F.col(negative) == 0).alias("p"))).scalar()
    held = counts.filter(F.col("n") + F.col("p") >= min_docs).withColumn("_c", classes)
    against, pro = F.col("n") * F.col("_c.p"), F.col("p") * F.col("_c.n")
    polarity = F.when(against > pro * lift, -1).when(pro > against * lift, 1)
    return held.select("token", polarity.alias("polarity")).filter("polarity IS NOT NULL")


def sentiment_label(pos: Column, neg: Column, words: Column) -> Column:
    """positive, negative, mixed, neutral, or unknown for text without words."""
    low, high = F.least(pos, neg), F.greatest(pos, neg)
    return (F.when(words == 0, "unknown").when(high == 0, "neutral")
            .when((low > 0) & (low * 2 >= high), "mixed")
            .when(pos > neg, "positive").otherwise("negative"))


def word_polarity_counts(texts: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Words, positive and negative hits per key; a word counts once per text row."""
    rows = once(texts.select(*keys, text), "_w", token_set(F.col(text)))
    words = rows.groupBy(*keys).agg(F.coalesce(F.sum(F.greatest(F.size("_w"), F.lit(0))), F.lit(0)).alias("words"))
    hits = (rows.select(*keys, F.explode("_w").alias("token")).join(lexicon, "token").groupBy(*keys).agg(
        F.count_if(F.col("polarity") == 1).alias("pos"), F.count_if(F.col("polarity") == -1).alias("neg")))
    zero = F.lit(0).cast("long")
    return words.join(hits, keys, "left").select(
        *keys, "words", F.coalesce("pos", zero).alias("pos"), F.coalesce("neg", zero).alias("neg"))


def overall_sentiment(texts: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    counts = word_polarity_counts(texts, keys, text, lexicon)
    return counts.withColumn("sentiment", sentiment_label(F.col("pos"), F.col("neg"), F.col("words")))


def aspect_sentiment(texts: DataFrame, key: str, text: str, aspects: dict[str, list[str]],
                     lexicon: DataFrame) -> DataFrame:
    """Sentiment per aspect from the sentences that mention it; else unknown."""
    sentences = texts.select(key, F.explode(F.split(F.col(text), r"[.\n]+")).alias("_s"))
    words = once(sentences, "_w", token_set(F.col("_s")))
    about = F.array(*[F.struct(
        F.lit(a).alias("aspect"), F.when(F.arrays_overlap("_w", term_array(terms)), F.col("_w")).alias("found"))
        for a, terms in aspects.items()])
    rows = words.select(key, F.inline(about))
    zero = F.lit(0).cast("long")
    counted = rows.select(key, "aspect", F.greatest(F.coalesce(F.size("found"), F.lit(0)), F.lit(0)).cast("long").alias("words"),
                          zero.alias("pos"), zero.alias("neg"))
    # Only words of mentioning sentences meet the lexicon; rows without any keep their zeros.
    hits = (rows.select(key, "aspect", F.explode("found").alias("token")).join(lexicon, "token")
            .select(key, "aspect", zero.alias("words"), (F.col("polarity") == 1).cast("long").alias("pos"),
                    (F.col("polarity") == -1).cast("long").alias("neg")))
    return (counted.unionByName(hits).groupBy(key, "aspect").agg(
        F.sum("words").alias("words"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn("sentiment", sentiment_label(F.col("pos"), F.col("neg"), F.col("words"))))


def topic_scores(text: Column, topics: dict[str, list[str]]) -> dict[str, Column]:
    """Number of a topic's seed terms that occur in the text."""
    words = tokens(text)
    return {name: term_hits(words, seeds) for name, seeds in topics.items()}


def labels_above(scores: dict[str, Column], threshold: int) -> Column:
    """All labels whose score reaches the threshold, in declared order."""
    pairs = F.array(*[F.struct(F.lit(n).alias("label"), s.alias("score")) for n, s in scores.items()])
    return F.transform(F.filter(pairs, lambda p: p["score"] >= threshold), lambda p: p["label"])


def theme_weights(texts: DataFrame, group: str | None, text: str, min_chars: int = 1) -> DataFrame:
    """tf · ln(N / df) of every word, per group or for the whole corpus (None).

    The text is split and exploded once: sorted, a word's first place in a row counts the
    row, each place its use. Counts are summed together before the shuffle; per group
    they are checkpointed, as the groups' and the whole corpus's numbers both need them.
    """
    keys = [group] if group else []
    rows = once(texts.select(*keys, text), "_w", F.sort_array(tokens(F.col(text))))
    used = rows.select(*keys, "_w", F.posexplode("_w").alias("_at", "token")).filter(F.char_length("token") >= min_chars)
    first = (F.col("_at") == 0) | (F.col("token") != F.get("_w", F.greatest(F.col("_at") - 1, F.lit(0))))
    per = (used.select(*keys, "token", first.cast("int").alias("_first")).groupBy(*keys, "token")
           .agg(F.count("*").alias("tf"), F.sum("_first").alias("df")))
    if group:
        shared_root(texts.sparkSession)
        per = per.checkpoint()
    size = texts.agg(F.count("*")).scalar()
    if group:
        whole = per.groupBy("token").agg(F.sum("df").alias("_df"))
        per = per.join(whole, "token").drop("df").withColumnRenamed("_df", "df")
    return per.withColumn("_n", size).select(
        *keys, "token", "tf", "df", F.round(F.col("tf") * F.log(F.col("_n") / F.col("df")), 4).alias("weight"))


def group_themes(texts: DataFrame, group: str, text: str, k: int, min_chars: int = 1) -> DataFrame:
    """Top ``k`` words per group by weight; one row per (group, word)."""
    return top_per_group(theme_weights(texts, group, text, min_chars), [group], [F.desc("weight"), F.col("token")], k)


def extractive_summary(texts: DataFrame, key: str, text: str, sentences: int, min_words: int = 1) -> DataFrame:
    """The sentences that carry most weight per word, over all words of the corpus."""
    weights = theme_weights(texts, None, text).select("token", F.col("weight").alias("_w"))
    parts = texts.select(key, F.posexplode(F.split(F.col(text), r"[.\n]+")).alias("sentence_no", "sentence"))
    rows = once(parts, "_words", tokens(F.col("sentence"))).filter(F.size("_words") >= min_words)
    scored = (rows.select(key, "sentence_no", F.size("_words").alias("_n"),
                          F.explode(F.array_distinct("_words")).alias("token"))
              .join(weights, "token")
              .groupBy(key, "sentence_no").agg(F.round(F.sum("_w") / F.min("_n"), 2).alias("weight")))
    best = scored.orderBy(F.desc("weight"), key, "sentence_no").limit(sentences)
    # The few sentences that stay fetch their text at the end.
    return (parts.join(best, [key, "sentence_no"]).select(key, "sentence_no", "sentence", "weight")
            .orderBy(F.desc("weight"), key, "sentence_no"))


def gate_volume(texts: DataFrame, sample: DataFrame, flagged: Column) -> DataFrame:
    """Analyse-all against targeted volume: flagged share of a sample, projected."""
    share = sample.agg(F.struct(F.count("*").alias("scanned"), F.count_if(flagged).alias("flagged"))).scalar()
    whole = texts.agg(F.count("*").alias("scanned")).withColumn("_s", share)
    treated = F.round(F.col("scanned") * F.try_divide(F.col("_s.flagged"), F.col("_s.scanned"))).cast("long")
    both = F.array(
        F.struct(F.lit("analyze_all").alias("approach"), F.col("scanned").alias("treated")),
        F.struct(F.lit("targeted_filter").alias("approach"), F.coalesce(treated, F.lit(0)).alias("treated")))
    return whole.select("scanned", F.inline(both))


def cascade(rows: DataFrame, cheap: Column, strong: Column, threshold: float = 0.4) -> DataFrame:
    """Score with the cheap model; where it is unsure, use the strong one and log the route.

    The strong score is only evaluated for escalated rows.
    """
    first = rows.withColumn("_cheap", cheap)
    unsure = F.abs(F.col("_cheap") - 0.5) * 2 < threshold
    routed = first.withColumn("escalated", unsure).withColumn(
        "intent_score", F.when(F.col("escalated"), strong).otherwise(F.col("_cheap")))
    return routed.withColumns({
        "confidence": F.abs(F.col("intent_score") - 0.5) * 2,
        "model_used": F.when(F.col("escalated"), "strong").otherwise("cheap")}).drop("_cheap")


def write_back(rows: DataFrame, scored: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with ``column`` replaced where a new value was scored."""
    new = scored.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def pareto_frontier(candidates: DataFrame, cost: str, quality: str, most: int = 100_000) -> DataFrame:
    """Candidates not beaten by a cheaper or equally cheap one.

    One sorted window holds the list, one row per model; a list of more than
    ``most`` rows is an error.
    """
    if candidates.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} candidates")
    before = W.orderBy(cost, F.desc(quality)).rowsBetween(W.unboundedPreceding, -1)
    best = F.max(quality).over(before)
    return candidates.withColumn("on_frontier", best.isNull() | (F.col(quality) > best))
