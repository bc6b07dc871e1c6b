"""Tokens, term hits, field extraction and markup removal, all JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    The optimizer copies an expression into every place that uses it; it does
    not copy the output of a generator, so the value goes through a one-element one.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def term_array(terms: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms])


def term_hits(words: Column, terms: list[str]) -> Column:
    """How many of the terms occur in the token array."""
    return F.size(F.array_intersect(words, term_array(terms)))


def best_label(scores: dict[str, Column], default: str) -> Column:
    """Label of the highest score; the first wins a tie, none above 0 → default."""
    top = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    choice = reduce(lambda acc, s: F.when(s[1] == top, s[0]).otherwise(acc),
                    reversed(list(scores.items())), F.lit(default))
    return F.when(top > 0, choice).otherwise(default)


# Patterns of the extractable fields.
FIELD_PATTERNS = {
    "email": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})",
    "ip_address": r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})",
    "license": r"((?:Licensed|Released|licensed) under the [A-Za-z ]+License)",
    "phone": r"(\+[0-9]+ \([0-9]{3}\) [0-9]{3}-[0-9]{4})",
}


def extract_fields(text: Column, patterns: dict[str, str] = FIELD_PATTERNS) -> Column:
    """Struct with the first match per field, NULL where there is none."""
    return F.struct(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n)
                      for n, p in patterns.items()])


# Markup passes in order (pattern, replacement).
HTML_PASSES = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?s)<script.*?</script>", ""),
    (r"(?s)<style.*?</style>", ""),
    (r"(?s)<head.*?</head>", ""),
    (r"<h1[^>]*>", "\n# "),
    (r"<h2[^>]*>", "\n## "),
    (r"</?(?:p|br|li|ul|div|tr|h1|h2|article|nav)[^>]*>", "\n"),
    (r"<[^>]+>", ""),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", "\""),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^\n|\n$", ""),
]


def html_to_text(html: Column) -> Column:
    """Visible text with headings and line breaks kept."""
    return reduce(lambda c, p: F.regexp_replace(c, p[0], p[1]), HTML_PASSES, html)
