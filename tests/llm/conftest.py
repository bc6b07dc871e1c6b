import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta " * 9000
ROWS = [
    (1, "The cat sat on the mat and the dog ran home again today", "en", "b"),
    (1, "The cat sat on the mat and the dog ran home again today", "en", "b"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (None, "a text that has no id at all but some words", "en", "a"),
    (None, None, None, "a"),
    (4, " \n\t ", "de", "b"),
    (5, LONG, "en", None),
    (6, "12345 67890 !!! ???", "en", "c"),
    (7, "é😀 ﬁ ☃ Straße ▁ x y <|endoftext|> <s>", "fr", "c"),
    (8, "w", "fr", "c"),
    (9, "the CAT sat on the mat and the dog ran home again today", "en", "a"),
]
#: Names that operators use themselves, as further columns of the input.
CLASHES = ("node", "root", "ids", "fp", "key", "a", "b", "size", "shard", "slot", "text_key", "bucket",
           "virtual_slot", "id", "spans", "offset", "label", "word", "tail", "sketch", "_id", "_own", "_text", "_key",
           "_hash", "_turn", "own", "hashed", "turn", "Turn_", "cuts", "first_id", "two words", "copy", "copies")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing column names."""
    rows = [(i, t, lang, source, len(t) if t is not None else None, *range(len(CLASHES)))
            for i, t, lang, source in ROWS]
    names = ", ".join(f"`{c}` int" for c in CLASHES)
    return (spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
            .withColumns({"day": F.lit("2024-02-29").cast("date"), "seen": F.lit("2024-02-29 12:30:00").cast("timestamp"),
                          "cost": F.lit("1.25").cast("decimal(9,2)"), "list": F.array(F.lit(1.5))}).repartition(3))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def docs(spark, texts, **more):
    """A documents table of texts numbered from 0."""
    rows = [(i, t, "en", f"src{i % 3}", len(t) if t is not None else 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


class Union:
    """Plain union-find for brute force."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
