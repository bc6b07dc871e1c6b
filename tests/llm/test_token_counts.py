import random

import public_tokenizers
import pytest
import sentencepiece

from beaconry.llm import token_counts as t

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(library, text):
    return len(library.encode(text)) if text else 0


def test_whole_table(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in t.token_counts(docs, PATH, limit=500).collect():
        text = texts[r["doc_id"]]
        n = expected(library, text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 500)


def test_odd_rows(odd, none, library):
    got = sorted((r["n_bytes"], r["n_tokens"]) for r in t.token_counts(odd, PATH).collect())
    texts = [r["text"] for r in odd.collect()]
    assert got == sorted((len(x.encode()) if x else 0, expected(library, x)) for x in texts)
    assert t.token_counts(none, PATH).count() == 0


def test_random_strings(library):
    rng = random.Random(2)
    parts = ["a", "b", "aa", "th", "ing", " ", "  ", "\n", "\t", "é", "日本", "☃", "▁", "1", "=", "--", "<s>", "😀", "\x01"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 2000, " " * 999, "=" * 1500, "".join(rng.choice("abcde") for _ in range(8000))]
    assert t.count_texts(texts, PATH) == [expected(library, x) for x in texts]


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(t, "_memo", lambda path: memo)
    memo = t.Memo(10)
    for i in range(20):
        t.count_texts([f"word{i} and{i} more{i} here{i}"], PATH)
    assert len(memo) <= 10 + 8
