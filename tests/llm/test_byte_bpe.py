import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from beaconry.llm import byte_bpe as b

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, np.int32).tolist()


def test_whole_table(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    coded = b.encode(docs, PATH, PATTERN)
    for r in coded.collect():
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]])
    for r in b.decode(coded, PATH, PATTERN).collect():
        assert bytes(r["decoded"]) == texts[r["doc_id"]].encode()


def test_odd_rows(odd, none, library):
    with pytest.raises(ValueError, match="ids"):
        b.encode(odd, PATH, PATTERN, keep=("doc_id", "ids"))
    got = b.decode(b.encode(odd, PATH, PATTERN, keep=("doc_id", "text")), PATH, PATTERN).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in got)
    assert b.encode(none, PATH, PATTERN).count() == 0


def test_random_strings(library):
    rng = random.Random(9)
    parts = ["a", "th", "ing", " ", "  ", "\n", "\r\n", "\t", "é", "☃", "日本", "😀", "'s", "'re", "²", "½", "́", "\x85",
             "\xa0", "<|endoftext|>", "1", "=", "​", "　", "\x1c", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["a" * 4000, " " * 500, "", None]
    model = b.coder(PATH, PATTERN)
    for text, packed in zip(texts, model.encode(texts)):
        assert ids(packed) == library.encode_ordinary(text or "")
        assert model.decode(ids(packed)) == (text or "").encode()


def test_split_characters_and_offsets():
    model = b.coder(PATH, PATTERN)
    text = "a😀 é日"
    got = ids(model.encode([text])[0])
    pieces = list(model.stream(got))
    assert "".join(pieces) == text and "" in pieces
    assert "".join(model.stream(got[:2])).endswith("�")
    spans = model.offsets(text)
    assert len(spans) == len(got) and spans[0] == (0, 1) and spans[-1][1] == len(text)


def test_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in b.decode(df, PATH, PATTERN).orderBy("id").collect()] == [b"", b"", b"ab"]


def test_ascii_form_splits_alike():
    rng, model = random.Random(10), b.coder(PATH, PATTERN)
    for _ in range(500):
        text = "".join(chr(rng.randint(0, 127)) for _ in range(rng.randint(0, 60)))
        assert model.ascii.findall(text) == model.pattern.findall(text)
