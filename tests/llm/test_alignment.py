import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import rows
from tokenizers import Tokenizer

from beaconry.llm import alignment as al
from beaconry.llm.byte_bpe import byte_table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Alignment of one text, byte by byte: ids, groups and links."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    back = {c: i for i, c in enumerate(byte_table())}

    def of(text):
        if not text:
            return [], [], [], []
        left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            return [], [], [], []
        owner = [[k for k, (_, x) in enumerate(side) for _ in x] for side in (left, right)]
        links = sorted(set(zip(*owner)))
        groups, ga, gb, n = [], [], [], len(whole)
        for k in range(n):
            if not k or owner[0][k] != owner[0][k - 1]:
                ga.append(left[owner[0][k]][0])
            if not k or owner[1][k] != owner[1][k - 1]:
                gb.append(right[owner[1][k]][0])
            if k + 1 == n or owner[0][k + 1] != owner[0][k] and owner[1][k + 1] != owner[1][k]:
                groups.append((ga, gb))
                ga, gb = [], []
        return [i for i, _ in left], [i for i, _ in right], groups, links

    return of


def expected(texts, plain):
    """``align_corpus`` by plain lists and counters."""
    coded = [plain(t) for t in texts]
    pairs = [[(a[i], b[j]) for i, j in links] for a, b, _, links in coded]
    count = Counter(p for row in pairs for p in set(row))
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (a, b, groups, links), row in zip(coded, pairs):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
                    sum(count[p] == most[p[0]] for p in row), sum(count[p] for p in row),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.fixture(params=[1 << 16, 1 << 6, 0], ids=["broadcast", "both", "joined"])
def hot(request, monkeypatch):
    monkeypatch.setattr(al, "HOT", request.param)


def test_whole_table(spark, data, plain, hot):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40)
    got = docs.collect()
    want = sorted((r["doc_id"], *x) for r, x in zip(got, expected([r["text"] for r in got], plain)))
    assert sorted(map(tuple, al.align_corpus(spark.createDataFrame(got, docs.schema), A, B).collect())) == want


def test_odd_rows(odd, none, plain, hot):
    got = odd.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *x) for r, x in zip(got, expected([r["text"] for r in got], plain))), key=repr)
    assert rows(al.align_corpus(odd, A, B)) == want
    assert al.align_corpus(none, A, B).count() == 0


def test_random_strings(plain):
    rng = random.Random(4)
    bits = ["a", "th", "ing", " ", "  ", "\n", "\t", "é", "☃", "日本", "😀", "'s", "²", "́", "\x85", "\xa0", "<|endoftext|>",
            "<s>", "<unk>", "<0x41>", "1", "=", "​", "　", "\x1c", "\x00", "᠎", "﻿", "▁"]
    texts = ["".join(rng.choice(bits[:-1] if rng.random() < 0.9 else bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 3000, " " * 300, "", None, "word " * 3000]
    model = al.aligner(A, B)
    for text, got in zip(texts, model.align(texts)):
        a, b, groups, links = plain(text)
        if got is None:
            assert not a
            continue
        pairs, times, string, *numbers = got
        assert string == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert numbers == [len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups)]
        want = Counter(a[i] << al.B_BITS | b[j] for i, j in links)
        assert dict(zip(pairs.tolist(), times.tolist())) == want


def test_links_and_groups(spark, plain):
    texts = ["over the hills", "é😀 <s> 日本", "", None, "a▁b"]
    got = al.alignments(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), A, B)
    for r in got.collect():
        a, b, groups, links = plain(texts[r["doc_id"]])
        assert (r["a_ids"], r["b_ids"]) == (a, b) and list(zip(r["link_a"], r["link_b"])) == links
        assert sum(r["link_bytes"]) == (len((" " + texts[r["doc_id"]]).encode()) if a else 0)
        assert r["a_groups"] == [g for g, (x, _) in enumerate(groups) for _ in x]
        assert r["b_groups"] == [g for g, (_, y) in enumerate(groups) for _ in y]


def test_products_are_those_of_dense_matrices(monkeypatch):
    rng = np.random.default_rng(5)
    for block in (1 << 20, 7):
        monkeypatch.setattr(al, "BLOCK", block)
        for _ in range(50):
            x, y = (rng.random((rng.integers(1, 9), 6)) < 0.4).astype(int), (rng.random((6, rng.integers(1, 9))) < 0.4).astype(int)
            x, y = (np.ascontiguousarray(m) for m in (x, y))
            a, b = (al.Csr(np.concatenate(([0], np.cumsum(m.sum(1)))), np.nonzero(m)[1], m.shape[1]) for m in (x, y))
            out = np.zeros((x.shape[0], y.shape[1]), int)
            for i, j, v in al.gustavson(a, b):
                out[i, j] = v
            assert (out == x @ y).all()
            t = b.transposed()
            dense = np.zeros((t.rows, t.columns), int)
            dense[np.repeat(np.arange(t.rows), np.diff(t.indptr)), t.indices] = 1
            assert (dense == y.T).all()


def test_group_links(plain):
    model = al.aligner(A, B)
    coded = [c for c in model.tokens(["thston ondreae", "é😀x日本 whhawly"]) if c]
    x = model.blocks(coded)
    links = {(i, j) for a, b, _ in x.group_links() for i, j in zip(a.tolist(), b.tolist())}
    assert links == {(i, j) for i in range(len(x.a_ids)) for j in range(len(x.b_ids)) if x.a_group[i] == x.b_group[j]}
    assert len(links) == x.group_link_counts().sum()
