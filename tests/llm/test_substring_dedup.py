import random
from collections import Counter

import numpy as np
import pytest

from beaconry.llm import substring_dedup as s
from tests.llm.conftest import docs

WHITE = " \t\n\x0b\x0c\r"


def split(text):
    out, word = [], ""
    for c in text or "":
        if c in WHITE:
            out.append(word)
            word = ""
        else:
            word += c
    return [w for w in [*out, word] if w]


def brute(texts, length):
    words = [split(t) for t in texts]
    often = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if often[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def passages(rng, n):
    words = [f"w{i}" for i in range(300)]
    shared = [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    out = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            a = rng.randint(0, 20)
            at = rng.randint(0, len(text))
            text[at:at] = piece[a:a + rng.randint(20, 40)]
        out.append(rng.choice(WHITE).join(text))
    return out + [" ".join(["tick", "tock"] * 60), " ".join(["x"] * 80), None, "", "short"]


@pytest.mark.parametrize("many", [s.MANY, 1])
def test_brute_force(spark, many):
    """many = 1 sends every ambiguous anchor down the path for crowded ones."""
    texts = passages(random.Random(3), 80)
    got = s.remove_repeated(docs(spark, texts).repartition(4), length=35, many=many).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == dict(enumerate(brute(texts, 35)))


def test_odd_rows(odd, none):
    rows = odd.collect()
    want = sorted(zip([r["doc_id"] or -1 for r in rows], brute([r["text"] for r in rows], 10)))
    got = sorted((r["doc_id"] or -1, (r["n_words"], r["n_removed"], r["kept"]))
                 for r in s.remove_repeated(odd, length=10, anchor=4).collect())
    assert got == want
    assert s.remove_repeated(none).count() == 0


def test_automaton_counts_occurrences():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(8)]
    automaton = s.SuffixAutomaton()
    for t in texts:
        automaton.add(t, 2)
    automaton.close()
    for t in [*texts, "abba" * 5]:
        for least in (1, 3, 5):
            want = []
            for end in range(1, len(t) + 1):
                fits = [n for n in range(1, end + 1)
                        if sum(2 * sum(x.startswith(t[end - n:end], i) for i in range(len(x))) for x in texts) >= least]
                want.append(max(fits, default=0))
            assert automaton.matching(t, least) == want


def test_lowest_ahead():
    h = np.random.default_rng(5).integers(0, 6, 50).astype(np.uint64)
    for width in (1, 2, 5, 24):
        want = [i + int(h[i:i + width].argmin()) for i in range(len(h) - width + 1)]
        assert s.lowest_ahead(h, width).tolist() == want


def test_word_hashes_in_pieces(monkeypatch):
    data = ("one two  three\nfour five " * 50).encode()
    whole = s.word_hashes(data)
    monkeypatch.setattr(s, "BYTES", 4)
    assert all((a == b).all() for a, b in zip(whole, s.word_hashes(data)))
