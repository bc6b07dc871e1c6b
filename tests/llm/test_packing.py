import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from beaconry.llm import packing as p
from beaconry.llm.words import byte_coder, parts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_best_fit(lengths, capacity):
    """Bins of best-fit decreasing, one document at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return rooms


def test_as_many_bins_as_one_by_one():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([1, 7, 30, 64, 100])
        lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randint(0, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs = p.best_fit_decreasing(counts, capacity)
        fill, seen = {}, []
        for n, count in counts.items():
            rank = np.arange(count)
            bins, offset = p.place(runs, np.full(count, n), rank)
            for b, o in zip(bins.tolist(), offset.tolist()):
                fill.setdefault(b, []).append((o, n))
                seen.append(n)
        rooms = plain_best_fit(lengths, capacity)
        assert len(fill) == len(rooms) and sorted(seen) == sorted(lengths)
        left = []
        for items in fill.values():
            end = 0
            for o, n in sorted(items):
                assert o == end
                end += n
            assert end <= capacity
            left.append(capacity - end)
        assert sorted(left) == sorted(rooms)


def test_runs_stay_few():
    rng = random.Random(2)
    counts = {n: rng.randint(1, 10**12) for n in range(1, 1025)}
    assert len(p.best_fit_decreasing(counts, 1024)) < 50_000


def test_lengths_out_of_range():
    for bad in (0, 11):
        with pytest.raises(ValueError, match="capacity"):
            p.best_fit_decreasing({bad: 1}, 10)


def test_random_strings(library):
    rng = random.Random(3)
    bits = ["a", "th", "ing", " ", "  ", "\n", "\r\n", "\t", "é", "☃", "日本", "😀", "'s", "'re", "²", "½", "́", "\x85",
            "\xa0", "<|endoftext|>", "1", "=", "​", "　", "\x1c", "\x00", "᠎", "﻿", "<|endoftext"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 4000, " " * 500, "", None, "word " * 3000]
    for text, packed in zip(texts, p.packed_ids(texts, PATH)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert all("".join(" " + x for x in parts(t))[1:] == t and "" not in parts(t) for t in texts if t)


def test_words_of_the_table(data, library):
    """The faster library gives the ids of the one the file is made for."""
    import pyarrow.parquet as pq

    words = {w for t in pq.read_table(f"{data}/documents.parquet").column("text").to_pylist() if t for w in parts(t)}
    words = sorted(words)
    model = byte_coder(PATH, False)
    assert model.fast and model.encode(words) == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]


def check(docs, library, capacity):
    got = p.pack(docs, PATH, capacity).collect()
    ids_of = {}
    for r in sorted(got, key=lambda r: (repr(r["doc_id"]), r["piece"])):
        assert r["length"] == len(r["ids"]) <= capacity
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        ids_of.setdefault(r["doc_id"], []).append(r)
    for r in docs.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        own = ids_of[r["doc_id"]]
        if len({x["piece"] for x in own}) == len(own):
            assert sum((x["ids"] for x in own), []) == want
            assert [x["start"] for x in own] == np.cumsum([0] + [x["length"] for x in own])[:-1].tolist()
            assert all(x["length"] == capacity for x in own[1:])
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(bins) == len(plain_best_fit([r["length"] for r in got], capacity))
    return got


def test_whole_table(spark, data, library):
    check(spark.read.parquet(f"{data}/documents.parquet"), library, 1024)


def test_odd_rows(odd, none, library):
    got = check(odd, library, 64)
    assert sum(r["doc_id"] is None for r in got) == 2
    assert sum(r["doc_id"] == 1 for r in got) == 2
    assert [r["ids"] for r in got if r["doc_id"] == 2] == [[2]]
    assert p.pack(none, PATH).count() == 0
    assert "ids" not in p.pack(odd, PATH, with_ids=False).columns


def test_pieces_cut_from_the_end():
    assert p.cuts(5, 10) == [5] and p.cuts(10, 10) == [10] and p.cuts(11, 10) == [1, 11] and p.cuts(20, 10) == [10, 20]
