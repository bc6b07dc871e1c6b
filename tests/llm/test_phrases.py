import hashlib

from beaconry.llm import phrases as p
from tests.llm.conftest import docs


def phrase_set(text):
    seen, word = set(), ""
    for c in text:
        word += c
        if word not in seen:
            seen.add(word)
            word = ""
    return seen


def check(df):
    """Against plain parsing of every text, its edit and its successor."""
    rows = sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True)
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + other[:k]
        a, b, c = p.fingerprint(text), p.fingerprint(edited), p.fingerprint(other)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), p.text_form(a), p.text_form(b),
                     p.likeness(a, b), p.likeness(a, c)))
    for partitions in (1, 3):
        got = [tuple(r) for r in p.fingerprints(df, partitions=partitions).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_small_tables(spark, odd, none):
    check(odd)
    check(docs(spark, ["only one text here"]))
    check(docs(spark, [f"text {i} " * (i % 9) for i in range(40)]))
    assert p.fingerprints(none).count() == 0


def test_whole_table(spark, data):
    check(spark.read.parquet(f"{data}/documents.parquet"))


def test_hashes_name_phrases(monkeypatch):
    text = "abracadabra, the abbot said; " * 40
    ends, _ = p.parse(text, 0, set())
    whole = p.phrase_hashes(text, ends)
    assert len(set(whole.tolist())) == len(phrase_set(text)) == len(ends)
    monkeypatch.setattr(p, "CHUNK", 7)
    assert (p.phrase_hashes(text, ends) == whole).all()


def test_likeness():
    a, b = "the cat sat", "the cat ran"
    x, y = phrase_set(a), phrase_set(b)
    assert p.likeness(p.fingerprint(a), p.fingerprint(b)) == len(x & y) / len(x | y)
    assert p.likeness(p.fingerprint(""), p.fingerprint(None)) == 1
    assert p.likeness(p.fingerprint(""), p.fingerprint("x")) == 0
    assert p.likeness(p.fingerprint(a * 99), p.fingerprint(a * 99)) == 1
