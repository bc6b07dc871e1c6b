import random

import public_tokenizers
import pytest

import corpus_pipeline as p
from beaconry.llm import byte_bpe, secrets


def english(rng, n):
    parts = ["th", "er", "on", "an", "re", "ed", "in", "is", "at", "or", "st", "nd", "en"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(15)
    texts = [english(rng, 200) for _ in range(60)]
    changed = texts[5].split()
    changed[100] = "other"
    texts += [texts[3], " ".join(changed), texts[7], None, "", "12345 !!"]
    texts += ["".join(rng.choice("bcdfgjkqvwxz") for _ in range(500))]
    texts[10] += " password=b7db7aa4a5fcc78305 end"
    rows = [(i, t, "en" if t != texts[-1] else None, f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, table, tmp_path):
    assert [n for n, _ in p.STAGES] == ["language_id", "simhash_near_dedup", "secret_scan", "mixing", "byte_bpe"]
    docs, seen = table, {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "byte_bpe":
            assert out.columns == table.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {}
        for r in docs.collect():
            seen[name].setdefault(r["doc_id"], []).append(r)
    assert sorted(seen["language_id"]) == list(range(63))  # null, empty, no letter and noise go
    assert sorted(seen["simhash_near_dedup"]) == list(range(60))  # copies of 3, 5 and 7 go
    texts = {i: rows[0]["text"] for i, rows in seen["secret_scan"].items()}
    assert texts[10].endswith(f"{secrets.MARK} end") and not any(secrets.base_spans(t) for t in texts.values())
    assert all(rows[0]["n_chars"] == len(rows[0]["text"]) for rows in seen["secret_scan"].values())
    # Weights 3, 1, 2 of 1.5 times the words: the first source meets its limit of two laps.
    words = {i: len(t.split()) for i, t in texts.items()}
    mixed = {i: sum(len(r["text"].split()) for r in rows) for i, rows in seen["mixing"].items()}
    assert all(mixed[i] == 2 * words[i] for i in words if i % 3 == 0)
    assert all(n <= 2 * words[i] for i, n in mixed.items())
    assert abs(sum(mixed.values()) - 1.5 * sum(words.values())) <= 3
    model = byte_bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    whole = sorted(t["text"] for rows in seen["mixing"].values() for t in rows)
    coded = [r for rows in seen["byte_bpe"].values() for r in rows]
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in coded)
    assert sorted(model.decode(r["token_ids"]).decode() for r in coded) == whole


def test_odd_columns_pass_every_stage(spark, odd, none, tmp_path):
    """Columns of other types and of names that stages use themselves come through unchanged."""
    docs, more = odd, [c for c in odd.columns if c not in ("doc_id", "text", "n_chars")]
    want = {r["doc_id"]: tuple(r[c] for c in more) for r in odd.collect() if r["text"]}
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == odd.dtypes
        assert stage(spark, none, "").count() == 0
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        skip = more.index("source"), more.index("lang")
        assert rows and all([v for i, v in enumerate(tuple(r[c] for c in more)) if i not in skip]
                            == [v for i, v in enumerate(want[r["doc_id"]]) if i not in skip] for r in rows)
    assert p.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_run_and_empty(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "documents.parquet"))
    rows = p.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} <= set(range(60)) and len(rows) >= 60
    table.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert p.run(spark, str(tmp_path / "none")).count() == 0
