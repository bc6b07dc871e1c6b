import hashlib
import itertools
import random
import re
import zlib

import pytest
import xxhash
from conftest import rows

from beaconry.llm import conversation_repair as c

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def test_parser_accepts_the_language():
    model = c.repairer()
    for n in range(7):
        for word in map("".join, itertools.product("sua", repeat=n)):
            node = 0
            for x in word:
                node = model.moves[node].get(x) if node is not None else None
            assert (node is not None and model.final[node] == 0) == bool(GOOD.match(word))


def plain_edits(rows):
    """Cheapest ``(cost, audit, lines)`` of ``(role, text, gone, truncated)``: all edits over all prefixes of
    sound role strings, by a table of (row, output length, system first)."""
    n = len(rows)
    best = {}

    def offer(key, cost, audit, lines):
        if key not in best or (cost, audit) < best[key][:2]:
            best[key] = (cost, audit, lines)

    for system in (False, True):
        size = 2 * n + 4
        want = ("s" if system else "") + "ua" * size
        best.clear()
        best[0, 0] = (0, "", [])
        for i in range(n + 1):
            for k in range(size):
                if (i, k) not in best:
                    continue
                cost, audit, lines = best[i, k]
                if want[k] != "s":
                    offer((i, k + 1), cost + 3, audit + "I", [*lines, {"u": "user", "a": "assistant"}[want[k]] + ":"])
                if i == n:
                    continue
                role, text, gone, cut = rows[i]
                offer((i + 1, k), cost + 4, audit + "D", lines)
                if not gone:
                    if role[:1] == want[k]:
                        offer((i + 1, k + 1), cost + 3 * cut, audit + "K", [*lines, f"{role}:{text}"])
                    if want[k] != "s":
                        offer((i + 1, k + 1), cost + 3 + 3 * cut, audit + "R",
                              [*lines, {"u": "user", "a": "assistant"}[want[k]] + ":" + text])
        for k in range(size):
            if (n, k) in best and GOOD.match(want[:k]):
                yield best[n, k]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain(table):
    """The whole contract by lists: damage, faults, repair."""
    out = {}
    for conv, turn, role, text in table:
        rows_ = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows_ += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    result = []
    for conv, rows_ in out.items():
        def mark(r):
            return signed(xxhash.xxh64(r[2].encode(), seed=xxhash.xxh64(r[1].encode(), seed=42).intdigest()).intdigest())

        rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, mark(r), r[1], r[2]))
        faults, seen, marked = {"b": 0, "d": 0, "t": 0}, set(), []
        for _, role, text in rows_:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            if fault:
                faults[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault in ("b", "d"), fault == "t"))
        turns = {r[0] for r in rows_} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows_))
        cost, audit, lines = min(plain_edits(marked), key=lambda x: x[:2])
        result.append((conv, gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=repr)


def repaired(spark, table):
    return rows(c.repair(c.damage(spark.createDataFrame(table, SCHEMA))))


def random_table(rng, convs, longest):
    texts = ["Yes.", "No", "Fine!", "", " \t", "Why?", "a. ", "x", None, "é.", "two\nlines."]
    table = []
    for conv in convs:
        for turn in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.05 else turn + (rng.random() < 0.1)
            table.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                          rng.choice(texts) if rng.random() < 0.4 else f"w{rng.randint(0, 40)}."))
    rng.shuffle(table)
    return table


def test_edits_are_the_cheapest():
    rng, model = random.Random(1), c.repairer()
    for _ in range(500):
        given = [(rng.choice(["user", "assistant", "system", "tool", "", "sage"]), f"t{k}", rng.random() < 0.2, rng.random() < 0.3)
                 for k in range(rng.randint(0, 9))]
        rows_ = [(r[:1], gone, cut, 0) for r, _, gone, cut in given]
        best = model.best(rows_)
        end, cost = model.ending(best.ends)
        audit = model.audit(rows_, best, end) + "I" * model.final[end]
        kept = iter([g[:2] for g, e in zip(given, audit.replace("I", "")) if e != "D"])
        assert (cost, audit, model.lines(audit, 0, kept)) == min(plain_edits(given), key=lambda x: x[:2])


def test_random_tables(spark):
    table = random_table(random.Random(2), [*range(60), None, -5], 12)
    assert repaired(spark, table) == plain(table)


@pytest.mark.parametrize("hot", [7, None])
def test_one_conversation_over_many_slices(spark, hot):
    rng = random.Random(3)
    table = random_table(rng, [hot] * 12, 30) + random_table(rng, range(20, 26), 5) + [(hot, None, "user", "w1.")] * 40
    assert repaired(spark, table) == plain(table)


def test_given_table(spark, data):
    got = spark.read.parquet(f"{data}/conversations.parquet").filter("conv_id < 60")
    table = [tuple(r) for r in got.select("conv_id", "turn", "role", "text").collect()]
    assert rows(c.repair(c.damage(got))) == plain(table)


def test_odd_rows(spark):
    odd = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (2, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."),
           (3, 1, "assistant", "word " * 20000 + "."), (4, 2**62, "user", "Hi."), (4, -5, "assistant", "Ho.")]
    table = spark.createDataFrame([(*r, "x", 1) for r in odd], SCHEMA + ", copies string, mark int")
    assert rows(c.repair(c.damage(table))) == plain(odd)
    assert c.repair(c.damage(table.limit(0))).count() == 0
    dropped = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = repaired(spark, [(dropped, 0, "user", "Hi.")])
    assert got == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_text_ids(spark):
    table = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho"), (None, 0, "system", "x.")],
                                  "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: r for r in c.repair(c.damage(table)).collect()}
    assert set(got) == {"a", None}


def test_ending_lines():
    model = c.repairer()
    for k, n in enumerate(model.final):
        if n:
            assert "\n".join(model.lines("I" * n, k, iter(()))) == c.model_ends()[n - 1]
