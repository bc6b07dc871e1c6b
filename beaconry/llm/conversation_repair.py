"""Repair of conversations by generalised LR parsing with weighted edits.

The roles of a sound conversation follow a small grammar: an optional system
turn, then pairs of user and assistant, or nothing at all. Every row may be kept,
get another role or go, and empty turns may be put in anywhere; each edit has a
cost. All edits are followed at once over the parser's graph-structured stack:
stacks are shared nodes, and where several edits lead to the same node the one
of least (cost, audit) stays. The audit is the string of the edits' initials.

Rows are cut into range slices by conversation and turn, so a conversation that
holds a third of all rows spreads over a third of the slices. A slice finishes
the conversations that lie inside it. For the at most two that reach its borders
it gives the cheapest edits from every stack it may be entered with to every
stack it may leave; one small row per slice then picks the way through them.

No audit of the same rows is the beginning of another one (each ends with the
edit of a row), so comparing audits is comparing (rank of the audit so far, new
edits), and equal prefixes never have to be kept or compared as strings.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.session import scratch_path

#: The role grammar over role initials, left recursive: its stacks stay short.
GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Roles that a row can get or that an empty turn can have.
GIVEN = "ua"
#: Cost of deleting, rerolling, inserting, and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
END = "$"
#: Characters of text, and rows, beyond which there are more slices than shuffle partitions.
SLICE_CHARS, SLICE_ROWS = 32_000_000, 200_000
BLANK = re.compile(r"[^\x20\x09-\x0D]")
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
MOVE = "array<struct<entry:int,exit:int,cost:bigint,rank:int,audit:string>>"


@dataclass(eq=False)
class Node:
    """A node of the graph-structured stack: its parser state, on top of ``below``."""

    state: int
    below: Node | None
    above: dict[int, Node] = field(default_factory=dict)

    def push(self, state: int) -> Node:
        """Equal stacks are one node."""
        if state not in self.above:
            self.above[state] = Node(state, self)
        return self.above[state]


class Parser:
    """Generalised LR parser of a grammar whose nonterminals are capital letters."""

    def __init__(self, grammar):
        self.rules = [(END + "S", grammar[0][0]), *grammar]
        terminals = sorted({x for _, right in grammar for x in right if x.islower()})
        follow = self._follow()
        start = self._closure({(0, 0)})
        self.states, self.goto = [start], {}
        for at, items in enumerate(self.states):
            for x in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                to = self._closure({(r, d + 1) for r, d in items if self.rules[r][1][d:d + 1] == x})
                if to not in self.states:
                    self.states.append(to)
                self.goto[at, x] = self.states.index(to)
        self.reduce = {(at, x): [r for r, d in sorted(items) if r and d == len(self.rules[r][1])
                                 and x in follow[self.rules[r][0]]]
                       for at, items in enumerate(self.states) for x in [*terminals, END]}
        self.accepting = {at for at, items in enumerate(self.states) if (0, 1) in items}
        self.terminals = terminals

    def _closure(self, items: set) -> frozenset:
        items, before = set(items), 0
        while len(items) != before:
            before = len(items)
            wanted = {self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}
            items |= {(r, 0) for r, (left, _) in enumerate(self.rules) if left in wanted}
        return frozenset(items)

    def _follow(self) -> dict[str, set]:
        """What can come after each nonterminal; only whole right sides here can be empty."""
        first = {left: set() for left, _ in self.rules}
        follow = {left: set() for left, _ in self.rules}
        follow[self.rules[0][0]] = {END}
        for _ in range(len(self.rules) ** 2):
            for left, right in self.rules:
                for k, x in enumerate(right):
                    after = right[k + 1:k + 2]
                    if not k:
                        first[left] |= first.get(x, {x})
                    if x in follow:
                        follow[x] |= first.get(after, {after}) if after else follow[left]
        return follow

    def shift(self, node: Node, terminal: str) -> list[Node]:
        """Stacks after all reductions that the terminal allows and its shift."""
        out = []
        for top in self._reduced(node, terminal):
            if (top.state, terminal) in self.goto:
                out.append(top.push(self.goto[top.state, terminal]))
        return out

    def accepts(self, node: Node) -> bool:
        return any(top.state in self.accepting for top in self._reduced(node, END))

    def _reduced(self, node: Node, terminal: str) -> list[Node]:
        found = [node]
        for top in found:
            for rule in self.reduce[top.state, terminal]:
                left, right = self.rules[rule]
                base = top
                for _ in right:
                    base = base.below
                found.append(base.push(self.goto[base.state, left]))
        return found


@dataclass(frozen=True)
class Best:
    """Cheapest edits over some rows from one node: by exit node ``(cost, rank)``, and the way back."""

    entry: int
    ends: dict[int, tuple[int, int]]
    steps: list


class Repairer:
    """The grammar's stacks as numbered nodes, with the cheapest edits between them."""

    def __init__(self, grammar=GRAMMAR):
        parser = Parser(grammar)
        nodes, number = [Node(0, None)], {}
        number[nodes[0]] = 0
        self.moves: list[dict[str, int]] = []
        for node in nodes:
            there = {}
            for x in parser.terminals:
                for to in parser.shift(node, x):
                    if to not in number:
                        number[to] = len(nodes)
                        nodes.append(to)
                    there[x] = number[to]
            self.moves.append(there)
        accepted = {k for k, node in enumerate(nodes) if parser.accepts(node)}
        self.inserted = [self._inserted(k) for k in range(len(nodes))]
        #: Inserts that end the conversation from each node.
        self.final = [min(n for to, n in reach.items() if to in accepted) for reach in self.inserted]
        self.steps = {(x, cut): [self._step(k, x, cut) for k in range(len(nodes))]
                      for x in ["", *parser.terminals] for cut in (False, True)}

    def _inserted(self, node: int) -> dict[int, int]:
        """Nodes reached by inserted turns, with their least number."""
        reach, edge = {node: 0}, [node]
        for k in edge:
            for x in GIVEN:
                to = self.moves[k].get(x)
                if to is not None and to not in reach:
                    reach[to] = reach[k] + 1
                    edge.append(to)
        return reach

    def _step(self, node: int, initial: str, truncated: bool) -> list[tuple[int, int, str]]:
        """``(to, cost, edits)`` for one row from a node, the least for each target.

        Inserts before a deleted row are left out: after it they cost the same and
        their audit is less.
        """
        found = {node: (DELETE, "D")}
        for at, n in self.inserted[node].items():
            stay = n * INSERT + truncated * TRUNCATED
            ways = [(self.moves[at].get(initial), stay, "K")]
            ways += [(self.moves[at].get(x), stay + REROLE, "R") for x in GIVEN]
            for to, cost, edit in ways:
                if to is not None:
                    found[to] = min(found.get(to, (cost, "Z")), (cost, "I" * n + edit))
        return [(to, *way) for to, way in sorted(found.items())]

    def best(self, rows: list[tuple], entry: int = 0) -> Best:
        """Cheapest edits over ``rows``: ``(initial, gone, truncated, extra)`` with ``gone`` for a row
        that has to go and ``extra`` for further ones after it that have to."""
        tops, steps = {entry: (0, 0)}, []
        for initial, gone, truncated, extra in rows:
            if gone:
                tops = {k: (cost + DELETE, rank) for k, (cost, rank) in tops.items()}
                steps.append(None)
            else:
                table, new = self.steps[initial if initial in self.moves_all else "", truncated], {}
                for k, (cost, rank) in tops.items():
                    for to, more, edits in table[k]:
                        way = (cost + more, rank, edits, k)
                        if to not in new or way < new[to]:
                            new[to] = way
                order = {x: r for r, x in enumerate(sorted({w[1:3] for w in new.values()}))}
                steps.append({to: (w[3], w[2]) for to, w in new.items()})
                tops = {to: (w[0], order[w[1:3]]) for to, w in new.items()}
            if extra:
                tops = {k: (cost + DELETE * extra, rank) for k, (cost, rank) in tops.items()}
        return Best(entry, tops, steps)

    @functools.cached_property
    def moves_all(self) -> set[str]:
        return {x for x, _ in self.steps}

    def ending(self, ends: dict[int, tuple[int, int]]) -> tuple[int, int]:
        """``(exit, cost)`` of the whole, with the inserts that end it."""
        cost, _, node = min((cost + INSERT * self.final[k], rank, k) for k, (cost, rank) in ends.items())
        return node, cost

    @staticmethod
    def audit(rows: list[tuple], best: Best, exit_node: int) -> str:
        """Initials of the edits that lead to a node."""
        out, node = [], exit_node
        for (_, _, _, extra), step in zip(reversed(rows), reversed(best.steps)):
            out.append("D" * extra)
            if step is None:
                out.append("D")
            else:
                node, edits = step[node]
                out.append(edits)
        return "".join(reversed(out))

    def lines(self, audit: str, entry: int, kept: Iterator[tuple[str, str]]) -> list[str]:
        """``role:text`` of every turn that the edits leave; ``kept`` has the rows not deleted, in order."""
        out, node = [], entry
        for edit in audit:
            if edit == "D":
                continue
            role, text = next(kept) if edit != "I" else ("", "")
            initial = role[:1] if edit == "K" else next(x for x in GIVEN if x in self.moves[node])
            out.append(f"{role if edit == 'K' else ROLES[initial]}:{text}")
            node = self.moves[node][initial]
        return out


@functools.lru_cache(maxsize=1)
def repairer() -> Repairer:
    return Repairer()


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` with faults put in by ``crc32(conv_id:turn) % 20``.

    0 drops a row (it stays with 0 copies, so its conversation is not lost), 1
    empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user.
    Null roles and texts are one space, null ids and turns are so in the key.
    """
    blank = F.lit(" ")
    rows = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     F.coalesce(F.col(f"`{role_col}`").cast("string"), blank).alias("role"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), blank).alias("text"))
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank))) % 20
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def sliced(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text, copies, again)`` in sorted range slices.

    Equal rows become one with the sum of their copies; ``again`` says that role and
    text stand at an earlier turn. Rows of one turn follow by a hash of role and
    text, then by these.
    """
    spark = rows.sparkSession
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    path = scratch_path(spark, "turns")
    same.write.parquet(path)
    same = spark.read.parquet(path)
    many = (same.filter("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"))
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("turn").isNull()).alias("unknown"), F.min("turn").alias("first"))
            .filter("n > 1"))
    held = same.join(many, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                     & (F.col("text") == F.col("t")), "left")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("unknown") | (F.col("turn") > F.col("first"))), F.lit(False))
    size = same.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    least = spark.conf.get("spark.sql.shuffle.partitions")
    slices = max(int(least) if least.isdigit() else 1, -(-(size["chars"] or 0) // SLICE_CHARS), -(-size["n"] // SLICE_ROWS))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("mark")]
    return (held.select("conv_id", "turn", "role", "text", "copies", again.alias("again"), F.xxhash64("role", "text").alias("mark"))
            .repartitionByRange(slices, *order).sortWithinPartitions(*order, "role", "text").drop("mark"))


@dataclass
class Fragment:
    """The rows of one conversation in one slice, in order."""

    conv: object
    rows: list = field(default_factory=list)
    stay: list = field(default_factory=list)
    faults: list = field(default_factory=lambda: [0, 0, 0])
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, again: bool) -> None:
        if not copies:
            return
        initial = role[:1]
        blank = not BLANK.search(text)
        cut = not blank and text.rstrip(WHITE)[-1] not in ".!?"
        self.faults[0] += copies if blank else 0
        self.faults[1] += 0 if blank else copies - (not again)
        self.faults[2] += not blank and not again and cut
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.rows.append((initial, blank or again, cut, copies - 1))
        self.stay.append(None if blank or again else (role, text))

    def kept(self, audit: str) -> Iterator[tuple[str, str]]:
        """Role and text of the rows that the audit doesn't delete."""
        edits = iter(audit.replace("I", ""))
        for (_, _, _, extra), row in zip(self.rows, self.stay):
            if next(edits) != "D":
                yield row
            for _ in range(extra):
                next(edits)

    def summary(self) -> list:
        return [*self.faults, self.illegal, self.first, self.last, self.low, self.high, self.turns]


SUMMARY = ("blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
           "low long, high long, turns long")


def _digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def _closed(model: Repairer, part: Fragment) -> dict:
    """Result of a conversation that lies inside one slice."""
    best = model.best(part.rows)
    end, cost = model.ending(best.ends)
    audit = model.audit(part.rows, best, end) + "I" * model.final[end]
    return {"cost": cost, "audit": audit, "repaired_sha256": _digest(model.lines(audit, 0, part.kept(audit)))}


def _open(model: Repairer, part: Fragment) -> dict:
    """Cheapest edits between all nodes, and the rows that may stay."""
    ways = [(b.entry, end, cost, model.audit(part.rows, b, end))
            for b in (model.best(part.rows, k) for k in range(len(model.moves))) for end, (cost, _) in b.ends.items()]
    rank = {a: r for r, a in enumerate(sorted({w[3] for w in ways}))}
    return {"ways": [{"entry": i, "exit": o, "cost": c, "rank": rank[a], "audit": a} for i, o, c, a in ways],
            "stay": [{"role": s[0], "text": s[1], "extra": r[3]} if s else {"role": None, "text": None, "extra": r[3]}
                     for s, r in zip(part.stay, part.rows)]}


def fragments(rows: DataFrame) -> DataFrame:
    """One row per conversation and slice: finished, or open where it may reach a border."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {conv_type}, slice int, {SUMMARY}, cost long, audit string, repaired_sha256 string, ways {MOVE}, "
              "stay array<struct<role:string,text:string,extra:bigint>>")
    arrow = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    types = [arrow[f.split()[1]] for f in SUMMARY.split(", ")]
    way = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
                              ("audit", pa.string())]))
    stay = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("extra", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, here = repairer(), TaskContext.get().partitionId()
        part, first, kind, done = None, True, None, []

        def flush():
            convs, results = zip(*done) if done else ((), ())
            got = [[r["summary"][k] for r in results] for k in range(len(names))]
            return pa.RecordBatch.from_arrays(
                [pa.array(convs, kind), pa.array([here] * len(done), pa.int32()),
                 *(pa.array(v, t) for v, t in zip(got, types)),
                 *(pa.array([r.get(c) for r in results], t) for c, t in
                   (("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("ways", way), ("stay", stay)))],
                names=["conv_id", "slice", *names, "cost", "audit", "repaired_sha256", "ways", "stay"])

        for batch in batches:
            kind = batch.column(0).type
            for conv, turn, role, text, copies, again in zip(*(c.to_pylist() for c in batch.columns)):
                if part is None or part.conv != conv:
                    if part is not None:
                        done.append((part.conv, (_open if first else _closed)(model, part) | {"summary": part.summary()}))
                        first = False
                    part = Fragment(conv)
                part.add(turn, role, text, copies, again)
            yield flush()
            done.clear()
        if part is not None:
            done.append((part.conv, _open(model, part) | {"summary": part.summary()}))
            yield flush()

    return rows.mapInArrow(run, schema)


def _through(model: Repairer, rows) -> tuple[list, dict]:
    """The way through the slices of one conversation, from their summaries in order: the
    chosen ``(entry, exit)`` of each, and the whole conversation's numbers."""
    tops, back = {0: (0, 0)}, []
    whole, last, low, high, turns = [0, 0, 0, 0], None, None, None, 0
    for r in rows:
        new = {}
        for w in r["ways"]:
            if w["entry"] in tops:
                cost, rank = tops[w["entry"]]
                way = (cost + w["cost"], rank, w["rank"], w["entry"])
                if w["exit"] not in new or way < new[w["exit"]]:
                    new[w["exit"]] = way
        order = {x: k for k, x in enumerate(sorted({w[1:3] for w in new.values()}))}
        back.append({to: w[3] for to, w in new.items()})
        tops = {to: (w[0], order[w[1:3]]) for to, w in new.items()}
        whole = [a + r[c] for a, c in zip(whole, ("blank", "duplicate", "truncated", "illegal"))]
        if r["first_role"] is not None:
            whole[3] += last is not None and last + r["first_role"] not in ("su", "ua", "au")
            last = r["last_role"]
        if r["low"] is not None:
            turns += r["turns"] - (r["low"] == high)
            low, high = r["low"] if low is None else low, r["high"]
    end, cost = model.ending(tops)
    path, node = [], end
    for step in reversed(back):
        path.append((step[node], node))
        node = step[node]
    gaps = 0 if low is None else high - low + 1 - turns
    return path[::-1], dict(zip(("blank", "duplicate", "truncated", "illegal"), whole)) | {
        "gaps": gaps, "cost": cost, "tail": model.final[end]}


def _joined(parts: DataFrame) -> DataFrame:
    """Results of the conversations that reach the border of a slice.

    Summaries (one row per slice at most) go to one task per conversation; the
    edits chosen there are then applied slice by slice. A conversation's audit and
    hash are one cell each, so its pieces meet in the last aggregate.
    """
    conv_type = parts.schema["conv_id"].dataType.simpleString()
    light = parts.select("conv_id", "slice", *[f.split()[0] for f in SUMMARY.split(", ")],
                         F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"),
                                                                w["cost"].alias("cost"), w["rank"].alias("rank"))).alias("ways"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "tail")

    def choose(table: pa.Table) -> pa.Table:
        rows = table.sort_by("slice").to_pylist()
        path, whole = _through(repairer(), rows)
        return pa.table({"conv_id": pa.array([r["conv_id"] for r in rows], table.schema.field("conv_id").type),
                         "slice": pa.array([r["slice"] for r in rows], pa.int32()),
                         "entry": pa.array([p[0] for p in path], pa.int32()), "exit": pa.array([p[1] for p in path], pa.int32()),
                         **{c: pa.array([whole[c]] * len(rows), pa.int64()) for c in numbers}})

    chosen = light.groupBy("conv_id").applyInArrow(
        choose, f"conv_id {conv_type}, slice int, entry int, exit int, " + ", ".join(f"{c} long" for c in numbers))
    on = parts["conv_id"].eqNullSafe(chosen["conv_id"]) & (parts["slice"] == chosen["slice"])
    picked = F.element_at(F.filter(parts["ways"], lambda w: (w["entry"] == F.col("entry")) & (w["exit"] == F.col("exit"))), 1)
    heavy = parts.join(chosen, on).select(parts["conv_id"], parts["slice"], "entry", picked["audit"].alias("audit"), "stay",
                                          *[chosen[c] for c in numbers])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = repairer()
        for batch in batches:
            pieces = []
            for r in batch.select(["entry", "audit", "stay"]).to_pylist():
                part = Fragment(None, [(None, None, None, s["extra"]) for s in r["stay"]],
                                [(s["role"], s["text"]) for s in r["stay"]])
                lines = model.lines(r["audit"], r["entry"], part.kept(r["audit"]))
                pieces.append("\n".join(lines) if lines else None)
            keep = [k for k, c in enumerate(batch.schema.names) if c not in ("entry", "stay")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(pieces, pa.string())],
                                             names=[*(batch.schema.names[k] for k in keep), "piece"])

    done = heavy.mapInArrow(apply, f"conv_id {conv_type}, slice int, audit string, "
                            + ", ".join(f"{c} long" for c in numbers) + ", piece string")
    ends = model_ends()
    whole = done.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("slice", "audit", "piece"))).alias("parts"), *[F.first(c).alias(c) for c in numbers])
    audit = F.array_join(F.transform("parts", lambda p: p["audit"]), "")
    kept = F.transform("parts", lambda p: p["piece"])
    # The inserts at the end are assistant, or user and assistant.
    tail = F.when(F.col("tail") > 0, F.element_at(F.array(*[F.lit(x) for x in ends]), F.col("tail").cast("int")))
    text = F.array_join(F.concat(kept, F.array(tail)), "\n")
    return whole.select("conv_id", *numbers[:-1], F.concat(audit, F.repeat(F.lit("I"), F.col("tail").cast("int"))).alias("audit"),
                        F.sha2(text, 256).alias("repaired_sha256"))


def model_ends() -> list[str]:
    """Lines of one, two, ... inserts that end a conversation."""
    return ["assistant:", "user:\nassistant:"]


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conversation.

    ``rows`` has ``conv_id, turn, role, text, copies``; a row with 0 copies only names its
    conversation. Turns are taken in order, nulls first; rows of one turn by a hash
    of role and text. A row's first fault counts: blank, duplicate (role and text
    seen earlier), truncated (no ``[.!?]`` at the end). Blank and duplicate rows go.
    ``gaps`` are the turns missing between the smallest and the largest, null turns
    aside; ``illegal`` the neighbours whose roles can't follow each other. A
    conversation without rows has zeros, an empty audit and the hash of an empty
    text. Null ids are one conversation; repeated rows are copies of one; an empty
    table gives no rows.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "fragments")
    fragments(sliced(rows)).write.parquet(path)
    stored = spark.read.parquet(path)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    inside = stored.filter("ways IS NULL").select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                                  "repaired_sha256")
    return inside.unionByName(_joined(stored.filter("ways IS NOT NULL")))
