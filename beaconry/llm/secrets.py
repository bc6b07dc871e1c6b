"""Secrets in texts: three fixed rules, and a character network for what they miss.

The rules give the base spans. Every other run of key-like characters is a
candidate; a small convolutional network in numpy reads it with its surrounding
characters. The network is trained on the candidates of all rows, labelled by the
rules, and on variants of them with other alphabets and keys: they are dealt into
shards, each shard's task trains the common weights for an epoch, and their mean goes
on. Its scores are calibrated on all candidates held back, and the threshold of each
alphabet is the highest that keeps the wanted recall.
"""

from __future__ import annotations

import copy
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import SLICE_ROWS, arrow_schema, keyed_texts, map_rows
from beaconry.session import scratch_path
from beaconry.sources.tables import replace_table

# The base rules.
KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs that may be a key: long enough, letters with digits or with both cases inside.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
DIGITS, LOWER, UPPER = (frozenset(x) for x in (string.digits, string.ascii_lowercase, string.ascii_uppercase))

#: Distinct candidates of one training shard, about; passes over all of them.
SHARD_ROWS, EPOCHS = 4_096, 10
#: Steps per unit in which held-back scores are counted, and the bits of summed weights.
SCORE_STEPS, WEIGHT_UNIT = 10_000, 2.0 ** 30
BEFORE, INSIDE, AFTER = 28, 44, 8
WIDTH = BEFORE + INSIDE + AFTER
#: Steps between the windows over a candidate that is longer than one.
STEP = 11
SYMBOLS = 98
MARK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules, leftmost without overlaps per kind, by start."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def key_like(run: str) -> bool:
    """Letters with digits, or small letters with capitals after the first character."""
    chars, rest = set(run), set(run[1:])
    if chars & DIGITS:
        return bool(chars & (LOWER | UPPER))
    return bool(chars & LOWER and rest & UPPER)


def candidates(text: str) -> list[tuple[int, int]]:
    """Key-like runs, whole."""
    return [m.span() for m in CANDIDATE.finditer(text) if key_like(m.group())]


def overlaps(span: tuple[int, int], spans: list[tuple[int, int, str]]) -> bool:
    return any(s[0] < span[1] and span[0] < s[1] for s in spans)


def open_parts(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidates, and of those that meet base spans their key-like parts outside them."""
    out = []
    for start, end in candidates(text):
        at = start
        for a, b, _ in [*[s for s in base if s[0] < end and start < s[1]], (end, end, "")]:
            out += [(at + x, at + y) for x, y in candidates(text[at:a])] if a > at else []
            at = max(at, b)
    return out


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """Overlapping windows over a whole candidate, as the network reads them."""
    last = max(start, end - INSIDE)
    places = [(a, min(end, a + INSIDE)) for a in [*range(start, last, STEP), last]]
    return [(text[max(0, a - BEFORE):a], text[a:b], text[b:b + AFTER]) for a, b in places]


def window(text: str, start: int, end: int) -> tuple[str, str, str]:
    """Characters before, in and after a candidate, as the network reads them."""
    return text[max(0, start - BEFORE):start], text[start:end][:INSIDE], text[end:end + AFTER]


def encode(windows: list[tuple[str, str, str]]) -> np.ndarray:
    """Symbol numbers, one row of fixed width per window; 0 pads, 97 is any other character."""
    text = "".join(b[-BEFORE:].rjust(BEFORE, "\0") + c[:INSIDE].ljust(INSIDE, "\0") + a[:AFTER].ljust(AFTER, "\0")
                   for b, c, a in windows)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, WIDTH)
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 31, 97)).astype(np.int64)


def shape_of(value: str) -> int:
    """Alphabet of a candidate: 0 one case and digits, 1 both cases, 2 with signs."""
    if re.search(r"[^A-Za-z0-9]", value):
        return 2
    return int(value != value.lower() and value != value.upper())


class Network:
    """Embedding, one convolution, maximum per region (context, candidate), two dense layers."""

    def __init__(self, seed: int = 8, size: int = 12, filters: int = 32, reach: int = 5, hidden: int = 24):
        rng = np.random.default_rng(seed)
        self.reach = reach
        self.at = np.arange(WIDTH - reach + 1)[:, None] + np.arange(reach)
        middle = self.at[:, reach // 2]
        self.inside = (middle >= BEFORE) & (middle < BEFORE + INSIDE)

        def start(*shape):
            return rng.normal(0, (2 / shape[0]) ** 0.5, shape)

        self.w = {"embed": rng.normal(0, 0.5, (SYMBOLS, size)), "conv": start(reach * size, filters),
                  "conv_b": np.zeros(filters), "dense": start(3 * filters, hidden), "dense_b": np.zeros(hidden),
                  "out": start(hidden, 1), "out_b": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, dict]:
        e = self.w["embed"][x]
        cols = e[:, self.at].reshape(len(x), len(self.at), -1)
        z = np.maximum(cols @ self.w["conv"] + self.w["conv_b"], 0)
        own, other = z[:, self.inside], z[:, ~self.inside]
        pooled = np.concatenate((own.max(axis=1), own.mean(axis=1), other.max(axis=1)), axis=1)
        h = np.maximum(pooled @ self.w["dense"] + self.w["dense_b"], 0)
        return (h @ self.w["out"] + self.w["out_b"])[:, 0], {"x": x, "cols": cols, "z": z, "pooled": pooled, "h": h}

    def gradients(self, logit: np.ndarray, y: np.ndarray, c: dict) -> dict:
        d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)).astype(logit.dtype)[:, None]
        g = {"out": c["h"].T @ d, "out_b": d.sum(axis=0)}
        dh = (d @ self.w["out"].T) * (c["h"] > 0)
        g["dense"], g["dense_b"] = c["pooled"].T @ dh, dh.sum(axis=0)
        dp = dh @ self.w["dense"].T
        n = dp.shape[1] // 3
        dz, row = np.zeros_like(c["z"]), np.arange(len(y))[:, None]
        for mask, part, mean in ((self.inside, dp[:, :n], dp[:, n:2 * n]), (~self.inside, dp[:, 2 * n:], None)):
            where = np.flatnonzero(mask)
            top = where[c["z"][:, mask].argmax(axis=1)]
            dz[row, top, np.arange(n)] += part
            if mean is not None:
                dz[:, mask] += mean[:, None] / len(where)
        dz *= c["z"] > 0
        flat, cols = dz.reshape(-1, n), c["cols"].reshape(-1, c["cols"].shape[2])
        g["conv"], g["conv_b"] = cols.T @ flat, flat.sum(axis=0)
        de = (flat @ self.w["conv"].T).reshape(len(y), len(self.at), self.reach, -1)
        each = np.zeros((len(y), WIDTH, de.shape[-1]), dtype=de.dtype)
        for r in range(self.reach):
            each[:, r:r + len(self.at)] += de[:, :, r]
        g["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(g["embed"], c["x"], each)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 128,
              rate: float = 3e-3, decay: float = 2e-3, seed: int = 8) -> None:
        """Adam with weight decay on the logistic loss, rows in a seeded order."""
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                logit, cache = self.forward(x[rows])
                step += 1
                for k, g in self.gradients(logit, y[rows], cache).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                    if not k.endswith("_b"):
                        self.w[k] *= 1 - rate * decay * 10

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i:i + 256])[0].astype(float) for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)


@dataclass
class Detector:
    """A trained network with its calibration and the thresholds per alphabet."""

    network: Network
    scale: float
    shift: float
    thresholds: list[float]

    def chances(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.network.logits(encode(windows)) + self.shift, -30, 30)))

    def accepts(self, windows: list[tuple[str, str, str]]) -> np.ndarray:
        if not windows:
            return np.zeros(0, dtype=bool)
        limits = np.array([self.thresholds[shape_of(w[1])] for w in windows])
        return self.chances(windows) >= limits

    def judged(self, asked: list[tuple[str, int, int]], at_once: int = 4096) -> list[bool]:
        """Whether any window of each (text, start, end) is accepted by its own alphabet's threshold."""
        out, held, owner = [False] * len(asked), [], []
        for i, span in enumerate(asked):
            for w in windows(*span):
                held.append(w)
                owner.append(i)
                if len(held) == at_once:
                    self._judge(held, owner, out)
        self._judge(held, owner, out)
        return out

    def _judge(self, held: list, owner: list, out: list) -> None:
        for i, yes in zip(owner, self.accepts(held).tolist()):
            out[i] = out[i] or yes
        held.clear()
        owner.clear()


def calibrate(logit: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Platt scaling with softened targets, by Newton steps; each score counts ``n`` times."""
    pos, neg = (n * y).sum(), (n * (1 - y)).sum()
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        w = n * (p * (1 - p) + 1e-9)
        grad = np.array([(n * (p - goal) * logit).sum(), (n * (p - goal)).sum()])
        hess = np.array([[(w * logit * logit).sum() + 1e-6, (w * logit).sum()], [(w * logit).sum(), w.sum() + 1e-6]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
    return float(a), float(b)


def variants(rng: np.random.Generator, contexts: list[tuple[str, str]], n: int) -> tuple[list, list]:
    """Made windows: keys of other alphabets and assignments, and harmless runs.

    Values are random; their surroundings are those of findings in the corpus.
    """
    def draw(alphabet: str, length: int) -> str:
        return "".join(rng.choice(list(alphabet), length))

    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
                 string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits,
                 string.ascii_letters + string.digits + "_-")
    heads = ("", "", "key=", "auth: ", "client_key=", "bearer ", "credential: ", "access_key = \"", "pwd=")
    words = ("north", "river", "table", "index", "image", "report", "value", "green", "stone", "paper")
    secrets, harmless = [], []
    for i in range(n):
        before, after = contexts[int(rng.integers(len(contexts)))] if contexts else ("text ", " text")
        value = draw(alphabets[i % len(alphabets)], int(rng.integers(18, 44)))
        head = heads[int(rng.integers(len(heads)))]
        if "=" in head and " " not in head:  # no space: the run includes the name
            secrets.append((before[-BEFORE:], (head + value)[:INSIDE], after))
        else:
            secrets.append(((before + head)[-BEFORE:], value[:INSIDE], after))
        pick = [words[int(j)] for j in rng.integers(len(words), size=4)]
        number = int(rng.integers(1, 9999))
        run = (f"{pick[0]}{number}.{pick[1]}.com/{pick[2]}", f"{pick[0]}_{pick[1]}_{pick[2]}_{number}",
               f"{pick[0]}-{pick[1]}-{pick[2]}-{number}.html", pick[0] + pick[1].title() + pick[2].title() + pick[3].title(),
               f"{draw(string.digits, 8)}-{draw(string.digits, 4)}-{pick[0]}", f"v{number % 9}.{number % 30}.{number % 7}-{pick[0]}.{pick[1]}",
               f"//www.{pick[0]}.org/{pick[1]}/20{number % 90 + 10}/{pick[2]}_{pick[3]}.html", f"{pick[0].upper()}-{number}-{pick[1].upper()}{number % 7}",
               f"20{number % 90 + 10}-0{number % 9 + 1}-1{number % 9}T1{number % 9}.30.00")[i % 8]
        harmless.append((before[-BEFORE:], run[:INSIDE], after))
    return secrets, harmless


def labelled(df: DataFrame) -> DataFrame:
    """``(label, before, value, after)``: the distinct candidates of all rows; 1 where a rule finds a secret."""
    def work(texts):
        out = []
        for text in texts:
            base = base_spans(text) if text else []
            for span in candidates(text) if text else []:
                out.append((int(overlaps(span, base)), *window(text, *span)))
        return list(zip(*out, strict=True)) if out else [[], [], [], []]

    found = map_rows(df.select("text"), work, "label int, before string, value string, after string")
    return replace_table(found.distinct(), scratch_path(df.sparkSession, "findings"))


def examples(found: DataFrame, made: int, seed: int) -> tuple[DataFrame, int]:
    """``(shard, held, x, shape, y)``: symbol numbers, alphabets and labels of each shard's own and
    made windows, one row for those that train and one for those held back; the number of shards."""
    spark = found.sparkSession
    shards = max(1, -(-found.count() // SHARD_ROWS))
    dealt = found.select(F.pmod(F.xxhash64("before", "value", "after"), F.lit(shards)).cast("long").alias("shard"), "*")
    # A shard without findings still trains on made windows.
    every = dealt.unionByName(spark.range(shards).select(F.col("id").alias("shard")), allowMissingColumns=True)
    schema = "shard long, held boolean, x binary, shape binary, y binary"
    out = arrow_schema(schema)

    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        columns = [table.column(c).to_pylist() for c in ("label", "before", "value", "after")]
        rows = sorted(r for r in zip(*columns) if r[0] is not None)
        rng = np.random.default_rng(seed + shard)
        n = max(-(-made // shards), len(rows) // 2)
        secrets, harmless = variants(rng, [(b, a) for _, b, _, a in rows], n)
        windows = [r[1:] for r in rows] + secrets + harmless
        y = np.array([r[0] for r in rows] + [1] * n + [0] * n, dtype=np.uint8)
        order = rng.permutation(len(windows))
        held = np.zeros(len(windows), dtype=bool)
        held[order[:len(order) // 4]] = True
        x, shape = encode(windows).astype(np.uint8), np.array([shape_of(w[1]) for w in windows], dtype=np.uint8)
        return pa.table([pa.array(v, f.type) for v, f in zip((
            [shard] * 2, [False, True], *([v[m].tobytes() for m in (~held, held)] for v in (x, shape, y))), out)], schema=out)

    stored = every.groupBy("shard").applyInArrow(work, schema)
    return replace_table(stored, scratch_path(spark, "examples")), shards


def _numbers(data: bytes, width: int = 1) -> np.ndarray:
    got = np.frombuffer(data, np.uint8)
    return got.reshape(-1, width).astype(np.int64) if width > 1 else got


def _trained(network: Network, rows: DataFrame, epochs: int, seed: int) -> None:
    """Each shard trains the network's weights; their mean by rows, exact in any order, replaces them."""
    shared = rows.sparkSession.sparkContext.broadcast(network)  # some thousand weights
    schema = "place int, total long, n long"
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own, y = copy.deepcopy(shared.value), _numbers(y).astype(float)
                own.train(_numbers(x, WIDTH), y, epochs, seed=seed)
                flat = np.concatenate([v.ravel() for v in own.w.values()]).astype(float)
                total = np.rint(flat * WEIGHT_UNIT).astype(np.int64) * len(y)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(total), pa.array(np.full(len(flat), len(y)))],
                    schema=out)

    got = rows.select("x", "y").mapInArrow(run, schema).groupBy("place").agg(F.sum("total"), F.sum("n")).collect()
    flat = np.zeros(len(got))
    for place, total, n in got:
        flat[place] = total / n / WEIGHT_UNIT
    at = 0
    for k, v in network.w.items():
        network.w[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size


def _held_back(network: Network, rows: DataFrame) -> np.ndarray:
    """(score, label, alphabet, count) of all windows held back; scores in steps, rounded down."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    schema = "step int, label int, shape int"

    def run(batches):
        for batch in batches:
            for x, shape, y in zip(*(c.to_pylist() for c in batch.columns)):
                step = np.floor(np.clip(shared.value.logits(_numbers(x, WIDTH)), -30, 30) * SCORE_STEPS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.astype(np.int32)) for v in (step, _numbers(y), _numbers(shape))], schema=arrow_schema(schema))

    got = (rows.select("x", "shape", "y").mapInArrow(run, schema).groupBy("step", "label", "shape")
           .agg(F.count("*").alias("n")).orderBy("step", "label", "shape").collect())
    return np.array([tuple(r) for r in got], dtype=float).reshape(-1, 4) / [SCORE_STEPS, 1, 1, 1]


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.98,
          made: int = 2_500, seed: int = 8) -> Detector:
    """A detector from the labelled candidates of all rows; it works on an empty table too."""
    stored, shards = examples(labelled(keyed_texts(df, id_col, text_col)), made, seed)
    network, own = Network(seed), stored.filter("NOT held").repartition(shards, "shard")
    if shards == 1:
        _trained(network, own, EPOCHS, seed)
    else:
        for epoch in range(EPOCHS):
            _trained(network, own, 1, seed + epoch)
    logit, y, shapes, n = _held_back(network, stored.filter("held").repartition(shards, "shard")).T
    scale, shift = calibrate(logit, y, n)
    chance = 1 / (1 + np.exp(-np.clip(scale * logit + shift, -30, 30)))

    def limit(mask):
        some = np.flatnonzero(mask & (y > 0))
        some = some[np.argsort(chance[some], kind="stable")]
        upto = np.cumsum(n[some])
        if not len(some) or upto[-1] < 20:
            return None
        return float(chance[some][np.searchsorted(upto, int((1 - recall) * upto[-1]), side="right")])

    overall = limit(np.ones(len(chance), dtype=bool)) or 0.5
    return Detector(network, scale, shift, [limit(shapes == s) or overall for s in range(3)])


def scan(df: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, kinds, starts, ends)`` per row: all spans by start, then kind.

    Places are code points, ends exclusive. Base spans are never changed; learned
    spans are candidates, or their parts outside base spans, of which the detector
    accepts a window anywhere. Null and empty texts have none. Repeated rows and null ids stay; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(detector)  # some thousand weights

    def work(ids, texts):
        spans, asked, where = [], [], []
        for i, text in enumerate(texts):
            base = base_spans(text) if text else []
            spans.append(base)
            for span in open_parts(text, base) if text else []:
                asked.append((text, *span))
                where.append((i, span))
        spans = [list(s) for s in spans]
        for (i, span), yes in zip(where, shared.value.judged(asked)):
            if yes:
                spans[i].append((*span, "learned"))
        for s in spans:
            s.sort(key=lambda v: (v[0], KINDS.index(v[2])))
        return (ids, [[v[2] for v in s] for s in spans], [[v[0] for v in s] for s in spans],
                [[v[1] for v in s] for s in spans])

    return map_rows(keyed_texts(df, id_col, text_col), work,
                    "doc_id long, kinds array<string>, starts array<long>, ends array<long>")


def redact(text: str, spans: list[tuple[int, int]], mark: str = MARK) -> str:
    """The text with every span replaced; overlapping spans become one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, detector: Detector, text_col: str = "text") -> DataFrame:
    """``df`` with secrets in its text column replaced; null texts stay null.

    All other columns, of any name and type, are unchanged and repeated rows stay;
    an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(detector)
    at = df.columns.index(text_col)

    def cleaned(texts):
        spans = [base_spans(t) if t else [] for t in texts]
        asked = [(i, c) for i, t in enumerate(texts) if t for c in open_parts(t, spans[i])]
        yes = shared.value.judged([(texts[i], *c) for i, c in asked])
        more: dict[int, list] = {}
        for (i, c), ok in zip(asked, yes):
            if ok:
                more.setdefault(i, []).append(c)
        for i, t in enumerate(texts):
            every = [s[:2] for s in spans[i]] + more.get(i, [])
            yield redact(t, every) if every else t

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                columns = list(part.columns)
                columns[at] = pa.array(cleaned(columns[at].to_pylist()), columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)
