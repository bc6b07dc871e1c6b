"""Token counts of a piece vocabulary by rank-synchronous merging of arrays.

Texts are cut into pre-tokens at places that no piece of the vocabulary spans,
so the counts of the pre-tokens add up to the count of the text. The distinct
pre-tokens of a slice of rows are laid end to end in one symbol array; in each
round every sequence applies its own lowest-rank pair, all sequences at once,
until no pair is left. Counts are remembered per task in a cache of fixed size.
"""

from __future__ import annotations

import functools
import itertools
import re

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from beaconry.llm.common import Memo, keyed_texts, map_rows

SPACE = "▁"
NONE = np.iinfo(np.int64).max
#: Entries of the per-task cache, and the longest pre-token it holds.
CACHED, CACHED_CHARS = 600_000, 48


class PieceCounter:
    """Vocabulary of a byte-fallback piece model, as arrays."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = -model.get_score(i)
        if model.encode("A  b", out_type=str) != model.encode("A", out_type=str) + [SPACE, SPACE + "b"]:
            raise ValueError("only models that keep white space and put one space before a text are counted here")
        chars = {c for p in pieces for c in p}
        self.symbols = {s: i for i, s in enumerate([*pieces, *sorted(chars - pieces.keys())])}
        self.width = len(self.symbols)
        order = {p: r for r, p in enumerate(sorted(pieces, key=pieces.get))}
        keys, ranks, merged = [], [], []
        for piece in pieces:
            for cut in range(1, len(piece)):
                a, b = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(order[piece])
                    merged.append(self.symbols[piece])
        by = np.argsort(keys)
        self.keys = np.array(keys, dtype=np.int64)[by]
        self.ranks = np.array(ranks, dtype=np.int64)[by]
        self.merged = np.array(merged, dtype=np.int64)[by]
        self.of_char = np.full(0x110000, -1, dtype=np.int64)
        for c in chars:
            self.of_char[ord(c)] = self.symbols[c]
        # A character that stands for itself costs one token, any other one per byte.
        self.bytes_of = np.ones(0x110000, dtype=np.int64)
        self.bytes_of[0x80:0x800], self.bytes_of[0x800:0x10000], self.bytes_of[0x10000:] = 2, 3, 4
        for c in chars & pieces.keys():
            self.bytes_of[ord(c)] = 1
        alone = "".join(chr(c) for c in range(128) if chr(c) not in chars)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that hold a space after another character are not supported")
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}{re.escape(alone)}]+|{SPACE}+|[{re.escape(alone)}]")

    def pre_tokens(self, text: str | None) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of joining symbols; NONE where they do not join."""
        key = np.where((left >= 0) & (right >= 0), left * self.width + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        counts = np.zeros(len(words), dtype=np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(chars):
            return counts
        seq = np.repeat(np.arange(len(words)), [len(w) for w in words])
        sym = self.of_char[chars]
        single = np.bincount(seq, weights=self.bytes_of[chars] - 1, minlength=len(words)).astype(np.int64)
        rank, merged = self._rank(sym, np.append(sym[1:], -1))
        rank[:-1][seq[1:] != seq[:-1]] = NONE
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            size = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            done = low == NONE
            counts[seq[first[done]]] = size[done]
            if done.any():
                keep = np.repeat(~done, size)
                sym, seq, rank, merged = sym[keep], seq[keep], rank[keep], merged[keep]
                size, low = size[~done], low[~done]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            # Pairs that overlap take turns from the left.
            run = np.concatenate(([True], np.diff(at) != 1))
            at = at[(at - at[run][np.cumsum(run) - 1]) % 2 == 0]
            at = at[self._together(sym, seq, at, rank, merged)]
            sym[at] = merged[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, seq, rank, merged = sym[keep], seq[keep], rank[keep], merged[keep]
            # Only pairs beside a join have changed.
            at = at - np.arange(len(at))
            changed = np.zeros(len(sym), dtype=bool)
            changed[at] = changed[at[at > 0] - 1] = True
            at = np.flatnonzero(changed)
            beyond = np.minimum(at + 1, len(sym) - 1)
            after = np.where((beyond > at) & (seq[beyond] == seq[at]), sym[beyond], -1)
            rank[at], merged[at] = self._rank(sym[at], after)
        # Characters that no pair can hold keep their bytes; those inside pieces are whole.
        return counts + single

    def _together(self, sym, seq, at, rank, merged) -> np.ndarray:
        """Which equal pairs of a sequence may join in the same round.

        All of them, unless the first join would bring up a pair of lower rank
        than the next; then only the leftmost joins now.
        """
        ok = np.ones(len(at), dtype=bool)
        again = np.concatenate(([False], seq[at[1:]] == seq[at[:-1]]))
        several = again.copy()
        several[:-1] |= again[1:]
        look = np.flatnonzero(several)
        if not len(look):
            return ok
        p, new = at[look], merged[at[look]]
        before = np.where(p > 0, sym[p - 1], -1)
        joined = np.concatenate(([False], np.diff(p) == 2))
        before = np.where(joined, new, before)
        before = np.where((p > 0) & (seq[p - 1] == seq[p]), before, -1)
        beyond = np.minimum(p + 2, len(sym) - 1)
        after = np.where((p + 2 < len(sym)) & (seq[beyond] == seq[p]), sym[beyond], -1)
        worst = np.minimum(self._rank(before, new)[0], self._rank(new, after)[0])
        bad = np.unique(seq[p[worst < rank[p]]])
        ok[again & np.isin(seq[at], bad)] = False
        return ok


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


@functools.lru_cache(maxsize=4)
def _memo(path: str) -> Memo:
    return Memo(CACHED)


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Tokens of whole texts; null and empty texts have none."""
    model, memo = counter(path), _memo(path)
    memo.room()
    words = [model.pre_tokens(t) for t in texts]
    new = [w for w in set(itertools.chain.from_iterable(words)) if w not in memo]
    long = {}
    for w, n in zip(new, model.count(new).tolist()):
        (memo if len(w) <= CACHED_CHARS else long)[w] = n
    if long:
        return [sum(memo[w] if w in memo else long[w] for w in row) for row in words]
    return [sum(map(memo.__getitem__, row)) for row in words]


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    Tokens as the piece model gives them for the whole text without begin, end
    or special tokens (their strings in a text are text). Null and empty texts
    have 0 bytes and 0 tokens. Null ids, ties and repeated rows stay, an empty
    table gives no rows; other columns are not read.
    """
    def work(ids, texts):
        counts = count_texts(texts, model_path)
        return (ids, [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts],
                counts, [n > limit for n in counts])

    return map_rows(keyed_texts(df, id_col, text_col), work,
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
