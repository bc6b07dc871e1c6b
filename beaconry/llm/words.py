"""Byte-level ids of the parts of texts that no tokenizer here spans, each distinct part coded once."""

from __future__ import annotations

import functools
import json
import os
import re

import tiktoken
from tokenizers import Tokenizer

from beaconry.llm.byte_bpe import byte_table

#: Characters that some tokenizer may take for white space.
WHITE = r"\s\x1c-\x1f\x85\u180e\u200b\ufeff"
RUN = re.compile(f"[{WHITE}]{{2}}")
ASCII_RUN = re.compile(r"[ \t-\r\x1c-\x1f]{2}")
CUT = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")
EDGE = re.compile(f"[{WHITE}]")
#: The split of byte-level vocabularies of this kind, as the tokenizers library has it built in.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What the faster library does not get: characters whose class may differ between the
#: libraries' tables, and long runs, on which its work grows with the square.
UNSETTLED = re.compile("[\u0250-\U0010ffff]")
LONG = 400


def parts(text: str) -> list[str]:
    """``text`` cut at every single space between two characters that are not white.

    The space itself is left out: it opens the part behind it. Byte-level
    patterns and pieces that hold spaces in front only never join across such a
    place. Longer white space stays inside a part. A text that is not empty has
    at least one part, and no part is empty.
    """
    if (ASCII_RUN if text.isascii() else RUN).search(text) or EDGE.match(text) or EDGE.match(text[-1]):
        return CUT.split(text)
    return text.split(" ")


class ByteCoder:
    """Ids that a byte-level tokenizer file gives, without added special tokens.

    Where the file's merges are in the order of their tokens' ids, texts of settled
    characters are coded by the faster of two libraries, to the same ids; all others
    by the one the file is made for. ``plain`` makes strings of added tokens ordinary text.
    """

    def __init__(self, path: str, plain: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if any(" " in t or t != t.strip() for t in added):
            raise ValueError("added tokens that hold spaces are not supported")
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        split = made["pre_tokenizer"]
        if made["normalizer"] or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"]:
            raise ValueError("only byte-level tokenizers with the built-in split are supported")
        self.added = () if plain else tuple(added)
        vocabulary = made["model"]["vocab"]
        back = {c: b for b, c in enumerate(byte_table())}
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in made["model"]["merges"]]
        self.tokens = {i: bytes([back[c] for c in t]) for t, i in vocabulary.items() if t not in added}
        in_order = merged == sorted(merged) and max(vocabulary[c] for c in back) < merged[0]
        self.fast = in_order and tiktoken.Encoding(
            "parts", pat_str=PATTERN, mergeable_ranks={t: i for i, t in self.tokens.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        out, slow = [None] * len(texts), []
        for k, t in enumerate(texts):
            if (self.fast and (t.isascii() or not UNSETTLED.search(t)) and not any(a in t for a in self.added)
                    and (len(t) < LONG or " " * LONG not in t and max(map(len, t.split(" "))) < LONG)):
                out[k] = self.fast.encode_ordinary(t)
            else:
                slow.append(k)
        for k, e in zip(slow, self.library.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False)):
            out[k] = e.ids
        return out


@functools.lru_cache(maxsize=2)
def byte_coder(path: str, plain: bool) -> ByteCoder:
    return ByteCoder(path, plain)
