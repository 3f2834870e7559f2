"""Byte-level BPE ids of whole texts, with a cache of the words seen by a Python worker.

Added tokens of the vocabulary are cut out of a text first, as its own tokenizer does.
"""

from __future__ import annotations

import json
import re
from array import array

# Fixed value: how the byte-level vocabulary splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 250_000

# A single space between two other characters always begins a token; anything else needs the whole text.
_IRREGULAR = re.compile(r"\A | \Z|\s | \s")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for themselves,
    the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to those of the vocabulary's own tokenizer."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        letters, special = byte_letters(), {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        if any(t[k] for t in vocabulary["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only added tokens that are matched as they stand are supported")
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary["model"]["vocab"].items() if word not in special}
        encode = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        class Cache(dict):
            def __init__(self, before: str):
                self.before = before

            def __missing__(self, word: str) -> bytes:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                ids = self[word] = array("I", encode(self.before + word)).tobytes()
                return ids

        self._whole = lambda text: array("I", encode(text)).tobytes()
        self._first, self._next = Cache(""), Cache(" ")
        self._special = {content: array("I", [i]).tobytes() for content, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self._cuts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(content in text for content in self._special):
            # every second part is an added token
            parts = enumerate(self._cuts.split(text))
            return b"".join(self._special[part] if i % 2 else self._plain(part) for i, part in parts if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _IRREGULAR.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return self._first[first] + b"".join(map(self._next.__getitem__, rest))


_known: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and worker process."""
    if path not in _known:
        _known[path] = Encoder(path)
    return _known[path]
