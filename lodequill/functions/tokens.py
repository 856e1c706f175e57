"""Token counters: any callable from text to a number."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import numpy as np

TokenCounter = Callable[[str], int]
_TOKEN = re.compile(r"[^\W_]+|[^\w \t\n\x0b\f\r]|_")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
SHORT = 200  # characters up to which a pattern is faster than arrays


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0 white space, 1 letter or digit, 2 a token of its own, 3 an apostrophe."""
    points = np.arange(0x110000, dtype=np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    kinds = np.full(0x110000, 2, np.uint8)
    kinds[[ord(c) for c in " \t\n\x0b\f\r"]] = 0
    for m in re.finditer(r"[^\W_]+", points):
        kinds[m.start() : m.end()] = 1
    kinds[[ord(c) for c in "'’"]] = 3
    return kinds


def _kinds_of(text: str) -> np.ndarray:
    return _kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def default_counter(text: str) -> int:
    """The deterministic offline counter, the same as `text.token_count`."""
    if len(text) <= SHORT:
        return len(_TOKEN.findall(text))
    kinds = _kinds_of(text)
    inside = kinds == 1
    return int(np.count_nonzero(kinds > 1) + np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[0])


def apostrophe_words(text: str) -> int:
    """How many words a text has, those joined by an apostrophe taken in pairs."""
    if len(text) <= SHORT:
        return len(_WORD.findall(text))
    kinds = _kinds_of(text)
    inside = np.concatenate([[False], kinds == 1, [False]])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    joined = (starts[1:] == ends[:-1] + 1) & (kinds[ends[:-1]] == 3) if len(starts) > 1 else np.zeros(0, bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
    return len(starts) - int(((edges[1::2] - edges[::2] + 1) // 2).sum())  # n joints in a row: n + 1 words by twos


def words_counter(text: str) -> int:
    return len(text.split())


# Tokens never cross white space: counts of texts add up when these are joined by it.
default_counter.additive = words_counter.additive = True


def tiktoken_counter(name: str = "cl100k_base") -> TokenCounter:
    """The library's counter. Where the library or its vocabulary is missing,
    this raises; a caller who wants the offline counter says so."""
    import tiktoken

    encoding = tiktoken.get_encoding(name)
    return lambda text: len(encoding.encode_ordinary(text)) if text.strip() else 0
