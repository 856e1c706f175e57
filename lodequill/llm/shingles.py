"""Word shingles and b-bit MinHash signatures over Arrow's UTF-8 buffers."""

from __future__ import annotations

import numpy as np

from .common import mix64

_P = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        p = np.full(max(n, 1 << 20), base, np.uint64)
        p[0] = 1
        _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers[name][:n]


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word, and where each text's words
    start among them (texts + 1). Texts are raw[offs[i]:offs[i + 1]]."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _power("p", _P, n), out=sums[1:], dtype=np.uint64)
    words = mix64((sums[ends] - sums[starts]) * _power("inv", _INV, n)[starts])
    return words, np.searchsorted(starts, offs)


def shingle_sets(raw: np.ndarray, offs: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: k words each, or all of
    a shorter text's words as one."""
    words, at = word_hashes(raw, offs)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    mult = [mix64(np.array([j + 1], np.uint64))[0] | np.uint64(1) for j in range(k)]
    for j in range(k):
        rolled += words[j : j + len(rolled)] * mult[j]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            out.append(mix64(sum((words[a + j : a + j + 1] * mult[j] for j in range(b - a)), np.array([b - a], np.uint64))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a shingle set."""
    a = np.add.reduce(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    b = np.add.reduce(mix64(s + np.uint64(0x3C6EF372FE94F82B)), dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def signatures(sets: list[np.ndarray], k: int, seed: int = 1) -> np.ndarray:
    """k components of 16 bits of each (non-empty) set's MinHash."""
    r = np.random.default_rng(seed)
    mult = r.integers(0, 1 << 32, k, dtype=np.uint32) | np.uint32(1)
    add = r.integers(0, 1 << 32, k, dtype=np.uint32)
    out = np.zeros((len(sets), k), np.uint16)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    x = (flat >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]) if sets else np.zeros(0, np.int64)
    for i in range(k):
        low = np.minimum.reduceat(x * mult[i] + add[i], at)
        low = (low ^ (low >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out[:, i] = ((low ^ (low >> np.uint32(12))) * np.uint32(0x297A2D39)) >> np.uint32(16)
    return out
