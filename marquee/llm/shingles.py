"""Distinct word shingles of a text as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from marquee.llm.common import ASCII_LOWER

_BLOCK = 1 << 15            # words hashed at a time, so a long text needs no long arrays
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if _powers["n"] < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; with fewer words (but
    not none), the whole sequence is one shingle."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    k = min(k, len(w))
    out = []
    for at in range(0, len(w) - k + 1, _BLOCK):
        b = np.frombuffer(b" ".join(w[at:at + _BLOCK + k - 1]), np.uint8)
        up, down = _tables(len(b) + 1)
        total = np.append(np.uint64(0), np.cumsum(_BYTES[b] * up[:-1], dtype=np.uint64))
        space = np.flatnonzero(b == 32)
        first, last = np.append(0, space + 1), np.append(space, len(b))
        s, e = first[:len(first) - k + 1], last[k - 1:]
        out.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
    return np.unique(np.concatenate(out))


def exact_shingles(text: str | None, k: int) -> set:
    """The shingles themselves, for exact comparison."""
    w = words(text)
    k = min(k, len(w))
    return set(zip(*(w[i:] for i in range(k)))) if k else set()
