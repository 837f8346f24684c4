"""Word shingles of whole texts as 64-bit hashes, computed for a batch of texts at once with numpy."""

from __future__ import annotations

import numpy as np

from tallyspark.llm.common import LOWER, SPACE

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)   # odd, so it has an inverse modulo 2^64
_Q = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_A, _B = _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_powers: dict = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if len(_powers.get("p", ())) < n:
        n = 1 << max(16, (n - 1).bit_length())
        for name, base in (("p", _P), ("q", _Q)):
            x = np.full(n, base, _U)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that aren't white space; runs end where texts end."""
    n = len(raw)
    word = ~SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[1:] = ~word[:-1]
    after = np.empty(n, bool)
    after[:-1] = ~word[1:]
    if n:
        before[0] = after[-1] = True
    return np.flatnonzero(word & (before | cut[:-1])), np.flatnonzero(word & (after | cut[1:])) + 1


def range_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range."""
    p, q = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * p[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * q[starts])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin (one more at the end).

    Words are lower-cased (A-Z). A text with fewer words than a shingle has its whole sequence as one.
    """
    n = len(offsets) - 1
    s, e = word_bounds(raw, offsets)
    h = range_hash(LOWER[raw], s, e)
    doc = np.searchsorted(offsets, s, "right") - 1
    count = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    g = h * _A
    for k in range(1, words):
        g[:len(h) - k] = (g[:len(h) - k] ^ (g[:len(h) - k] >> _U(31))) * _B + h[k:] * _A
    full = np.zeros(len(h), bool)
    if len(h) >= words:
        full[:len(h) - words + 1] = doc[words - 1:] == doc[:len(h) - words + 1]
    for d in np.flatnonzero((count > 0) & (count < words)):   # short texts
        x = count[d:d + 1].astype(_U)
        for i in range(first[d], first[d + 1]):
            x = (x ^ (x >> _U(31))) * _B + h[i:i + 1]
        full[first[d]], g[first[d]] = True, x[0]
    g, doc = mix(g[full]), doc[full]
    at = np.searchsorted(doc, np.arange(n + 1))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        g[a:b].sort()
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[keep], doc[keep]
    return g, np.searchsorted(doc, np.arange(n + 1))
