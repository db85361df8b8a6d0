"""64-bit hashes of words and shingles of one text, vectorised over its bytes."""

from __future__ import annotations

import re

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 18
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x09-\x0d ]")


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer (xor-shift-multiply) of 64-bit values."""
    x = x ^ (x >> U64(31))
    x *= U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(32)
    return x


_BYTES = mixed(np.arange(1, 257, dtype=U64))
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2**64, at least n of each."""
    if len(_POWERS[0]) < n:
        inverse = pow(BASE, -1, 1 << 64)
        for i, b in enumerate((BASE, inverse)):
            steps = np.full(max(n, 4096), b, U64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=U64)
    return _POWERS[0], _POWERS[1]


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of every word of a text, A-Z lower-cased; words are runs of non-white characters
    (space, 0x09-0x0D).  A word's hash is a polynomial of its bytes and its length, mixed; long
    texts go in pieces cut between words."""
    raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
    out, at = [], 0
    while at < len(raw):
        cut = len(raw)
        if cut - at > CHUNK:
            m = _SPACE.search(raw, at + CHUNK)
            cut = m.end() if m else cut
        buf = np.frombuffer(raw, np.uint8, cut - at, at)
        white = np.ones(len(buf) + 2, bool)
        white[1:-1] = _WHITE[buf]
        edge = np.flatnonzero(white[1:] != white[:-1])
        first, last = edge[::2], edge[1::2]
        if len(first):
            up, down = _powers(len(buf) + 1)
            sums = np.zeros(len(buf) + 1, U64)
            np.cumsum(_BYTES[buf] * up[:len(buf)], out=sums[1:])
            out.append(mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(U64)))
        at = cut
    return np.concatenate(out) if out else np.empty(0, U64)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words (of all words, if there are fewer), in order."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    out = np.full(n, min(k, len(words)), U64)
    for j in range(min(k, len(words))):
        out = mixed(out * U64(0x100000001B3) + words[j:j + n])
    return out
