"""Word and shingle hashes of whole texts, computed over byte arrays."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ONE = np.uint64(1)
#: Bytes that one vectorised step hashes at once.
_STEP = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x5851F42D4C957F2D)
_BACK = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _STEP + 1), _powers(_BACK, _STEP + 1)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs free of ASCII white space, A-Z lowered) of a text."""
    out, at = [], 0
    data = np.frombuffer(raw, np.uint8)
    while at < len(data):
        end = min(at + _STEP, len(data))
        if end < len(data):  # end at a space; a longer word takes a longer step
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        out.append(_word_hashes(data[at:end]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _word_hashes(b: np.ndarray) -> np.ndarray:
    space = _SPACE[b]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up = _UP if len(b) <= _STEP else _powers(_BASE, len(b))
    down = _DOWN if len(b) <= _STEP else _powers(_BACK, len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[_LOWER[b]] * up[:len(b)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; order within a run counts."""
    m = len(words) - n + 1
    total = np.zeros(max(m, 0), np.uint64)
    for i in range(n):
        total = total * _BASE + words[i:i + len(total)]
    return mix(total + np.uint64(n))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles; of all its words as one if it has fewer."""
    words = word_hashes(text.encode()) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    return np.unique(windows(words, min(n, len(words))))
