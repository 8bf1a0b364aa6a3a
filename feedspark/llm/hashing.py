"""Vectorised hashes of words and shingles over UTF-8 bytes (numpy, inside
tasks)."""
from __future__ import annotations

import numpy as np

_U = np.uint64
# Multipliers of a 64-bit finaliser and of the polynomial.
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# bytes hashed at once, so that memory does not follow the longest text
PIECE = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


# a weight for each word of a shingle, so for shingles of at most so many words
_SHINGLE = mix(np.arange(1, 65, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the polynomial's base and of its inverse."""
    return [np.multiply.accumulate(np.concatenate(([_U(1)], np.full(n - 1, b, dtype=_U)))) for b in (_BASE, _INVERSE)]


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = powers(max(n, PIECE + 1))
    return _powers


def _words_of_piece(data: np.ndarray) -> np.ndarray:
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    up, down = _power_tables(len(data) + 1)
    total = np.concatenate(([_U(0)], np.cumsum(_BYTE[_LOWER[data]] * up[: len(data)], dtype=_U)))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z as a-z, in order."""
    if len(text) <= PIECE:
        return _words_of_piece(np.frombuffer(text, dtype=np.uint8)) if text else np.empty(0, dtype=_U)
    data, out, at = np.frombuffer(text, dtype=np.uint8), [], 0
    while at < len(data):
        to = min(at + PIECE, len(data))
        if to < len(data):  # end the piece at a blank; a word longer than a piece stays whole
            while to < len(data) and not _BLANK[data[to]]:
                to += 1
        out.append(_words_of_piece(data[at:to]))
        at = to
    return np.concatenate(out)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's ``size``-word shingles; with fewer
    words the whole sequence is one; without words none."""
    w = word_hashes(text or b"")
    if not len(w):
        return w
    n = len(w) - size + 1
    if n < 1:
        return mix(np.cumsum(w * _SHINGLE[: len(w)], dtype=_U)[-1:] + _U(len(w)))
    total = np.zeros(n, dtype=_U)
    for i in range(size):
        total += w[i : i + n] * _SHINGLE[i]
    return np.unique(mix(total))
