"""Vectorised text kernels that the batch operators of this subpackage share.

A batch of texts is handled as one UTF-8 buffer.  Words are the maximal runs of
bytes outside ``0x20`` and ``0x09-0x0D``; those bytes never occur inside a
multi-byte UTF-8 sequence, so splitting bytes equals splitting code points.
All names are 64-bit fingerprints computed from content only, hence equal on
every executor and stable when a lost task is run again.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1


def trim() -> None:
    """Gives freed memory back to the system: Python workers live on between stages and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    have = 1
    while have < n:
        step = U64(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step
        have += more
    return out


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


_bytes_powers, _words_powers = _Powers(_BASE), _Powers(_WORD_BASE)
_second_powers = _Powers(0xC2B2AE3D27D4EB4F | 1)
#: Random-looking 64-bit values for each byte, made by rule: of first and of second names.
_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_SECOND_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x8EBC6AF09C88C6E3))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
#: Bytes hashed at a time, so that a text of any length needs bounded scratch space.
_CHUNK = 1 << 20


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (starts, ends) of the words of one UTF-8 buffer."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~_IS_SPACE[data]
    edges = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, second: bool = False) -> np.ndarray:
    """A 64-bit name for each word, a function of its bytes alone; ``second`` names are independent of the others."""
    powers, values = (_second_powers, _SECOND_VALUES) if second else (_bytes_powers, _BYTE_VALUES)
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        part = data[base : int(ends[stop - 1])]
        if lower:
            part = _ASCII_LOWER[part]
        up, down = powers.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * up[1:], out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * U64(0xE7037ED1A0B428DB))
        at = stop
    return out


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit name for each ``width`` consecutive words; empty with fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = _words_powers.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(mix(words) * up[1:], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def sequence_hash(words: np.ndarray) -> int:
    """A 64-bit name for a whole word sequence, told from window names by its length."""
    up, _ = _words_powers.get(len(words) + 1)
    size = np.array([len(words)], U64) * U64(0x8EBC6AF09C88C6E3)
    return int(mix(np.cumsum(mix(words) * up[1:])[-1:] + size)[0]) if len(words) else int(mix(size)[0])
