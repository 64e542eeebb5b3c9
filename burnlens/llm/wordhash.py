"""Words of many texts at once: starts, ends and 64-bit hashes in numpy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

#: Stretches of more bytes than this are hashed byte for byte: sums of powers modulo
#: 2**64 are equal for some pairs of long words, whatever the base.
LONG_BYTES = 256

#: Words end at these bytes (the ASCII white space).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)


_table: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers at least of the base and of its inverse modulo 2**64."""
    if len(_table[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.full(1 << max(16, int(n - 1).bit_length()), base, np.uint64)
            out[0] = 1
            _table[k] = np.cumprod(out)
    return _table[0], _table[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Sums(NamedTuple):
    """Prefix sums of a text's hash, and the text."""

    at: np.ndarray
    buf: np.ndarray


def prefix_sums(buf: np.ndarray) -> Sums:
    """Sums of ``(byte + 1) * base**i``: the polynomial hash of any stretch is a difference of two."""
    up, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=out[1:])
    return Sums(out, buf)


def stretch_hash(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]``, the same wherever the stretch stands."""
    _, down = _powers(len(sums.at))
    size = end - start
    out = mixed((sums.at[end] - sums.at[start]) * down[start] + size.astype(np.uint64) * _MIX)
    for k in np.flatnonzero(size > LONG_BYTES):
        out[k] = xxhash.xxh64_intdigest(sums.buf[start[k] : end[k]].tobytes())
    return out


def table_bounds(buf: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that ``inside`` (256 truth values) has."""
    within = np.zeros(len(buf) + 2, np.int8)
    within[1:-1] = inside[buf]
    edge = np.diff(within)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``buf``."""
    return table_bounds(buf, ~SPACE)


class HashTable:
    """Direct-mapped ``hash -> number`` table; a later entry may take an earlier one's place."""

    def __init__(self, bits: int, dtype: type = np.int32) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, dtype)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and which of them are right."""
        slot = h & self.mask
        return self.values[slot], self.keys[slot] == h

    def put(self, h: np.ndarray, number: np.ndarray) -> None:
        slot = h & self.mask
        self.keys[slot], self.values[slot] = h, number
