"""Words of many texts at once: byte classes, word bounds and 64-bit word hashes as numpy arrays.

Word classes here name ASCII characters only, and every byte of a longer UTF-8 character
belongs to the same class, so cutting bytes is cutting characters. Hashes are polynomial
modulo 2**64 with a final mix; two different words collide with odds of about 2**-64 a pair.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)  # after lower-casing: digits, a-z and all beyond ASCII
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        t = np.full(size, base, dtype=U)
        t[0] = 1
        _powers[name] = have = np.multiply.accumulate(t)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all others (a bijection of 64-bit words)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes of all texts, one after another
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # words of text i are numbers first[i] to first[i + 1]

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """Hashes of data[starts[i]:ends[i]]; ``second`` asks for another, independent hash."""
    n = len(data)
    sums = np.empty(n + 1, dtype=U)
    sums[0] = 0
    np.cumsum(_VALUES[int(second)][data] * _table("powers", _BASE, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _table("inverse", _INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(U))


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    off = np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(arr.buffers()[2], dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at text bounds."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def split(arr: pa.Array, inside: np.ndarray) -> Words:
    """Words (runs of bytes with ``inside``) of every text after A-Z is lower-cased."""
    data, offsets = raw(arr)
    low = LOWER[data]
    starts, ends = runs(inside[low], offsets)
    return Words(low, offsets, starts, ends, np.searchsorted(starts, offsets))
