"""Hashed word shingles of whole texts, computed over the bytes of a batch at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS = 5

_U = np.uint64
_RANDOM = np.random.default_rng(0x5EED)
#: A random number for each byte value, equal for A-Z and a-z.
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=_U)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = int(_RANDOM.integers(0, 2**63)) * 2 + 1
_PLACE = _RANDOM.integers(0, 2**63, WORDS, dtype=_U) * _U(2) + _U(1)
_LENGTH = _RANDOM.integers(0, 2**64, dtype=_U)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; distinct numbers stay distinct."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    inverse = pow(_BASE, -1, 2**64)
    both = []
    for base in (_BASE, inverse):
        factors = np.full(size, base, _U)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the row that each is from. Null texts have none."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    size = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(size + 1, bool)  # a text begins or ends before this byte
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:size]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:size]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    powers, inverse = _powers(1 << max(20, (size - 1).bit_length()))
    sums = np.zeros(size + 1, _U)
    np.cumsum(_BYTE[data] * powers[:size], out=sums[1:])
    hashed = (sums[end] - sums[start]) * inverse[start]
    row = np.searchsorted(offsets, start, side="right") - 1
    return mix(hashed + (end - start).astype(_U) * _LENGTH), row


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each text: five words, or all of a shorter text; none without words."""
    hashed, row = words(texts)
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    grams = np.zeros(max(len(hashed) - WORDS + 1, 0), _U)
    for k in range(WORDS):
        grams += hashed[k : k + len(grams)] * _PLACE[k]
    grams = mix(grams)
    out = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - start >= WORDS:
            out.append(np.unique(grams[start : end - WORDS + 1]))
        elif end > start:
            few = hashed[start:end]
            out.append(mix((few * _PLACE[: len(few)]).sum(keepdims=True) + np.full(1, len(few), _U) * _LENGTH))
        else:
            out.append(np.zeros(0, _U))
    return out
