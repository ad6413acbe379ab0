"""Word and shingle hashes of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: bytes of text that are hashed in one go: the arrays of a step take some 35 times as many
HASHED_BYTES = 512 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODES = np.random.RandomState(20240229).randint(1, 2 ** 62, 256).astype(np.uint64)
_STEPS = np.random.RandomState(20240301).randint(1, 2 ** 62, 64).astype(np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly (the finalizer of a common hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (nulls empty) and its offsets."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (a run of bytes other than ASCII white
    space; A-Z as a-z if ``lower``) of all texts, and where each text's begin."""
    n_texts = len(offsets) - 1
    kept = np.flatnonzero(~_SPACE[data])
    if not len(kept):
        return np.zeros(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    fresh = np.empty(len(kept), bool)
    fresh[0] = True
    np.not_equal(kept[1:], kept[:-1] + 1, out=fresh[1:])
    at = np.searchsorted(kept, offsets[:-1])
    fresh[at[at < len(kept)]] = True
    starts = np.flatnonzero(fresh)
    lengths = np.diff(np.append(starts, len(kept)))
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()), _BASE)]), dtype=np.uint64)
    letters = data[kept]
    values = _CODES[_LOWER[letters] if lower else letters] * powers[place]
    hashes = mixed(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(starts, np.searchsorted(kept, offsets))


def shingle_sets(hashes: np.ndarray, begins: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``k``
    words; a text of fewer words has one, of all its words; without words none."""
    if len(hashes) >= k:
        joint = np.zeros(len(hashes) - k + 1, np.uint64)
        for i in range(k):
            joint += mixed(hashes[i:len(hashes) - k + 1 + i] * _STEPS[i])
        joint = mixed(joint)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(joint[a:b - k + 1]))
        elif b > a:
            few = sum((mixed(hashes[a + i:a + i + 1] * _STEPS[i]) for i in range(b - a)), np.zeros(1, np.uint64))
            out.append(mixed(few + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
