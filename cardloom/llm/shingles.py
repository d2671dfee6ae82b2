"""Hashed runs of words, and the majority of their bits."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
_CHUNK = 1 << 16


def hashes_of(text: str | None, shingle: int) -> np.ndarray:
    """64-bit hashes of the runs of shingle words in order, repeats included; of all words where there are fewer, none without words.

    Words are runs of anything but ASCII white space, after lower-casing A-Z.
    """
    found = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the ASCII white space
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(found) - shingle + 1)
    starts = (ends - lengths)[:n].tolist()
    ends = ends[min(shingle, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts, ends)), np.uint64, n)


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit; bytes of eight counters are added at once, 255 rows at most."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        lanes = np.unpackbits(hashes[at : at + _CHUNK].astype("<u8").view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        total += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def majority(hashes: np.ndarray) -> int:
    """The unsigned 64-bit word whose bits are those that more than half of the hashes have; zero without hashes."""
    return int(np.packbits((2 * ones(hashes) > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])
