"""A minimal perfect hash over distinct 64-bit keys, with arrays beside it, in numpy.

Levels of bitmaps (Limasset et al. 2017): a key that is alone on its bit of a level stays there,
the others go on to the next level. A key's slot is the rank of its bit, so n keys get the slots
0..n-1. A key that was not built in gets some slot or none; a stored fingerprint tells.
"""

from __future__ import annotations

import numpy as np

SPREAD = 2.0
LEVELS = 64


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(bits)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the levels, all levels' bits) for distinct uint64 keys."""
    sizes, levels = [], []
    while len(keys):
        if len(sizes) == LEVELS:
            raise ValueError("keys are not distinct")
        bits = max(64, int(SPREAD * len(keys)))
        at = _places(keys, len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        levels.append(alone)
        keys = keys[~alone[at]]
    return np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool)


def slots(keys: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for a key that no level holds."""
    ranks = np.cumsum(bits) - 1
    found = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + _places(keys[open_], level, int(size))
        hit = bits[at]
        found[open_[hit]] = ranks[at[hit]]
        open_, base = open_[~hit], base + int(size)
    return found
