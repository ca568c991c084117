"""Fast similarity sketching of sets of 64-bit hashes.

A sketch has ``t`` coordinates. In round ``i < t`` every element falls into one hashed bin
and offers a hashed value; in round ``t + j`` every element falls into bin ``j``. A bin
keeps the least offer, earlier rounds first. The sketch is done when each bin has a value,
which round ``2t - 1`` guarantees and a large set reaches after a few rounds. Two sets
agree in a coordinate with the probability of their Jaccard similarity, and the share of
agreeing coordinates concentrates about it as with ``t`` independent permutations.
"""

from __future__ import annotations

import numpy as np

from txnstar.llm.words import mix64, seeds64

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 56) - 1)
SALT = 20170


def fast_sketches(hashes: np.ndarray, owner: np.ndarray, n_sets: int, t: int) -> np.ndarray:
    """``(n_sets, t)`` coordinates; ``owner[i]`` is the set of ``hashes[i]``.

    ``t`` is a power of two up to 128. A set without elements keeps ``EMPTY`` throughout.
    """
    if t & (t - 1) or not 2 <= t <= 128:
        raise ValueError("t must be a power of two from 2 to 128")
    shift = np.uint64(64 - (t.bit_length() - 1))
    flat = np.full(n_sets * t, EMPTY, np.uint64)
    seeds = seeds64(2 * t, SALT)
    owner = owner.astype(np.int64)
    for i in range(2 * t):
        x = mix64(hashes ^ seeds[i])
        bins = (x >> shift).astype(np.int64) if i < t else np.int64(i - t)
        np.minimum.at(flat, owner * t + bins, (x & _LOW) | np.uint64(i << 56))
        open_sets = (flat.reshape(n_sets, t) == EMPTY).any(axis=1)
        left = open_sets[owner]
        if not left.any():
            break
        hashes, owner = hashes[left], owner[left]
    return flat.reshape(n_sets, t)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates, different for each band."""
    n, t = sketches.shape
    bands = t // rows
    keys = np.broadcast_to(seeds64(bands, SALT + 1), (n, bands)).copy()
    for j in range(rows):
        keys = mix64(keys ^ sketches[:, j : bands * rows : rows]) + np.uint64(j + 1)
    return keys
