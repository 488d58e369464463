"""Fast similarity sketches of sets of 64-bit hashes.

Round i < t throws every element into one of t bins by a hash of its own; round t + j
throws every element into bin j. A bin keeps the smallest value of the first round that
reached it. A set leaves the rounds once all its bins are filled, so a set of n elements
takes about t ln t / n rounds, every coordinate is filled after 2t rounds at the latest,
and the share of equal coordinates of two sketches is concentrated around the sets'
Jaccard similarity as with t independent minima.
"""

from __future__ import annotations

import numpy as np

from quiver.llm.common import mix64

_EMPTY = np.uint64(2 ** 64 - 1)


def similarity_sketches(flat: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """(sets, t) uint64 sketches of the sets ``flat[offsets[i]:offsets[i+1]]``; an empty
    set's row stays at the largest value."""
    sets = len(offsets) - 1
    out = np.full((sets, t), _EMPTY, np.uint64)
    cells = out.reshape(-1)
    sizes = np.diff(offsets)
    live = np.flatnonzero(sizes)
    owner = np.repeat(np.arange(sizes.size), sizes)
    values = flat
    for i in range(2 * t):
        if not len(live):
            break
        x = mix64(values + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) % 2 ** 64))
        if i < t:
            cell = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
            cell += owner * t
        else:
            cell = owner * t + (i - t)
        value = (x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(12)
        value |= np.uint64(i) << np.uint64(52)
        np.minimum.at(cells, cell, value)
        unfilled = (out[live] == _EMPTY).any(1)
        if not unfilled.all():
            live = live[unfilled]
            stay = np.zeros(sets, bool)
            stay[live] = True
            keep = stay[owner]
            owner, values = owner[keep], values[keep]
    return out


def band_keys(sketches: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands) int64 keys: equal where all rows of a band are equal (up to 64-bit
    collisions, which cost a needless check)."""
    sets, t = sketches.shape
    rows = t // bands
    part = sketches[:, : bands * rows].reshape(sets, bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (sets, bands)).copy()
    for r in range(rows):
        key = mix64(key ^ part[:, :, r])
    return key.view(np.int64)
