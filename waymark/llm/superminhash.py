"""SuperMinHash signatures, vectorised over the elements of many sets at once."""

from __future__ import annotations

import numpy as np

from waymark.llm.textbytes import U64, mix

_STEP = 0x9E3779B97F4A7C15
_LOW = U64(0xFFFFFFFF)


def _draw(x: np.ndarray, level: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """A rank in [level, level + 1), in units of 2**-32, and a swap partner in [level, m)."""
    z = mix(x + U64(_STEP * (level + 1) & 0xFFFFFFFFFFFFFFFF))
    return (z & _LOW) | (U64(level) << U64(32)), level + (((z >> U64(32)) * U64(m - level)) >> U64(32)).astype(np.int64)


def signatures(elements: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """One row of m ranks for each set elements[offsets[i]:offsets[i + 1]]; equal slots estimate the Jaccard index.

    Element x gets one random permutation of the m slots, drawn a swap at a time, and the rank
    of slot p(j) is j plus a fraction: the ranks of an element are correlated, hence the lower
    variance. Levels j run over all elements together; once every slot of a set is below j + 1
    no later level can change it, so its elements stop there. An empty set keeps the largest value.
    """
    if m > 256:
        raise ValueError("at most 256 slots")
    sets = len(offsets) - 1
    out = np.full((sets, m), ~U64(0), dtype=np.uint64)
    flat = out.reshape(-1)
    of = np.repeat(np.arange(sets), np.diff(offsets))
    x = elements
    rank, slot = _draw(x, 0, m)
    np.minimum.at(flat, of * m + slot, rank)
    going = (out.max(axis=1, initial=0) >= U64(1) << U64(32)) & (np.diff(offsets) > 0)
    keep = going[of]
    x, of, slot = x[keep], of[keep], slot[keep]
    if not len(x):
        return out
    row = np.arange(len(x))
    order = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
    order[row, slot] = 0
    order[:, 0] = slot
    for level in range(1, m):
        rank, swap = _draw(x, level, m)
        slot = order[row, swap]
        order[row, swap] = order[:, level]
        np.minimum.at(flat, of * m + slot, rank)
        still = out[:, :].max(axis=1, initial=0) >= U64(level + 1) << U64(32)
        going &= still
        keep = going[of]
        n = int(keep.sum())
        if not n:
            break
        if n < 0.75 * len(x):
            x, of, order = x[keep], of[keep], order[keep]
            row = np.arange(n)
    return out
