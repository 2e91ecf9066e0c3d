"""Simple-8b: unsigned integers packed into 64-bit words, coded and decoded as numpy arrays.

The high four bits of a word select how many values it holds and how wide each is
(``LANES``); the values follow from the low bits up. Two selectors stand for runs of
zeros. A value that leaves no room in 60 bits is an escape: the widest lane holds only
ones, and the value itself stands in the escapes of its block. Values are coded in
blocks of ``BLOCK``; each word belongs to one block, so that blocks can be decoded alone
and many of them at once. Coding is greedy: a word takes as many values as fit.

Edge cases: no values give no words; a block may be shorter than ``BLOCK``, and then the
lanes of its last word that lie beyond the block are zero.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Fixed values of the format: values in a word, and bits of each, by selector.
LANES = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))

BLOCK = 1024
COUNTS = np.array([n for n, _ in LANES])
ESCAPE = np.uint64(2**60 - 1)
_WIDTH = np.array([w for _, w in LANES], np.uint8)
_NARROW = np.concatenate(([0], np.ceil(np.log2(np.arange(1, 2**16) + 0.5)))).astype(np.uint8)


class Coded(NamedTuple):
    words: np.ndarray  #: uint64, of all blocks in order
    escapes: np.ndarray  #: uint64, likewise
    n_words: np.ndarray  #: of each block
    n_escapes: np.ndarray  #: of each block


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits that each value takes; 60 for an escape."""
    out = _NARROW[np.minimum(values, 2**16 - 1)]
    large = np.flatnonzero(values >= 2**16)
    if len(large):
        v = values.ravel()[large]
        n = np.full(len(v), 16, np.uint8)
        for k in range(16, 60):
            n[v >= np.uint64(1 << k)] = k + 1
        out.ravel()[large] = np.minimum(n, 60)
    return out


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place the selector of the word that would begin there. ``bits`` has 240 columns of zeros at its right."""
    wide = bits.shape[1] - 240
    best = np.full((len(bits), wide), len(LANES) - 1, np.uint8)
    most, reach = bits, 1  # most[i] is the greatest of reach places from i
    for k in range(len(LANES) - 2, -1, -1):
        n, w = LANES[k]
        while reach < n:
            step = min(reach, n - reach)
            most = np.maximum(most[:, : most.shape[1] - step], most[:, step:])
            reach += step
        best -= (most[:, :wide] <= w).view(np.uint8)  # what fits in narrow lanes fits in all wider ones
    return best


def encode(values: np.ndarray) -> Coded:
    """``values`` (unsigned, whole blocks but for the last one) as words."""
    if not len(values):
        none = np.empty(0, np.uint64)
        return Coded(none, none, np.empty(0, np.int64), np.empty(0, np.int64))
    blocks = -(-len(values) // BLOCK)
    size = np.full(blocks, BLOCK)
    size[-1] = len(values) - BLOCK * (blocks - 1)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[: len(values)] = values
    padded = np.concatenate([padded.reshape(blocks, BLOCK), np.zeros((blocks, 240), np.uint64)], 1)
    escaped = padded >= ESCAPE
    escapes = padded[escaped]
    n_escapes = escaped.sum(1)
    if len(escapes):
        padded[escaped] = ESCAPE
    best = _selectors(_bits(padded))

    begins = np.zeros((blocks, BLOCK), bool)
    row, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(row):
        begins[row, at] = True
        at = at + COUNTS[best[row, at]]
        inside = at < size[row]
        row, at = row[inside], at[inside]
    row, at = np.nonzero(begins)
    chosen = best[row, at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, first = padded.ravel(), row * padded.shape[1] + at
    for k in np.unique(chosen):
        n, w = LANES[k]
        if w:
            here = np.flatnonzero(chosen == k)
            own, at = words[here], first[here]
            for lane in range(n):
                own |= flat[at + lane] << np.uint64(lane * w)
            words[here] = own
    return Coded(words, escapes, np.bincount(row, minlength=blocks), n_escapes)


def decode(words: np.ndarray, escapes: np.ndarray, n_words: np.ndarray, n_values: np.ndarray) -> np.ndarray:
    """The values of blocks that follow each other, given the words and values of each."""
    if not len(words):
        return np.empty(0, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[chosen]
    last = np.cumsum(n_words) - 1  # of each block, the only word that may reach beyond it
    before = np.concatenate(([0], np.cumsum(count)))
    in_block = before[last + 1] - before[np.concatenate(([0], last[:-1] + 1))]
    over = in_block - n_values
    if (over < 0).any() or (over >= count[last]).any():
        raise ValueError("the words don't hold the values of their blocks")
    kept = count.copy()
    kept[last] -= over
    start = np.cumsum(kept) - kept
    total = int(n_values.sum())
    out = np.zeros(total + 240, np.uint64)
    short = np.zeros(len(words), bool)
    short[last] = over > 0
    for k in np.unique(chosen):
        n, w = LANES[k]
        if not w:
            continue  # zeros already
        mask = np.uint64((1 << w) - 1)
        here = np.flatnonzero((chosen == k) & ~short)
        own, at = words[here], start[here]
        for lane in range(n):
            out[at + lane] = (own >> np.uint64(lane * w)) & mask
        for i in np.flatnonzero((chosen == k) & short):
            lanes = np.arange(kept[i], dtype=np.uint64)
            out[start[i] : start[i] + kept[i]] = (words[i] >> lanes * np.uint64(w)) & mask
    out = out[:total]
    if len(escapes):
        out[out == ESCAPE] = escapes
    return out
