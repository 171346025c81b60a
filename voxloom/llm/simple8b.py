"""Simple-8b word-aligned coding of unsigned 32-bit ids, in blocks that are encoded and decoded side by side.

A 64-bit word is a selector of 4 bits and as many ids of one width as 60 bits hold.  The largest value of a width of two
bits or more is an escape: the id itself stands in the block's list of escapes.  At each place the word that costs the fewest
bits for an id, escapes included, is taken.  Blocks have ``BLOCK`` ids each but the last, and the words of one block follow
from its ids alone; so all blocks of an array advance together, a word each at a time.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
#: Ids in a word and bits of an id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: The least value that a slot of a width can't hold; widths under two bits have no escape.
_LEAST = np.array([1, 1, 2, *((1 << w) - 1 for w in WIDTHS[3:].tolist())], np.uint64)
_NEVER = 1 << 20
#: The bits of an escaped id.
_ESCAPE_BITS = 32


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, words of each block, escapes, escapes of each block."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = ids
    values = padded.reshape(blocks, BLOCK)
    size = np.full(blocks, BLOCK)
    if n % BLOCK:
        size[-1] = n % BLOCK
    # for every place the selector of the cheapest word there
    best, least_cost = np.zeros((blocks, BLOCK), np.int8), np.full((blocks, BLOCK), np.inf, np.float32)
    over = np.zeros((blocks, BLOCK + 1), np.int16)
    for s, (count, least) in enumerate(zip(COUNTS.tolist(), _LEAST, strict=True)):
        # ids up to each place that this width can't hold
        np.cumsum(values >= least, axis=1, out=over[:, 1:])
        escapes = np.empty((blocks, BLOCK), np.int16)
        np.subtract(over[:, count:BLOCK], over[:, : BLOCK - count], out=escapes[:, : BLOCK - count])
        np.subtract(over[:, BLOCK:], over[:, BLOCK - count : BLOCK], out=escapes[:, BLOCK - count :])
        cost = escapes * np.float32(_ESCAPE_BITS if s > 2 else _NEVER)
        cost += np.float32(64)
        cost *= (1 / np.minimum(count, BLOCK - np.arange(BLOCK))).astype(np.float32)
        cheaper = cost < least_cost
        best[cheaper] = s
        np.minimum(least_cost, cost, out=least_cost)
    selectors = np.zeros((blocks, BLOCK), np.int8)
    used = np.zeros(blocks, np.int64)
    lanes, here = np.arange(blocks), np.zeros(blocks, np.int64)
    for step in range(BLOCK):
        taken = best[lanes, here]
        selectors[lanes, step] = taken
        used[lanes] += 1
        here += COUNTS[taken]
        inside = here < size[lanes]
        lanes, here = lanes[inside], here[inside]
        if not len(lanes):
            break
    chosen = selectors[np.arange(BLOCK) < used[:, None]]
    begin = _places(chosen, used)
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat = np.r_[padded, np.zeros(COUNTS.max(), np.uint64)]
    # places past the end of a block are empty
    block_end = np.repeat(np.arange(blocks) * BLOCK + size, used)
    escaped = np.zeros(len(padded), bool)
    for s in np.unique(chosen):
        which = np.flatnonzero(chosen == s)
        place = begin[which, None] + np.arange(COUNTS[s])
        inside = place < block_end[which, None]
        got = np.where(inside, flat[np.minimum(place, len(flat) - 1)], np.uint64(0))
        if s > 2:
            big = got >= _LEAST[s]
            escaped[place[big]] = True
            got = np.where(big, _LEAST[s], got)
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        if WIDTHS[s]:
            words[which] |= np.bitwise_or.reduce(got << shifts, axis=1)
    return words, used, padded[escaped].astype(np.uint32), escaped.reshape(blocks, BLOCK).sum(axis=1)


def _places(chosen: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The place of the first id of each word: blocks begin at multiples of BLOCK."""
    counts = COUNTS[chosen]
    before = np.cumsum(counts) - counts
    first = np.repeat(np.cumsum(used) - used, used)
    return before - before[first] + np.repeat(np.arange(len(used)) * BLOCK, used) if len(used) else before


def decode(words: np.ndarray, used: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of blocks whose words and escapes follow one another."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    begin = _places(chosen, used)
    out = np.zeros(len(used) * BLOCK + int(COUNTS.max()), np.uint64)
    escaped = np.zeros(len(out), bool)
    size = np.full(len(used), BLOCK)
    if n % BLOCK:
        size[-1] = n % BLOCK
    block_end = np.repeat(np.arange(len(used)) * BLOCK + size, used)
    for s in np.unique(chosen):
        which = np.flatnonzero(chosen == s)
        place = begin[which, None] + np.arange(COUNTS[s])
        if not WIDTHS[s]:
            continue
        shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        got = (words[which, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
        inside = place < block_end[which, None]
        out[place[inside]] = got[inside]
        if s > 2:
            escaped[place[inside & (got == _LEAST[s])]] = True
    out[escaped] = escapes
    return out[:n].astype("<u4")
