"""Simple-8b: as many small numbers in a 64-bit word as its widest one allows.

The low four bits of a word, its selector, name a row of ``SELECTORS``: how many numbers of how many bits the other 60
bits hold. Numbers of more than 60 bits don't fit: they are stored as 0 and listed as escapes (place, value) beside
the words. The last word of a run is filled with zeros, so the count of numbers is kept beside it, too.

Both directions work on whole arrays: the widest number of every window decides each place's best selector, and a
run of words is unpacked selector by selector.
"""

from __future__ import annotations

import numpy as np

# Fixed values: (numbers in a word, bits of each).
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
             (3, 20), (2, 30), (1, 60)]
COUNTS = np.array([n for n, _ in SELECTORS])


def _all_in_window(ok: np.ndarray, size: int) -> np.ndarray:
    """Whether ``ok`` holds for ``size`` places from each on; places after the end hold."""
    n = len(ok)
    run = np.concatenate((ok, np.ones(size, bool)))
    done = 1
    while done < size:
        step = min(done, size - done)
        run[:-step] &= run[step:]
        done += step
    return run[:n]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of an array of uint64; escapes has a row (place, value) per number of 2**60 or more."""
    values = np.asarray(values, np.uint64)
    places = np.flatnonzero(values >> np.uint64(60))
    escapes = np.stack((places.astype(np.uint64), values[places]), axis=1)
    if len(places):
        values = values.copy()
        values[places] = 0
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), escapes
    best = np.full(n, len(SELECTORS) - 1, np.uint8)
    widest = int(values.max()).bit_length()
    narrow = values.astype(np.uint32) if widest <= 32 else values
    for k in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[k]
        if bits >= widest:
            best[:] = k
            continue
        fits = narrow < narrow.dtype.type(1 << bits)
        if not fits.any():
            break
        best[_all_in_window(fits, count)] = k
    steps = COUNTS[best].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = best[starts]
    padded = np.concatenate((values, np.zeros(COUNTS[0], np.uint64)))
    words = chosen.astype(np.uint64)
    for k in np.unique(chosen):
        count, bits = SELECTORS[k]
        rows = np.flatnonzero(chosen == k)
        for j in range(count if bits else 0):
            words[rows] |= padded[starts[rows] + j] << np.uint64(4 + j * bits)
    return words, escapes


def unpack(words: np.ndarray, n: int, escapes: np.ndarray) -> np.ndarray:
    """The ``n`` numbers in ``words``, as uint64."""
    chosen = (words & np.uint64(15)).astype(np.intp)
    counts = COUNTS[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    if not n <= len(out) < n + COUNTS[0]:
        raise ValueError("words don't hold as many numbers as stated")
    for k in np.unique(chosen):
        count, bits = SELECTORS[k]
        rows = np.flatnonzero(chosen == k)
        mask = np.uint64((1 << bits) - 1)
        for j in range(count if bits else 0):
            out[starts[rows] + j] = (words[rows] >> np.uint64(4 + j * bits)) & mask
    out = out[:n]
    if len(escapes):
        out[escapes[:, 0].astype(np.intp)] = escapes[:, 1]
    return out
