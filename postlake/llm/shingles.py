"""Word shingle sets of many texts at once, as sorted 64-bit hashes.

Words are runs of characters other than ASCII white space, with A-Z lower-cased.  A set
holds the distinct hashes of a text's runs of ``width`` words; a text with fewer words has
one for its whole sequence, a text without words none.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 19  # bytes hashed at once
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the index of its text."""
    data = b"\n".join(texts) + b"\n"
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, owners = [], []
    at = 0
    powers = np.cumprod(np.full(PIECE + 1, BASE, dtype=np.uint64))
    inverses = np.cumprod(np.full(PIECE + 1, INVERSE, dtype=np.uint64))
    while at < len(data):
        stop = at + PIECE
        if stop < len(data):  # after the last white space of the piece, or the next one
            cut = max(data.rfind(c, at, stop) for c in (b" ", b"\n"))
            if cut < 0:
                cut = min(x for x in (data.find(b" ", stop), data.find(b"\n", stop)) if x >= 0)
            stop = cut + 1
        a = np.frombuffer(data, dtype=np.uint8, count=min(stop, len(data)) - at, offset=at)
        if len(a) > len(powers):
            powers = np.cumprod(np.full(len(a) + 1, BASE, dtype=np.uint64))
            inverses = np.cumprod(np.full(len(a) + 1, INVERSE, dtype=np.uint64))
        space = (a == 32) | ((a >= 9) & (a <= 13))
        edge = np.diff(np.concatenate([[1], space.view(np.int8), [1]]))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(1)) * powers[:len(a)])])
        h = (sums[last] - sums[first]) * inverses[first]
        hashes.append(mixed(h + (last - first).astype(np.uint64)))
        owners.append(np.searchsorted(ends, at + first, side="right"))
        at = min(stop, len(data))
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All sets one after the other, each sorted, and where each begins (one more at the end)."""
    h, owner = word_hashes([t.lower() for t in texts])
    n = len(h)
    counts = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(counts) - counts
    place = np.arange(n) - begins[owner]
    run = np.zeros(n, dtype=np.uint64)
    short = (counts > 0) & (counts < width)
    for i in range(width):
        part = np.zeros(n, dtype=np.uint64)
        part[:max(0, n - i)] = h[i:]
        inside = place + i < counts[owner]
        run = np.where(inside, mixed(run + part + np.uint64(i + 1)), run)
    whole = (place + width <= counts[owner]) | (short[owner] & (place == 0))
    run, owner = run[whole], owner[whole]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    run, owner = run[new], owner[new]
    return run, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
