"""Sets of word shingles and similarity sketches of them."""

from __future__ import annotations

import numpy as np

from ebbtide.llm.words import gram_hashes, mixed, word_hashes

COORDINATES = 256
_BIN_SHIFT = np.uint64(56)  # the upper byte of a hash picks one of 256 bins
_VALUE = np.uint64((1 << 55) - 1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of a shorter text, of all its words as one."""
    hashes = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    return np.unique(gram_hashes(hashes, min(words, len(hashes))) if len(hashes) else hashes)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` 16-bit numbers for each non-empty set.

    Fast similarity sketching: in round r every element is hashed to one bin with a value that ranks
    after all values of earlier rounds, and each bin keeps its smallest. As many rounds as bins deal
    at random; in as many more, round by round, every element goes to one given bin. So every
    coordinate is filled, mostly within two rounds, and two sets agree in a coordinate with
    probability equal to their similarity, as concentrated as for independent hashes.
    """
    t = COORDINATES
    low = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for r in range(2 * t):
        if not len(values):
            break
        h = mixed(values + np.uint64((r + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        bins = (h >> _BIN_SHIFT).astype(np.int64) if r < t else r - t
        # 9 bits for the round, 55 for the rank within it
        np.minimum.at(low, owner * t + bins, (h & _VALUE) | (np.uint64(r) << np.uint64(55)))
        empty = (low.reshape(-1, t) == np.iinfo(np.uint64).max).any(1)
        more = empty[owner]
        values, owner = values[more], owner[more]
    return mixed(low).astype(np.uint16).reshape(-1, t)
