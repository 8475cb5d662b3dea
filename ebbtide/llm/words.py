"""64-bit hashes of words and of runs of words, computed in bulk."""

from __future__ import annotations

import numpy as np
import xxhash

from ebbtide.llm.worker import kept

SPAN = 1 << 20
MEMO_WORDS = 400_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h


def _spans(data: bytes):
    """``data`` cut before white space into parts of about a megabyte, so that no word is cut."""
    start = 0
    while len(data) - start > SPAN:
        end = start + SPAN
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words between white space (space and bytes 9 to 13), in order."""
    known, found = kept("words", _Memo).__getitem__, []
    for part in _spans(data):
        words = part.split()
        found.append(np.fromiter(map(known, words), np.uint64, len(words)))
    return found[0] if len(found) == 1 else np.concatenate(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words; none if there are fewer."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    h = np.full(size, n, np.uint64)
    for i in range(n):
        h *= _PRIME
        h += words[i : i + size]
    return mixed(h)


def hashed(words: list[bytes]) -> np.ndarray:
    """Hashes of words that are cut already."""
    return np.fromiter(map(kept("words", _Memo).__getitem__, words), np.uint64, len(words))
