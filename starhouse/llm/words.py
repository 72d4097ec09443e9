"""Words and word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_KEPT_WORDS = 200_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class _WordHashes(dict):
    """Hash of each word met lately; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def forget_words() -> None:
    """Empty the memory of hashes, at the end of a task whose worker goes on to other work."""
    _hashes.clear()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every bit."""
    for _ in range(2):
        values = (values ^ (values >> _HALF)) * _MIX
    return values ^ (values >> _HALF)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per ``width`` consecutive words, in order; none if there are fewer words."""
    count = len(hashes) - width + 1
    if count < 1:
        return np.empty(0, np.uint64)
    found = np.full(count, width, np.uint64)
    for i in range(width):
        found = found * _MULTIPLIER + hashes[i:i + count]
    return mixed(found)


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, no words give none."""
    return np.unique(window_hashes(word_hashes(words), max(1, min(width, len(words)))))
