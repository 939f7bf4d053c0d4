"""Words of texts as 64-bit hashes, by table lookups on UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))
#: ASCII bytes other than digits and letters become blanks, for words of digits, letters and non-ASCII.
ALNUM = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


class WordHashes(dict):
    """Word to 64-bit hash; a cache that starts afresh beyond ``most`` words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 48:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def blank_words(text: str | None) -> list[bytes]:
    """Runs of anything but blanks (U+0009-000D, U+0020), with A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters and non-ASCII characters, with A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(ALNUM).split()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalises 64-bit hashes (the constants are those of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; empty if there are fewer."""
    k = len(words) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = np.full(k, n, np.uint64)
    for i in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out = mix(out + words[i : i + k])
    return out
