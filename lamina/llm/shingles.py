"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

from lamina.llm.units import Remembered

SHINGLE = 5


def _hash_word(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class Shingler:
    """Texts to sorted distinct hashes of their word shingles."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.of_word = size, Remembered(_hash_word, 500_000)

    def shingles(self, text: str) -> np.ndarray:
        """One hash per distinct run of ``size`` words; with fewer words the whole sequence
        is one; no words, no hashes. A-Z count as lower case."""
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.of_word.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(words))
        count = len(words) - n + 1
        mixed = np.full(count, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ hashes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)
