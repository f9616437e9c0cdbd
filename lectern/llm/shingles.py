"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers that mix word hashes; fixed so that all runs agree.
MIX = np.uint64(0x9E3779B97F4A7C15)
END = 0xC2B2AE3D27D4EB4F


def split_words(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased; bytes.split() takes exactly ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle, none give none."""
    h = word_hashes(split_words(text))
    if not len(h):
        return h.view(np.int64)
    width = min(k, len(h))
    n = len(h) - width + 1
    out = np.full(n, np.uint64(width * END % 2**64), dtype=np.uint64)
    for i in range(width):
        out = (out ^ h[i : i + n]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))
