"""Word shingles as hashes, computed on whole texts inside tasks."""

from __future__ import annotations

import numpy as np

#: Words remembered per worker, about 35 MB at most.
CACHED_WORDS = 200_000
U = np.uint64
_ODD = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose bits all depend on all bits."""
    v = values ^ (values >> U(31))
    v = v * U(0xBF58476D1CE4E5B9)
    v = v ^ (v >> U(29))
    v = v * U(0x94D049BB133111EB)
    return v ^ (v >> U(32))


class WordHashes(dict):
    """Word (bytes) to a 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a UTF-8 text, A-Z lower-cased; ASCII blanks part words."""
    words = text.lower().split()
    return np.fromiter(map(_words.__getitem__, words), U, len(words))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size``, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = words[:n].copy()
    for k in range(1, size):
        out = mixed(out * _ODD[0] + words[k:n + k] * _ODD[1] + U(k))
    return mixed(out + U(size))


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size``, in order. Runs of double length are made of two
    halves, and the last length of two that overlap: four steps for eight tokens."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out, have = tokens, 1
    while have < size:
        step = min(have, size - have)
        out = mixed(out[:len(out) - step] * _ODD[0] + out[step:] * _ODD[1] + U(have))
        have += step
    return mixed(out + U(size))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct runs of ``size`` words; the whole sequence if there are
    fewer words; nothing without words."""
    words = word_hashes(text or b"")
    if 0 < len(words) < size:
        return runs(words, len(words))
    return np.unique(runs(words, size))
