"""Word hashes and shingle sets of texts, for whole Arrow batches at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: So many word hashes are kept in a worker (about 150 bytes each).
KEPT = 500_000


class WordHashes(dict):
    """64-bit hash of a word's bytes, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts, and how many each text has. bytes.split() parts at the six ASCII spaces."""
        if len(self) > KEPT:
            self.clear()
        words = [t.split() for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        get = self.__getitem__
        return np.fromiter((h for x in words for h in map(get, x)), np.uint64, int(sizes.sum())), sizes


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k in a row of hashes, without regard to where texts end."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    return mixed(out)


def shingle_sets(texts: list[bytes], k: int, cache: WordHashes) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word runs; of fewer words, the whole sequence is one."""
    flat, sizes = cache.of(texts)
    runs = windows(flat, k)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= k:
            out.append(np.unique(runs[at : at + n - k + 1]))
        elif n:
            out.append(windows(flat[at : at + n], n) + np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
