"""Word shingles of texts as 64-bit hash sets, their exact comparison, and minwise signatures."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import utf8

_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased, words by ASCII blanks, ``k``
    consecutive words; fewer words are one shingle; no words, no shingle."""
    memory: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    out = []
    for text in texts:
        words = utf8(text).lower().split()
        for w in set(words).difference(memory):
            memory[w] = digest(w)
        h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
        if 0 < len(h) < k:
            total = np.full(1, len(h), np.uint64)
            for x in h:
                total = mix(total * _P + x)
            out.append(total)
        elif len(h):
            n = len(h) - k + 1
            total = h[:n].copy()
            for i in range(1, k):
                total = total * _P + h[i : i + n]
            out.append(np.unique(mix(total)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_keys(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two 64-bit numbers that agree for equal sets."""
    ones = [int(np.add.reduce(s).view(np.int64)) if s.size else 0 for s in sets]
    twos = [int(np.add.reduce(mix(s ^ _P)).view(np.int64)) if s.size else 0 for s in sets]
    return ones, twos


def factors(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    base = (mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * _P) >> np.uint64(32)).astype(np.uint32)
    return base[:coordinates] | np.uint32(1), base[coordinates:]


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Minwise tokens, one row of bytes per set: under each of the ``coordinates`` hash orders the
    set's first element, hashed to a byte. An empty set has zeros."""
    sizes = np.array([s.size for s in sets])
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), coordinates), np.uint8)
    if full.size:
        joined = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for c, (a, b) in enumerate(zip(*factors(coordinates), strict=True)):
            least = np.minimum.reduceat(joined * a + b, starts)
            out[full, c] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on the full sets; empty sets are similar to none."""
    if not x.size or not y.size or 100 * min(x.size, y.size) < percent * max(x.size, y.size):
        return False
    at = np.searchsorted(x, y)
    at[at == x.size] = 0
    both = int((x[at] == y).sum())
    return 100 * both >= percent * (x.size + y.size - both)
