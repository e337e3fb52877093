"""Word shingles as sorted 64-bit hashes, and exact Jaccard inside a block."""

from __future__ import annotations

import numpy as np
import xxhash

_M = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Maximal runs of other than space, tab, LF, VT, FF, CR."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word windows; a text of fewer words has
    one window of all its words, a text without words has none."""
    w = words(text)
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    k = min(n, len(w))
    acc = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        acc = mix(acc * _M + h[i: len(w) - k + 1 + i])
    return np.unique(acc)


def jaccard_links(sets: list[np.ndarray], threshold: float, chunk: int = 2048) -> np.ndarray:
    """Boolean matrix of pairs with Jaccard >= threshold (diagonal False).

    Windows that only one set holds can't count towards an intersection; the
    others are counted by a 0/1 matrix product, a chunk of windows at a time."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.float64)
    inter = np.zeros((n, n), dtype=np.float32)
    if size.sum():
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(n), size.astype(np.int64))
        _, inv, cnt = np.unique(flat, return_inverse=True, return_counts=True)
        use = cnt[inv] > 1
        inv, row = inv[use], row[use]
        if len(inv):
            _, inv = np.unique(inv, return_inverse=True)
            order = np.argsort(inv, kind="stable")
            inv, row = inv[order], row[order]
            top = int(inv[-1]) + 1
            for lo in range(0, top, chunk):
                s, e = np.searchsorted(inv, [lo, lo + chunk])
                m = np.zeros((n, min(chunk, top - lo)), dtype=np.float32)
                m[row[s:e], inv[s:e] - lo] = 1
                inter += m @ m.T
    union = size[:, None] + size[None, :] - inter
    ok = (inter >= threshold * union - 1e-9) & (union > 0)
    np.fill_diagonal(ok, False)
    return ok
