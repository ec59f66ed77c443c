"""Fingerprints of texts and a hierarchical index over them in Gray order."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash

#: Lower-cases A-Z only.
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
SEED = 42
FAN = 8


def fingerprint(text: bytes, words: int = 3) -> int:
    """The fingerprint of one text in UTF-8."""
    parts = text.translate(LOWER).split()  # bytes split at [\x20\x09-\x0D]
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [digest(joined, SEED)]
    else:
        ends = list(accumulate(len(x) + 1 for x in parts))
        starts = [0, *ends[: len(parts) - words]]
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)]
    return majority(hashes)


def majority(hashes: list[int]) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], ">u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The position of each 64-bit value in the reflected Gray code."""
    rank = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Hierarchical index over fingerprints that are grouped by bucket and in Gray order within each."""

    def __init__(self, values: np.ndarray, bucket: np.ndarray, fan: int = FAN):
        self.values = values
        ones, zeros, group = values, ~values, bucket  # bits set in all members; bits clear in all members
        last = np.arange(len(values))
        #: From the leaves up: the first child of each node, the bits it shares, which they are, and its last leaf.
        self.levels = [{"ones": ones, "mask": ones | zeros, "last": last}]
        while True:
            starts_bucket = np.r_[True, group[1:] != group[:-1]]
            first_of = np.flatnonzero(starts_bucket)[np.cumsum(starts_bucket) - 1]
            starts = np.flatnonzero((np.arange(len(group)) - first_of) % fan == 0)
            ends = np.r_[starts[1:], len(group)]
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            group, last = group[starts], last[ends - 1]
            self.levels.append({"ones": ones, "mask": ones | zeros, "last": last, "starts": starts, "ends": ends})
            if len(np.unique(group)) == len(group):
                break
        self.roots = self._leaf_root()
        for upper, lower in zip(self.levels[:0:-1], self.levels[-2::-1], strict=True):
            parent = np.repeat(np.arange(len(upper["starts"])), upper["ends"] - upper["starts"])
            lower["own"] = lower["mask"] & ~upper["mask"][parent]
        self.levels[-1]["own"] = self.levels[-1]["mask"]

    def _leaf_root(self) -> np.ndarray:
        """The root above each leaf."""
        at = np.arange(len(self.levels[0]["ones"]))
        for level in self.levels[1:]:
            at = np.repeat(np.arange(len(level["starts"])), level["ends"] - level["starts"])[at]
        return at

    def search(self, low: int, high: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), i in [low, high) and j after it in the same bucket, at most ``distance`` bits apart."""
        query = np.arange(low, high)
        node = self.roots[low:high]
        bits = np.zeros(len(query), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            bits = bits + np.bitwise_count((self.values[query] ^ level["ones"][node]) & level["own"][node])
            keep = (bits <= distance) & (level["last"][node] > query)
            query, node, bits = query[keep], node[keep], bits[keep]
            if depth and len(query):
                starts, n = level["starts"][node], level["ends"][node] - level["starts"][node]
                query, bits = np.repeat(query, n), np.repeat(bits, n)
                node = np.repeat(starts - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return query, node


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def bucket_links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray, distance: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of fingerprints, of the links within the buckets."""
    order = np.lexsort((gray_rank(fp), key, mask))
    mask, key, fp = mask[order], key[order], fp[order]
    new = np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
    bucket = np.cumsum(new) - 1
    several = np.bincount(bucket)[bucket] > 1
    fp, bucket = fp[several], bucket[several]
    if not len(fp):
        return fp, fp
    index = GrayIndex(fp, bucket)
    names, ids = np.unique(fp, return_inverse=True)
    forest = Forest(len(names))
    for low in range(0, len(fp), block):
        a, b = index.search(low, min(low + block, len(fp)), distance)
        for x, y in set(zip(ids[a].tolist(), ids[b].tolist(), strict=True)):
            forest.join(x, y)
    roots = np.array([forest.find(x) for x in range(len(names))])
    moved = np.flatnonzero(roots != np.arange(len(names)))
    return names[moved], names[roots[moved]]
