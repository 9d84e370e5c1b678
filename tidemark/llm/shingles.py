"""Sets of word shingles as 64-bit hashes, and the signatures of their segments."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

WIDTH = 5
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S27, _S30, _S31, _S33 = (np.uint64(x) for x in (27, 30, 31, 33))
#: Bits of a signature row's tag: set size, band, segment or number of empty segments, kind.
SIZE_AT, BAND_AT, PART_AT = 31, 25, 1
#: The band that marks a document's own row; sets lie in bands below it.
RECORD = 63
PARITY_WORDS = 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _S30)) * _B
    x = (x ^ (x >> _S27)) * _C
    return x ^ (x >> _S31)


class WordHashes(dict):
    """The hash of each word; forgets all of them where it grows past ``keep``."""

    keep = 600_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.keep:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


@lru_cache(1)
def word_hashes() -> WordHashes:
    """One memory per worker process, so that later tasks find its words."""
    return WordHashes()


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles (A-Z lower-cased).

    Fewer words give one shingle of all; none give an empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WIDTH, len(words))
    n = len(words) - width + 1
    x = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        x = x * _A + h[k : k + n]
    x = np.sort(mix(x))
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def set_id(tokens: np.ndarray) -> int:
    """A hash of the whole set, as a signed integer."""
    total = mix(tokens + _A).sum(keepdims=True) + np.full(1, len(tokens), dtype=np.uint64) * _C
    return int(mix(total).view(np.int64)[0])


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bits that each shingle flips; two sets' bits differ in no more places than the sets in shingles."""
    spots = np.bincount(((tokens >> _S31) % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(spots.astype(np.uint8)).view(np.int64)


class Bands:
    """Set sizes cut into bands, and how each band's universe of shingles is partitioned.

    Sets x and y with 100|x & y| >= 80|x | y| differ in at most (|x| + |y|) / 9 shingles
    and lie in one band or in neighbours; the larger then also counts in the smaller
    one's band. A band's shingles are hashed to segments. Allowing each segment a
    difference of 0 or 1, the allowances plus one must sum to more than the possible
    difference: then some segment of x and y differs by no more than it allows.

    Sets of few shingles get few, long segments that allow 1, so that common shingles
    alone don't make candidates; each also indexes what remains after one deletion. For
    longer sets deletions cost more rows than they save: their segments allow 0, with
    some to spare, so that empty or frequent segments needn't be used.
    """

    LAST_WIDE = 73

    def __init__(self, largest: int = 1 << 31):
        self.edges = [1, 4]
        while self.edges[-1] <= largest:
            self.edges.append(-(-self.edges[-1] * 25 // 16))
        self.segments, self.wide = [], []
        for hi in self.edges[1:]:
            most = (hi - 1) // 4
            self.wide.append(4 < hi <= self.LAST_WIDE)
            if hi <= 4:
                self.segments.append(1)
            elif self.wide[-1]:
                self.segments.append((most + 2) // 2 + (most > 4))
            else:
                self.segments.append(int(1.12 * (most + 1) + 0.8 * hi**0.5) + 2)

    def of(self, size: int) -> list[int]:
        """The bands a set of this size counts in: its own, and the one before if a partner can be there."""
        own = int(np.searchsorted(self.edges, size, side="right")) - 1
        return [own, own - 1] if own and 4 * size <= 5 * (self.edges[own] - 1) else [own]

    def most_apart(self, size: int, band: int) -> int:
        """The largest possible difference from a partner, seen from a set of this size in this band."""
        partner = self.edges[band + 1] - 1
        return (size + min(size * 5 // 4, partner)) // 9 if size > partner else size // 4

    def sums(self, tokens: np.ndarray, band: int):
        """Non-empty segments, their shingle counts and sums, the segment and mixed value of each shingle (in their order)."""
        segment = ((tokens >> _S33) * np.uint64(self.segments[band]) >> _S31).astype(np.int64)  # tokens are sorted, so segments are
        value = mix(tokens ^ _C)
        at = np.concatenate(([0], np.flatnonzero(segment[1:] != segment[:-1]) + 1))
        ends = np.concatenate((at[1:], [len(segment)]))
        return segment[at], ends - at, np.add.reduceat(value, at), segment, value

    def overflows(self, tokens: np.ndarray) -> bool:
        """Whether too many segments are empty to prove anything; such sets are compared directly."""
        return self.signatures(tokens)[2]

    def signatures(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """(signature, tag) rows of a set, for each band that it counts in, and whether it overflows one."""
        sigs, tags, overflow = [], [], False
        for band in self.of(len(tokens)):
            some, count, total, segment, value = self.sums(tokens, band)
            salt = np.full(1, band + 1, dtype=np.uint64) * _B
            tag = (len(tokens) << SIZE_AT) | (band << BAND_AT)

            def key(seg, cnt, tot, salt=salt):
                return mix(mix(tot + salt) + seg.astype(np.uint64) * _A + cnt.astype(np.uint64) * _C)

            m = self.segments[band]
            if not self.wide[band]:
                sigs.append(key(some, count, total))
                tags.append(np.full(len(some), tag | ((m - len(some)) << PART_AT), dtype=np.int64))
                overflow |= len(some) <= self.most_apart(len(tokens), band)
                continue
            full_count, full_total = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.uint64)
            full_count[some], full_total[some] = count, total
            every = np.arange(m)
            sigs += [key(every, full_count, full_total), key(segment, full_count[segment] - 1, full_total[segment] - value)]
            tags += [tag | (every << PART_AT), tag | (segment << PART_AT) | 1]
        return np.concatenate(sigs), np.concatenate(tags), overflow
