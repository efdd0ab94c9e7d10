"""Word and shingle hashing over batches of texts, vectorised with numpy.

A word is a maximal run of letters and digits (``str.isalnum``) of the lower-cased text.
Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_grown: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@lru_cache(1)
def word_chars() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_grown.get("p", ())) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        for key, base in (("p", _BASE), ("i", _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _grown[key] = np.cumprod(steps)
    return _grown["p"], _grown["i"]


def codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line feed after each, and where each text begins (one more entry at the end)."""
    joined = "\n".join(texts) + "\n" if len(texts) else ""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return points, bounds


def spans_of(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words and, by text, the index of its first word."""
    inside = word_chars()[points].view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.searchsorted(starts, bounds)


def hash_spans(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(points))
    sums = np.zeros(len(points) + 1, U)
    np.cumsum((points.astype(U) + U(1)) * power[: len(points)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and by text the index of its first word (one more entry at the end)."""
    points, bounds = codes([t.lower() for t in texts])
    starts, ends, offsets = spans_of(points, bounds)
    return hash_spans(points, starts, ends), offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, in order and with repeats; a text of 1 to k-1 words has one, of all its words."""
    n = np.diff(offsets)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_offsets = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=out_offsets[1:])
    factors = mix(np.arange(1, k + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
    windows = np.zeros(len(hashes), U)
    for j in range(min(k, len(hashes))):
        windows[: len(hashes) - j] += hashes[j:] * factors[j]
    at = np.arange(out_offsets[-1]) + np.repeat(offsets[:-1] - out_offsets[:-1], count)
    out = mix(windows[at]) if len(at) else np.zeros(0, U)
    for d in np.flatnonzero((n > 0) & (n < k)):
        own = hashes[offsets[d] : offsets[d + 1]]
        out[out_offsets[d]] = mix(np.array([(own * factors[: len(own)]).sum() + U(len(own))], U))[0]
    return out, out_offsets


def pieces(texts: Sequence[str], most_chars: int = 400_000, most_texts: int = 4096) -> Iterator[slice]:
    """Slices of whole texts that together hold about most_chars; a longer text stands alone."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most_chars or i - begin == most_texts:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def text_list(column) -> list[str]:
    """An Arrow string column as a list; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


class HashTable:
    """64-bit hashes to small whole numbers by open addressing; a lookup is a few numpy operations."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(16 * len(hashes)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, U), np.full(1 << self.bits, -1, np.int32)
        for h, v in zip(hashes.tolist(), values.tolist(), strict=True):
            at = h >> (64 - self.bits)
            while self.values[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.values[at] = h, v

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Values, -1 for hashes that aren't there."""
        at = (hashes >> U(64 - self.bits)).astype(np.int64)
        out = self.values[at]
        rest = np.flatnonzero(out >= 0)
        rest = rest[self.keys[at[rest]] != hashes[rest]]
        while len(rest):  # few: most places are empty or hold the hash itself
            at[rest] = near = (at[rest] + 1) & ((1 << self.bits) - 1)
            out[rest] = self.values[near]
            rest = rest[(out[rest] >= 0) & (self.keys[near] != hashes[rest])]
        return out
