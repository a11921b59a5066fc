"""Vectorised word and shingle hashing shared by the Python-side operators.

A word is a maximal run of letters, combining marks and digits of the
lower-cased text.  Every word of a block of texts is hashed with numpy array
operations only: a prefix sum of ``code(c_i) * B**i`` (mod 2**64, B odd) gives
the polynomial hash of any span, which a 64-bit finaliser then mixes.  Memory
is a small constant times the block, and blocks are cut by characters, so it
is bounded by ``BLOCK_CHARS`` or by the longest single text.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

BLOCK_CHARS = 500_000
_B = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64 bits (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _word_table() -> np.ndarray:
    """True for code points of letters (L), marks (M) and numbers (N)."""
    if "word" not in _tables:
        _tables["word"] = np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _tables["word"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i mod 2**64 for i < n; grown by doubling and kept."""
    if "pow" not in _tables or len(_tables["pow"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inv = pow(_B, -1, 1 << 64)
        for name, base in (("pow", _B), ("inv", inv)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            _tables[name] = out
    return _tables["pow"], _tables["inv"]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[s:e]`` for each span; equal content, equal hash."""
    power, inverse = _powers(len(codes) + 1)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of code points."""
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _word_table()[codes]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def blocks(texts: list[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` characters, or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 1
        if size and size + n > limit:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and offsets (one more than texts)."""
    lowered = [(t or "").lower() for t in texts]
    codes = code_points("\n".join(lowered) + "\n")
    starts, ends = word_spans(codes)
    edges = np.cumsum([0] + [len(t) + 1 for t in lowered])
    return span_hashes(codes, starts, ends), np.searchsorted(starts, edges)


def shingles_of(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, and their offsets.

    A text of 1 to k-1 words has one shingle, all its words; one without words
    has none.
    """
    n = np.diff(offsets)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_offsets = np.concatenate([[0], np.cumsum(count)])
    if not len(words):
        return np.empty(0, np.uint64), out_offsets
    mult = [np.uint64(pow(_B, i + 1, 1 << 64)) for i in range(k)]
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    combined = np.zeros(len(words), np.uint64)
    for i in range(k):
        combined += padded[i : i + len(words)] * mult[i]
    first = np.repeat(offsets[:-1] - out_offsets[:-1], count) + np.arange(out_offsets[-1])
    out = combined[first]
    for d in np.flatnonzero((n > 0) & (n < k)):
        own = words[offsets[d] : offsets[d + 1]]
        out[out_offsets[d]] = np.add.reduce(own * np.array(mult[: len(own)], np.uint64)) + np.uint64(len(own))
    return mix(out), out_offsets


def distinct_in_groups(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each group: values, offsets and how often each occurs."""
    groups = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, groups))
    v, g = values[order], groups[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (g[1:] != g[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate([at, [len(v)]]))
    return v[at], np.searchsorted(g[at], np.arange(len(offsets))), counts
