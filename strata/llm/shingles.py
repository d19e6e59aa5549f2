"""Vectorised word shingles: 64-bit hashes computed with numpy on Arrow buffers.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lowered; a shingle is five consecutive words, and a shorter text is one shingle
of all its words.  A text without words (or null) has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from strata.llm.common import forget

BLOCK = 1 << 19          # bytes of text that are hashed at once
_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_EMPTY = np.empty(0, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _MULT) | np.uint64(1)


_POWERS = _powers(256)


def _words(b: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, index of the first word at or after each begin) of a byte
    block; no word reaches over a position in ``begin``."""
    if not len(b):
        return _EMPTY, np.zeros(len(begin), np.int64)
    inside = ~_SPACE[b]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    first = begin[begin < len(b)]
    edge[first] = inside[first]
    starts = np.flatnonzero(edge)
    if not len(starts):
        return _EMPTY, np.zeros(len(begin), np.int64)
    body = b[starts[0]:]
    lengths = np.diff(starts, append=len(b))
    at = np.arange(len(body)) - np.repeat(starts - starts[0], lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    value = (_LOWER[body].astype(np.uint64) + np.uint64(1)) * powers[at]
    value *= inside[starts[0]:]
    return mix64(np.add.reduceat(value, starts - starts[0])), np.searchsorted(starts, begin)


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word of one text of any length, in text order."""
    b, out, lo = np.frombuffer(data, dtype=np.uint8), [], 0
    while lo < len(b):
        hi = min(len(b), lo + BLOCK)
        while hi < len(b) and not _SPACE[b[hi]]:     # a block ends at a space
            hi += 1
        out.append(_words(b[lo:hi], np.zeros(1, np.int64))[0])
        lo = hi
    return np.concatenate(out) if out else _EMPTY


def _roll(w: np.ndarray, k: int) -> np.ndarray:
    n = len(w) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        h = h * _MULT + w[i:i + n]
        h ^= h >> np.uint64(29)
    return mix64(h)


def _of_words(w: np.ndarray, k: int) -> np.ndarray:
    return np.unique(_roll(w, min(k, len(w)))) if len(w) else _EMPTY


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return _of_words(word_hashes(text.encode()), k) if text else _EMPTY


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """``shingle_set`` of every row; rows share blocks of at most about BLOCK
    bytes, so memory follows the block or the longest text."""
    forget()
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if j == i + 1:
            yield _of_words(word_hashes(data[lo:hi].tobytes()), k)
        else:
            w, at = _words(data[lo:hi], offsets[i:j + 1] - lo)
            rolled = _roll(w, k) if len(w) >= k else _EMPTY
            for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                yield np.unique(rolled[a:z - k + 1]) if z - a >= k else _of_words(w[a:z], k)
        i = j


def set_hash(s: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set (equal sets, equal hash; empty: 0)."""
    if not len(s):
        return 0
    h = mix64(mix64(s + np.uint64(0x1234567)).sum(keepdims=True) + np.uint64(len(s)))
    return int(h.view(np.int64)[0])
