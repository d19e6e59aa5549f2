"""Arrays as short byte strings, for rows that carry many numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(a: np.ndarray) -> bytes:
    """Byte planes, compressed: small numbers and small steps cost few bytes."""
    a = np.ascontiguousarray(a).reshape(-1)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def spread(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def squeeze_sorted(a: np.ndarray) -> bytes:
    """For sorted uint64: the steps between neighbours."""
    return squeeze(np.diff(a, prepend=np.uint64(0)))


def spread_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, np.uint64), dtype=np.uint64)


def joined(parts: list[bytes]) -> bytes:
    """Byte strings as one, with their number and lengths in front."""
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def split(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    at, out = 8 * (n + 1), []
    for size in np.frombuffer(data, np.int64, n, 8).tolist():
        out.append(data[at:at + size])
        at += size
    return out
