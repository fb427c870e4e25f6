"""Spark's xxhash64 over BIGINT columns in numpy, so that Python stages can recompute hashes the JVM made."""

from __future__ import annotations

import numpy as np

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SEED = np.uint64(42)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def hash_long(values: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """XXH64 of eight-byte values; unsigned in and out."""
    with np.errstate(over="ignore"):
        h = np.asarray(seed, dtype=np.uint64) + P5 + np.uint64(8)
        h = h ^ (_rotl(values * P2, 31) * P1)
        h = _rotl(h, 27) * P1 + P4
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def xxhash64(*columns: np.ndarray) -> np.ndarray:
    """Same as Spark's xxhash64(c1, c2, ...) for BIGINT columns without nulls; int64 out."""
    h: np.ndarray | np.uint64 = SEED
    for c in columns:
        h = hash_long(np.asarray(c, dtype=np.int64).view(np.uint64), h)
    return np.asarray(h, dtype=np.uint64).view(np.int64)
