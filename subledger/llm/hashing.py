"""Vectorised polynomial hashes of byte or word runs, modulo 2^64."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
GRAM = 0xD1342543DE82EF95


@lru_cache(1)
def byte_values() -> np.ndarray:
    """A fixed random odd 64-bit value per byte."""
    rng = np.random.default_rng(13)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(8)
def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


def rolled(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[begin:end], wherever it stands."""
    size = 1 << max(4, int(len(values)).bit_length())
    up, down = powers(base, size), powers(pow(base, -1, 1 << 64), size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
        return (sums[end] - sums[begin]) * down[begin]


def grams(values: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of every n values in a row."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    size = 1 << max(4, int(len(values)).bit_length())
    up, down = powers(base, size), powers(pow(base, -1, 1 << 64), size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
        return (sums[n:] - sums[:-n]) * down[: len(values) - n + 1]


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt * BASE & MASK)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """One identifier for each pair of identifiers."""
    with np.errstate(over="ignore"):
        return mixed(a * np.uint64(GRAM) + (b ^ (b >> np.uint64(32))) * np.uint64(BASE) + b, salt)
