"""Vectorised hashes of substrings, by prefix sums modulo 2**64."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Odd, so that it has an inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))

_powers = {BASE: np.ones(1, U), INVERSE: np.ones(1, U)}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 or more; kept, and doubled when too short."""
    p = _powers[base]
    while len(p) < n:
        p = _powers[base] = np.concatenate((p, p * U(pow(base, len(p), 1 << 64))))
    return p


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """s with s[i] the sum of values[j] * BASE ** j over j < i."""
    s = np.empty(len(values) + 1, U)
    s[0] = 0
    np.cumsum(values * powers(BASE, len(values))[: len(values)], out=s[1:])
    return s


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start] + (end - start).astype(U))
