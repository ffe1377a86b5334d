"""Rabin-Karp fingerprints of spans by prefix polynomials, for whole numpy arrays at a time."""

import numpy as np

_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept for the life of the process."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    h = values ^ (values >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Fingerprints of any spans of one sequence, each from two values of its prefix polynomial.

    A span's fingerprint depends on the signs in it and not on its place.
    """

    def __init__(self, signs: np.ndarray):
        n = len(signs)
        terms = (signs.astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, n)[:n]
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        self.back = _powers_of(_INVERSE, n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.back[start])
