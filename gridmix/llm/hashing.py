"""Hashes of byte ranges by prefix sums of powers modulo 2**64, for whole arrays at once."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * MIX
    return (h ^ h >> np.uint64(29)) * MIX


class Ranges:
    """``hash(a, b)`` of raw[a:b] for arrays a and b. Powers are kept for the longest array seen in this process."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        if len(Ranges.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            Ranges.up, Ranges.down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, b))) for b in (BASE, inverse))
        self.sums = np.append(np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * Ranges.up[: len(raw)]))

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * Ranges.down[a] + (b - a).astype(np.uint64))

    def all_of(self, k: int) -> np.ndarray:
        """The hashes of every raw[i:i + k]."""
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * Ranges.down[:n] + np.uint64(k))
