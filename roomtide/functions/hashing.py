"""Hashes of numpy arrays."""

from __future__ import annotations

import numpy as np

#: Fixed value: the odd step of the SplitMix64 generator.
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The published SplitMix64 finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: int, *keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that follow from the keys alone."""
    state = mixed(np.full(1, seed % 2**64, np.uint64) + STEP)
    for key in keys:
        state = mixed(state + (key.astype(np.uint64) + np.uint64(1)) * STEP)
    return (state >> np.uint64(11)).astype(np.float64) / 2.0**53
