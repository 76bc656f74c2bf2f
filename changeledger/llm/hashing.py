"""Hash mixing in numpy."""

from __future__ import annotations

import numpy as np


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads them evenly."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))
