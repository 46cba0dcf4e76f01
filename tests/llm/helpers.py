"""Small brute-force helpers of the operator tests."""

import numpy as np


def smallest_reachable(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable over a boolean link matrix with a true diagonal."""
    label = np.arange(len(linked))
    while True:
        new = np.where(linked, label[None, :], len(linked)).min(axis=1)
        if (new == label).all():
            return label
        label = new
