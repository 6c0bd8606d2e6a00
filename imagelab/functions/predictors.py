"""Ready-made batch predictors.

A predictor factory takes no arguments and returns a function from a pixel stack (n, h, w, 3)
to a score or feature matrix (n, d). The factory is called once per task, so a network is loaded
where it is used and never travels inside a closure. Any framework fits behind this interface.
"""

from collections.abc import Callable

import numpy as np

PredictFn = Callable[[np.ndarray], np.ndarray]


class RowsRefused(Exception):
    """Raised by a predictor for a stack with images that it cannot take.

    The images are then tried one by one, and those refused are left out with the message as
    their reason. Any other exception fails the task.
    """


class GridColour:
    """Deterministic features: mean colour of each grid cell, then a histogram per channel."""

    def __init__(self, grid: int = 4, bins: int = 8):
        self.grid, self.bins = grid, bins

    def __call__(self) -> PredictFn:
        return self.features

    def features(self, stack: np.ndarray) -> np.ndarray:
        n, height, width, _ = stack.shape
        if min(height, width) < self.grid:
            raise ValueError(f"an image of {height} x {width} has no {self.grid} x {self.grid} cells")
        rows = np.arange(self.grid) * height // self.grid
        cols = np.arange(self.grid) * width // self.grid
        cells = np.add.reduceat(stack, rows, axis=1, dtype=np.uint32)
        cells = np.add.reduceat(cells, cols, axis=2)
        area = np.outer(np.diff(np.append(rows, height)), np.diff(np.append(cols, width)))
        means = (cells / area[None, :, :, None]).reshape(n, -1)
        bin_of_byte = np.arange(256) * self.bins // 256
        place = np.arange(n * 3).reshape(n, 1, 1, 3) * self.bins  # a histogram per image and channel
        counts = np.bincount((bin_of_byte[stack] + place).ravel(), minlength=n * 3 * self.bins)
        shares = counts / (height * width)
        return np.concatenate([means, shares.reshape(n, -1)], axis=1).astype(np.float32)


class LinearColour:
    """Scores that are a fixed linear form of the summed R, G and B of an image."""

    def __init__(self, weights: list[list[float]]):
        self.weights = np.array(weights, np.float64)

    def __call__(self) -> PredictFn:
        return lambda stack: stack.astype(np.float64).sum(axis=(1, 2)) @ self.weights.T


def grid_colour() -> PredictFn:
    """Default featurizer."""
    return GridColour()()


def channel_averages() -> PredictFn:
    """Mean of each channel, of bytes or of scaled values."""
    return lambda stack: stack.mean(axis=(1, 2))
