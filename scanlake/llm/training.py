"""Adam for small numpy models."""

from __future__ import annotations

import numpy as np


class Adam:
    """Updates a dictionary of arrays in place; gradients are clipped by their common norm."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float, clip: float = 5.0):
        self.parameters, self.rate, self.clip, self.steps = parameters, rate, clip, 0
        self.mean = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.square = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray], rate: float | None = None) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients.values()))
        scale = min(1.0, self.clip / (norm + 1e-12))
        for name, gradient in gradients.items():
            g = gradient * scale
            self.mean[name] = 0.9 * self.mean[name] + 0.1 * g
            self.square[name] = 0.999 * self.square[name] + 0.001 * g**2
            mean = self.mean[name] / (1 - 0.9**self.steps)
            square = self.square[name] / (1 - 0.999**self.steps)
            self.parameters[name] -= (rate or self.rate) * mean / (np.sqrt(square) + 1e-8)
