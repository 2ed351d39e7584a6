"""A linear-chain conditional random field with two labels, on columns of equally long sequences.

Everything is kept as ratios of label 1 to label 0, which neither overflow nor vanish over a sequence.
Arrays are (position, sequence); positions past a sequence's end are masked and change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

MOST = 25.0


@dataclass
class Chain:
    """Transition scores (from 0 to 1, from 1 to 0, from 1 to 1; staying at 0 is 0) and the start's score of 1."""

    transitions: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0]))
    start: float = 0.0

    def marginals(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Probability of label 1 at each position; also emission, forward and backward ratios."""
        t01, t10, t11 = np.exp(np.clip(self.transitions, -MOST, MOST))
        emit = np.exp(np.clip(scores, -MOST, MOST))
        forward, backward = np.empty_like(emit), np.ones_like(emit)
        last = len(emit) - 1
        if last < 0:
            return emit, emit, emit, emit
        forward[0] = emit[0] * np.exp(np.clip(self.start, -MOST, MOST))
        for t in range(1, last + 1):
            forward[t] = emit[t] * (t01 + forward[t - 1] * t11) / (1 + forward[t - 1] * t10)
        for t in range(last - 1, -1, -1):
            ahead = emit[t + 1] * backward[t + 1]
            backward[t] = np.where(mask[t + 1], (t10 + t11 * ahead) / (1 + t01 * ahead), 1.0)
        odds = forward * backward
        return np.where(mask, odds / (1 + odds), 0.0), emit, forward, backward

    def gradient(self, scores: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of the log likelihood: by position score, by transition, by start."""
        probability, emit, forward, backward = self.marginals(scores, mask)
        t01, t10, t11 = np.exp(np.clip(self.transitions, -MOST, MOST))
        by_score = np.where(mask, labels - probability, 0.0)
        f, ahead, both = forward[:-1], emit[1:] * backward[1:], mask[1:]
        whole = 1 + t01 * ahead + f * t10 + f * t11 * ahead
        y, z = labels[:-1], labels[1:]
        by_transition = np.array([
            np.sum(((1 - y) * z - t01 * ahead / whole)[both]),
            np.sum((y * (1 - z) - f * t10 / whole)[both]),
            np.sum((y * z - f * t11 * ahead / whole)[both]),
        ])
        return by_score, by_transition, float(by_score[0].sum())
