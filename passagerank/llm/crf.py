"""Linear-chain conditional random field in numpy: training on a small table, batched Viterbi decoding.

Edge cases: features that training has not met weigh nothing; a batch may hold sequences of any lengths from 1 on, and an empty
batch gives nothing; of paths with equal scores the one of the first labels is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

IMPOSSIBLE = -1e4


@dataclass
class Field:
    """``features`` numbers feature names; ``weights`` are feature by label, ``steps`` label to label."""

    features: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray
    starts: np.ndarray

    def emissions(self, sequence: list[list[str]]) -> np.ndarray:
        """Scores of the labels of every token; unknown features count nothing."""
        rows = [[f for name in token if (f := self.features.get(name)) is not None] for token in sequence]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.array([f for row in rows for f in row], np.int64)
        out = np.zeros((len(rows), self.weights.shape[1]))
        np.add.at(out, np.repeat(np.arange(len(rows)), lengths), self.weights[flat])
        return out


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    out = np.zeros((len(sequences), int(lengths.max()), sequences[0].shape[1]))
    for i, s in enumerate(sequences):
        out[i, : len(s)] = s
    return out, lengths


def viterbi(emissions: list[np.ndarray], steps: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Best labels of every sequence; all sequences of the batch advance together."""
    if not emissions:
        return []
    scores, lengths = padded(emissions)
    batch, longest, labels = scores.shape
    best = scores[:, 0] + starts
    back = np.zeros((batch, longest, labels), np.int64)
    for t in range(1, longest):
        paths = best[:, :, None] + steps[None]
        back[:, t] = paths.argmax(axis=1)
        live = (t < lengths)[:, None]
        best = np.where(live, np.take_along_axis(paths, back[:, t][:, None], axis=1)[:, 0] + scores[:, t], best)
    out, rows = np.zeros((batch, longest), np.int64), np.arange(batch)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        ends = t < lengths
        out[ends, t] = state[ends]
        state = np.where(ends & (t > 0), back[rows, t, state], state)
    return [out[i, :n] for i, n in enumerate(lengths)]


def _expectations(scores, lengths, steps, starts):
    """Label marginals and expected steps by scaled forward and backward passes."""
    batch, longest, labels = scores.shape
    move = np.exp(steps)
    seen = np.exp(scores - scores.max(axis=2, keepdims=True))
    live = np.arange(longest)[None] < lengths[:, None]
    forward, scale = np.zeros_like(seen), np.ones((batch, longest, 1))
    for t in range(longest):
        reached = np.exp(starts)[None] * seen[:, 0] if t == 0 else (forward[:, t - 1] @ move) * seen[:, t]
        scale[:, t] = reached.sum(axis=1, keepdims=True)
        forward[:, t] = reached / scale[:, t]
    backward = np.ones_like(seen)
    for t in range(longest - 2, -1, -1):
        ahead = (seen[:, t + 1] * backward[:, t + 1] / scale[:, t + 1]) @ move.T
        backward[:, t] = np.where(live[:, t + 1 : t + 2], ahead, 1.0)
    marginals = forward * backward * live[:, :, None]
    onward = (seen * backward / scale * live[:, :, None])[:, 1:].reshape(-1, labels)
    return marginals, move * (forward[:, :-1].reshape(-1, labels).T @ onward)


def train(
    sequences: list[list[list[str]]], labels: list[list[int]], n_labels: int, allowed: np.ndarray, first: np.ndarray,
    rounds: int = 80, rate: float = 0.15, ridge: float = 1e-3,
) -> Field:
    """Maximum likelihood with a ridge, by full-batch Adam steps.

    ``allowed`` and ``first`` forbid steps and first labels.
    """
    names = sorted({f for s in sequences for token in s for f in token})
    features = {name: i for i, name in enumerate(names)}
    token_rows, flat = [], []
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    longest = int(lengths.max())
    for i, sequence in enumerate(sequences):
        for t, token in enumerate(sequence):
            flat += [features[f] for f in token]
            token_rows += [i * longest + t] * len(token)
    flat, token_rows = np.array(flat), np.array(token_rows)
    order = np.argsort(flat, kind="stable")
    by_feature, feature_starts = token_rows[order], np.searchsorted(flat[order], np.arange(len(names)))
    row_starts = np.unique(token_rows, return_index=True)
    n = len(sequences)
    truth = np.zeros((n, longest, n_labels))
    seen_steps, seen_starts = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    for i, sequence in enumerate(labels):
        truth[i, np.arange(len(sequence)), sequence] = 1
        np.add.at(seen_steps, (sequence[:-1], sequence[1:]), 1)
        seen_starts[sequence[0]] += 1
    weights = np.zeros((len(names), n_labels))
    steps, starts = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, steps, starts)]
    for turn in range(1, rounds + 1):
        scores = np.zeros((n * longest, n_labels))
        scores[row_starts[0]] = np.add.reduceat(weights[flat], row_starts[1], axis=0)
        scores = scores.reshape(n, longest, n_labels)
        now_steps, now_starts = np.where(allowed, steps, IMPOSSIBLE), np.where(first, starts, IMPOSSIBLE)
        marginals, expected = _expectations(scores, lengths, now_steps, now_starts)
        error = (truth - marginals).reshape(n * longest, n_labels)
        gradients = [
            np.add.reduceat(error[by_feature], feature_starts, axis=0), seen_steps - expected,
            seen_starts - marginals[:, 0].sum(axis=0),
        ]
        for p, g, (m, v) in zip((weights, steps, starts), gradients, state, strict=True):
            g = g / n - ridge * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Field(features, weights, np.where(allowed, steps, IMPOSSIBLE), np.where(first, starts, IMPOSSIBLE))
