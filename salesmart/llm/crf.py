"""A linear-chain conditional random field in numpy, over batches of sequences.

A sequence is a list of positions, each with the numbers of its features; before its first and after its last position the chain is in
state 0. Scores are feature weights per state plus one weight per transition; forbidden transitions stay at a
large negative weight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_NEVER = -1e4


@dataclass(frozen=True)
class Fit:
    """Full-batch Adam on the log likelihood, with an L2 penalty per sequence."""

    rounds: int = 150
    rate: float = 0.15
    penalty: float = 1e-4


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def batches(lengths: Sequence[int], cells: int = 60_000) -> Iterator[np.ndarray]:
    """Numbers of sequences of like length, as many as fill ``cells`` positions when padded; at least one."""
    order = np.argsort(np.asarray(lengths), kind="stable")
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and lengths[order[end]] * (end + 1 - start) <= cells:
            end += 1
        yield order[start:end]
        start = end


class Chain:
    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        """``weights``: (features, states); ``transitions``: (from, to)."""
        self.weights, self.transitions = weights, transitions

    def emissions(self, sequences: Sequence[Sequence[Sequence[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, position, state) scores, padded with zeros, and lengths."""
        lengths = np.array([len(s) for s in sequences])
        out = np.zeros((len(sequences), int(lengths.max()), self.weights.shape[1]))
        for i, sequence in enumerate(sequences):
            for t, features in enumerate(sequence):
                if features:
                    out[i, t] = self.weights[list(features)].sum(axis=0)
        return out, lengths

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best states, (sequence, position); padding is state 0."""
        count, steps, _ = scores.shape
        best = self.transitions[0] + scores[:, 0]
        came = np.zeros(scores.shape, dtype=np.int8)
        rows = np.arange(count)
        for t in range(1, steps):
            to = best[:, :, None] + self.transitions
            came[:, t] = to.argmax(axis=1)
            live = (t < lengths)[:, None]
            best = np.where(live, to.max(axis=1) + scores[:, t], best)
        states = np.zeros((count, steps), dtype=np.int8)
        now = (best + self.transitions[:, 0]).argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            live = t < lengths
            states[live, t] = now[live]
            now = np.where(live, came[rows, t, now], now)
        return states

    def _forward(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alpha = np.empty_like(scores)
        alpha[:, 0] = self.transitions[0] + scores[:, 0]
        for t in range(1, scores.shape[1]):
            moved = _sum_exp(alpha[:, t - 1, :, None] + self.transitions, axis=1) + scores[:, t]
            alpha[:, t] = np.where((t < lengths)[:, None], moved, alpha[:, t - 1])
        return alpha, _sum_exp(alpha[:, -1] + self.transitions[:, 0], axis=1)

    def _backward(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        beta = np.empty_like(scores)
        beta[:, -1] = self.transitions[:, 0]
        for t in range(scores.shape[1] - 2, -1, -1):
            moved = _sum_exp(self.transitions + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where((t + 1 < lengths)[:, None], moved, self.transitions[:, 0])
        return beta

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The probability of each state at each position; meaningless in the padding."""
        alpha, total = self._forward(scores, lengths)
        return np.exp(alpha + self._backward(scores, lengths) - total[:, None, None])

    def log_likelihood(self, scores: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Of one labelling per sequence."""
        rows, steps = np.arange(len(lengths)), np.arange(scores.shape[1])
        inside = steps < lengths[:, None]
        at = np.take_along_axis(scores, states[:, :, None].astype(int), axis=2)[:, :, 0]
        before = np.concatenate([np.zeros((len(rows), 1), dtype=int), states[:, :-1]], axis=1)
        path = ((at + self.transitions[before, states]) * inside).sum(axis=1) + self.transitions[states[rows, lengths - 1], 0]
        return path - self._forward(scores, lengths)[1]


def _gradient(chain: Chain, features: np.ndarray, states: np.ndarray, lengths: np.ndarray, times: np.ndarray):
    """Of the summed log likelihood by weights and transitions. ``features``: (sequence, position, slot), padded with -1."""
    known = (features >= 0)[..., None]
    scores = (chain.weights[features] * known).sum(axis=2)
    alpha, total = chain._forward(scores, lengths)
    beta = chain._backward(scores, lengths)
    count, steps, n = scores.shape
    inside = (np.arange(steps) < lengths[:, None]) * times[:, None]
    gap = -np.exp(alpha + beta - total[:, None, None]) * inside[..., None]
    rows, places = np.nonzero(inside)
    gap[rows, places, states[rows, places]] += inside[rows, places]
    by_weight = np.zeros_like(chain.weights)
    spread = np.broadcast_to(gap[:, :, None, :], (*features.shape, n))
    np.add.at(by_weight, features[features >= 0], spread[features >= 0])
    by_move = np.zeros((n, n))
    by_move[0] += gap[:, 0].sum(axis=0)
    for t in range(1, steps):
        pair = alpha[:, t - 1, :, None] + chain.transitions + (scores[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
        by_move -= (np.exp(pair) * inside[:, t, None, None]).sum(axis=0)
        np.add.at(by_move, (states[:, t - 1], states[:, t]), inside[:, t])
    ends = gap[np.arange(count), lengths - 1].sum(axis=0)
    by_move[:, 0] += ends
    return by_weight, by_move


def fit(sequences: list, labels: list, times: list[int], features: int, allowed: np.ndarray, how: Fit = Fit()) -> Chain:
    """A chain trained on ``sequences`` of feature numbers with the states ``labels``; each stands for as many as ``times`` says."""
    states = len(allowed)
    chain = Chain(np.zeros((features, states)), np.where(allowed, 0.0, _NEVER))
    slots = max((len(f) for s in sequences for f in s), default=1)
    data = []
    for rows in batches([len(s) for s in sequences]):
        lengths = np.array([len(sequences[i]) for i in rows])
        numbers = np.full((len(rows), lengths.max(), slots), -1)
        wanted = np.zeros((len(rows), lengths.max()), dtype=int)
        for r, i in enumerate(rows):
            wanted[r, : lengths[r]] = labels[i]
            for t, found in enumerate(sequences[i]):
                numbers[r, t, : len(found)] = found
        data.append((numbers, wanted, lengths, np.array([times[i] for i in rows], dtype=float)))
    whole = sum(times) or 1
    values = [chain.weights, chain.transitions]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, how.rounds + 1):
        found = [_gradient(chain, *part) for part in data]
        for i, value in enumerate(values):
            slope = sum(f[i] for f in found) / whole - how.penalty * np.where(value > _NEVER, value, 0)
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            move = how.rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
            value += move if i == 0 else np.where(allowed, move, 0)
    return chain
