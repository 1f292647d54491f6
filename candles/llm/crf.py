"""Linear-chain conditional random fields over many short sequences at once, in numpy.

A model has scores of features for each label, of label pairs, and of first and last labels. Sequences
are given one after another with their lengths; a step of a recursion is done for all sequences that
are that long, longest first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label x next label
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def empty(features: int, labels: int) -> Model:
        return Model(np.zeros((features, labels)), np.zeros((labels, labels)), np.zeros(labels), np.zeros(labels))


class Steps:
    """Positions of packed sequences by step: at[t] are the places of the t-th items, longest first."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        begins = np.cumsum(lengths) - lengths
        self.order = np.argsort(-lengths, kind="stable")
        self.order = self.order[lengths[self.order] > 0]
        ordered, starts = lengths[self.order], begins[self.order]
        self.longest = int(ordered[0]) if len(ordered) else 0
        alive = np.searchsorted(-ordered, -np.arange(1, self.longest + 1), side="right")
        self.at = [starts[:n] + t for t, n in enumerate(alive)]
        self.ends = starts + ordered - 1


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """(marginals of labels at each place, expected label pairs, sum of log partition functions)."""
    steps, k = Steps(lengths), scores.shape[1]
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    pairs = np.zeros((k, k))
    if not steps.longest:
        return scores, pairs, 0.0
    alpha[steps.at[0]] = scores[steps.at[0]] + model.first
    for t in range(1, steps.longest):
        here, before = steps.at[t], steps.at[t] - 1
        alpha[here] = _log_sum(alpha[before][:, :, None] + model.moves, 1) + scores[here]
    beta[steps.ends] = model.last
    for t in range(steps.longest - 2, -1, -1):
        after = steps.at[t + 1]
        beta[after - 1] = _log_sum((beta[after] + scores[after])[:, None, :] + model.moves, 2)
    total = np.zeros(len(scores))
    logs = _log_sum(alpha[steps.ends] + model.last, 1)
    begins = steps.at[0]
    total[begins] = logs
    for t in range(1, steps.longest):
        here, before = steps.at[t], steps.at[t] - 1
        total[here] = total[before]
        joint = alpha[before][:, :, None] + model.moves + (scores[here] + beta[here])[:, None, :]
        pairs += np.exp(joint - total[here][:, None, None]).sum(axis=0)
    return np.exp(alpha + beta - total[:, None]), pairs, float(logs.sum())


def viterbi(scores: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """The best label at each place."""
    steps = Steps(lengths)
    best, came = np.array(scores), np.zeros(scores.shape, np.int8)
    labels = np.zeros(len(scores), np.int8)
    if not steps.longest:
        return labels
    best[steps.at[0]] += model.first
    for t in range(1, steps.longest):
        here = steps.at[t]
        reached = best[here - 1][:, :, None] + model.moves
        came[here] = reached.argmax(axis=1)
        best[here] += reached.max(axis=1)
    labels[steps.ends] = (best[steps.ends] + model.last).argmax(axis=1)
    for t in range(steps.longest - 1, 0, -1):
        here = steps.at[t]
        labels[here - 1] = came[here, labels[here]]
    return labels


def train(
    features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, classes: int,
    penalty: float = 1e-3, rounds: int = 300, rate: float = 0.1,
    opens: np.ndarray | None = None, closes: np.ndarray | None = None,
) -> Model:
    """Fit by Adam on the mean log-likelihood of a place with a quadratic penalty; every start is
    zero, so equal tables give equal models. An empty table gives the model that knows nothing.
    Sequences that `opens` or `closes` deny are pieces of longer ones: they say nothing of first or
    last labels."""
    n, width = features.shape
    model = Model.empty(width, classes)
    if not n:
        return model
    some = np.asarray(lengths) > 0
    lengths = np.asarray(lengths)[some]
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    opens, closes = (np.ones(len(lengths), bool) if x is None else np.asarray(x, bool)[some] for x in (opens, closes))
    hot = np.eye(classes)[labels]
    inner = np.setdiff1d(np.arange(1, n), starts)
    seen = np.zeros((classes, classes))
    np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
    parts = [model.weights, model.moves, model.first, model.last]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, rounds + 1):
        scores = features @ model.weights
        # The recursions add first and last scores to every sequence.
        scores[starts[~opens]] -= model.first
        scores[ends[~closes]] -= model.last
        marginals, pairs, _ = forward_backward(scores, lengths, model)
        over = marginals - hot
        slopes = [features.T @ over, pairs - seen, over[starts[opens]].sum(axis=0), over[ends[closes]].sum(axis=0)]
        for part, slope, mean, square in zip(parts, slopes, means, squares):
            slope = slope / n + penalty * part
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            part -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return model
