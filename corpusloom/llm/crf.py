"""A linear-chain conditional random field in numpy: training, marginals and Viterbi over many sequences at once.

An item of a sequence has some features, numbered 0..n-1; its score for a label is the sum of their weights. All
sequences advance side by side, so a step is a few array operations over those that are still long enough.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chains:
    """Sequences laid end to end. `at` are the places of the longest sequences first; `active` how many reach a step."""

    begins: np.ndarray
    active: list[int]
    size: int

    @classmethod
    def of(cls, lengths: np.ndarray) -> Chains:
        lengths = np.asarray(lengths, np.int64)
        order = np.argsort(-lengths, kind="stable")
        begins = (np.cumsum(lengths) - lengths)[order]
        longest = int(lengths.max()) if len(lengths) else 0
        active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
        return cls(begins, active.tolist(), int(lengths.sum()))


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label x next label

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Items x labels; `features` holds the features of all items in a row, `counts` how many each item has."""
        return add_up(self.weights[features], counts)


def add_up(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; a group may be empty."""
    total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _join(scores: np.ndarray) -> np.ndarray:
    """log of summed exponentials over axis 1."""
    top = scores.max(axis=1)
    return top + np.log(np.exp(scores - top[:, None]).sum(axis=1))


def forward(scores: np.ndarray, chains: Chains, moves: np.ndarray) -> np.ndarray:
    alpha = scores.copy()
    for i, n in enumerate(chains.active):
        if i:
            at = chains.begins[:n] + i
            alpha[at] += _join(alpha[at - 1][:, :, None] + moves)
    return alpha


def backward(scores: np.ndarray, chains: Chains, moves: np.ndarray) -> np.ndarray:
    beta = np.zeros_like(scores)
    for i in range(len(chains.active) - 2, -1, -1):
        at = chains.begins[: chains.active[i + 1]] + i
        ahead = scores[at + 1] + beta[at + 1]
        beta[at] = _join((moves[None] + ahead[:, None, :]).transpose(0, 2, 1))
    return beta


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of each label of each item, by forward-backward."""
    chains = Chains.of(lengths)
    both = forward(scores, chains, moves) + backward(scores, chains, moves)
    both -= both.max(axis=1, keepdims=True)
    shares = np.exp(both)
    return shares / shares.sum(axis=1, keepdims=True)


def marginals_of_two(lead: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the second of two labels for each item, from how far its score leads that of the first.

    The same forward-backward on odds. A step maps odds to a ratio between two fixed bounds, so nothing overflows.
    """
    chains, m = Chains.of(lengths), np.exp(moves - moves.max())
    odds = np.exp(np.clip(lead, -300, 300))
    ahead, behind = odds.copy(), np.ones(len(lead))
    for i, n in enumerate(chains.active):
        if i:
            at = chains.begins[:n] + i
            before = ahead[at - 1]
            ahead[at] *= (m[0, 1] + before * m[1, 1]) / (m[0, 0] + before * m[1, 0])
    for i in range(len(chains.active) - 2, -1, -1):
        at = chains.begins[: chains.active[i + 1]] + i
        after = odds[at + 1] * behind[at + 1]
        behind[at] = (m[1, 0] + after * m[1, 1]) / (m[0, 0] + after * m[0, 1])
    both = ahead * behind
    return both / (1 + both)


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Labels of the best sequence; of equal ones the one with the lower label at its last differing item."""
    chains = Chains.of(lengths)
    best, came = scores.copy(), np.zeros(scores.shape, np.int8)
    for i, n in enumerate(chains.active):
        if i:
            at = chains.begins[:n] + i
            options = best[at - 1][:, :, None] + moves
            came[at] = options.argmax(axis=1)
            best[at] += options.max(axis=1)
    labels = np.zeros(len(scores), np.int8)
    for i in range(len(chains.active) - 1, -1, -1):
        n = chains.active[i]
        longer = chains.active[i + 1] if i + 1 < len(chains.active) else 0
        ends = chains.begins[longer:n] + i
        labels[ends] = best[ends].argmax(axis=1)
        on = chains.begins[:longer] + i
        labels[on] = came[on + 1, labels[on + 1]]
    return labels


def train(
    features: np.ndarray, counts: np.ndarray, labels: np.ndarray, lengths: np.ndarray, n_features: int,
    n_labels: int = 2, weight: np.ndarray | None = None, rounds: int = 120, rate: float = 0.1, penalty: float = 1e-4,
    rows: np.ndarray | None = None,
) -> Model:
    """Maximum likelihood with an L2 penalty by full-batch Adam. `weight` weighs items' label terms, by item.

    `features` and `counts` describe the items in order, or, with `rows`, a list of kinds of items, of which `rows`
    names one for each item.

    The same rows in the same order give the same model. With no rows all weights are zero.
    """
    model = Model(np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels)))
    if not len(labels):
        return model
    lengths = np.asarray(lengths, np.int64)
    chains, owner = Chains.of(lengths), np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(lengths[lengths > 0]) - lengths[lengths > 0]
    inner = np.ones(len(labels), bool)
    inner[starts] = False
    inner = np.flatnonzero(inner)
    weight = np.ones(len(labels)) if weight is None else weight
    rows = np.arange(len(labels)) if rows is None else rows
    seen = np.eye(n_labels)[labels]
    flat = [model.weights, model.moves]
    first, second = [np.zeros_like(p) for p in flat], [np.zeros_like(p) for p in flat]
    scale = 1 / weight.sum()
    for step in range(1, rounds + 1):
        scores = model.scores(features, counts)[rows]
        alpha, beta = forward(scores, chains, model.moves), backward(scores, chains, model.moves)
        total = _join(alpha + beta)
        pull = (seen - np.exp(alpha + beta - total[:, None])) * weight[:, None]
        by_row = np.stack([np.bincount(rows, pull[:, k], len(counts)) for k in range(n_labels)], axis=1)
        by_feature = np.stack([np.bincount(features, by_row[owner, k], n_features) for k in range(n_labels)], axis=1)
        ahead = (scores + beta)[inner] - total[inner][:, None]
        pairs = np.exp(alpha[inner - 1][:, :, None] + model.moves + ahead[:, None, :])
        met = seen[inner - 1][:, :, None] * seen[inner][:, None, :]
        by_move = ((met - pairs) * weight[inner][:, None, None]).sum(axis=0)
        for p, g, m, v in zip(flat, (by_feature * scale, by_move * scale), first, second, strict=True):
            g = g - penalty * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return model
