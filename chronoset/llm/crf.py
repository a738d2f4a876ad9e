"""A linear-chain conditional random field with two tags, in numpy.

Tag 1 of word i scores `unary[i]`, tag 0 scores 0; `moves[a, b]` scores a step
from tag a to tag b and `begin[b]` the first tag of a sentence. Sentences lie
one after the other; `first[i]` is the place of word i's sentence's first word.
With two tags a message is one number, the odds of tag 1. The messages of all
sentences are passed together, word t of each at a time, longest sentences
first: as many array steps as the longest sentence has words, and work in
proportion to all words.
"""

from __future__ import annotations

import numpy as np


def forward_backward(unary: np.ndarray, first: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(tag 1) of each word, and P(tag a before, tag b) of each word that has a word before it."""
    n = len(unary)
    if not n:
        return np.empty(0), np.empty((2, 2, 0))
    e = np.exp(np.clip(unary, -30, 30))
    (m00, m01), (m10, m11) = np.exp(moves - moves.max())
    at = np.arange(n)
    starts = np.flatnonzero(first == at)
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    # sentences longer than t come first
    longer = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    ahead, behind = np.empty(n), np.ones(n)
    now = np.exp(begin[1] - begin[0]) * e[starts]
    ahead[starts] = now
    for t in range(1, len(longer)):
        i, now = starts[: longer[t]] + t, now[: longer[t]]
        now = e[i] * (m01 + now * m11) / (m00 + now * m10)
        ahead[i] = now
    for t in range(len(longer) - 1, 0, -1):
        i = starts[: longer[t]] + t
        x = e[i] * behind[i]
        behind[i - 1] = (m10 + m11 * x) / (m00 + m01 * x)
    odds = ahead * behind
    rest = np.flatnonzero(first != at)
    a, x = ahead[rest - 1], e[rest] * behind[rest]
    edge = np.stack([np.stack([np.full(len(rest), m00), m01 * x]), np.stack([m10 * a, m11 * a * x])])
    return odds / (1 + odds), edge / edge.sum((0, 1))


class Tagger:
    """Weights of hashed features and of tag steps.

    `table[t]` are the feature numbers of word type t: the first columns fire
    for the word itself, the last two for the word before and the word after.
    """

    def __init__(self, dims: int):
        self.weights, self.moves, self.begin, self.bias = np.zeros(dims), np.zeros((2, 2)), np.zeros(2), -2.0

    def unary(self, table: np.ndarray, types: np.ndarray, first: np.ndarray) -> np.ndarray:
        own = self.weights[table[:, :-2]].sum(1)
        before, after = self.weights[table[:, -2]], self.weights[table[:, -1]]
        u = self.bias + own[types]
        rest = np.flatnonzero(first != np.arange(len(types)))
        u[rest] += before[types[rest - 1]]
        u[rest - 1] += after[types[rest]]
        return u

    def marginals(self, table: np.ndarray, types: np.ndarray, first: np.ndarray) -> np.ndarray:
        return forward_backward(self.unary(table, types, first), first, self.moves, self.begin)[0]

    def fit(self, table: np.ndarray, types: np.ndarray, first: np.ndarray, tags: np.ndarray, weight: np.ndarray,
            rounds: int = 60, rate: float = 0.4, decay: float = 1e-6) -> Tagger:
        """Full-gradient descent of the weighted negative log likelihood, with per-weight step sizes (AdaGrad)."""
        n_types = len(table)
        rest = np.flatnonzero(first != np.arange(len(types)))
        begins = np.flatnonzero(first == np.arange(len(types)))
        total = weight.sum() or 1.0
        seen_moves = np.zeros((2, 2))
        np.add.at(seen_moves, (tags[rest - 1], tags[rest]), weight[rest])
        seen_begin = np.bincount(tags[begins], weight[begins], 2)
        memory = [np.full_like(x, 1e-12) for x in (self.weights, self.moves, self.begin)] + [1e-12]
        for _ in range(rounds):
            node, edge = forward_backward(self.unary(table, types, first), first, self.moves, self.begin)
            miss = (node - tags) * weight / total
            per_type = [np.bincount(types, miss, n_types), np.bincount(types[rest - 1], miss[rest], n_types), np.bincount(types[rest], miss[rest - 1], n_types)]
            pull = decay * self.weights
            for k in range(table.shape[1] - 2):
                pull += np.bincount(table[:, k], per_type[0], len(self.weights))
            pull += np.bincount(table[:, -2], per_type[1], len(self.weights)) + np.bincount(table[:, -1], per_type[2], len(self.weights))
            pulls = [pull, ((edge * weight[rest]).sum(2) - seen_moves) / total,
                     (np.array([(weight[begins] * (1 - node[begins])).sum(), (weight[begins] * node[begins]).sum()]) - seen_begin) / total, miss.sum()]
            for k, g in enumerate(pulls):
                memory[k] = memory[k] + g * g
            self.weights -= rate * pulls[0] / np.sqrt(memory[0])
            self.moves -= rate * pulls[1] / np.sqrt(memory[1])
            self.begin -= rate * pulls[2] / np.sqrt(memory[2])
            self.bias -= rate * pulls[3] / np.sqrt(memory[3])
        return self
