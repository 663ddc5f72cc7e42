"""Linear-chain conditional random fields, trained on the driver from a bounded sample.

A sequence is a list of tokens, a token a list of feature ids. The score of a labelling
is the sum of its tokens' feature weights by state and of its transitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

Tokens = Sequence[Sequence[int]]


@dataclass
class Chain:
    """``emit``: features x states; ``move``: from state x to state."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, tokens: Tokens) -> np.ndarray:
        """Tokens x states."""
        return np.array([self.emit[list(ids)].sum(axis=0) for ids in tokens]).reshape(
            len(tokens), self.emit.shape[1]
        )


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _sums(scores: np.ndarray, move: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward sums of sequences x tokens x states; ``cells`` marks the tokens.

    Behind a sequence's last token there is nothing to sum.
    """
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, scores.shape[1]):
        ahead[:, t] = scores[:, t] + _logsum(ahead[:, t - 1, :, None] + move, 1)
    for t in range(scores.shape[1] - 2, -1, -1):
        rest = _logsum(move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(cells[:, t + 1, None], rest, 0.0)
    return ahead, behind


def viterbi(scores: np.ndarray, move: np.ndarray) -> list[int]:
    """The best labelling of one sequence (tokens x states); ties go to the lower state."""
    if not len(scores):
        return []
    best, back = scores[0], []
    for row in scores[1:]:
        paths = best[:, None] + move
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    states = [int(best.argmax())]
    for choice in reversed(back):
        states.append(int(choice[states[-1]]))
    return states[::-1]


def train(
    sequences: Sequence[tuple[Tokens, Sequence[int]]],
    features: int,
    states: int,
    rounds: int = 80,
    penalty: float = 0.02,
    rate: float = 0.3,
) -> Chain:
    """Weights of largest penalised likelihood, by Adam over all sequences at once.

    Sequences should have about one length: shorter ones are filled up with tokens
    that have no features and do not count.
    """
    emit, move = np.zeros((features, states)), np.zeros((states, states))
    sequences = [s for s in sequences if len(s[0])]
    if not sequences:
        return Chain(emit, move)
    longest = max(len(tokens) for tokens, _ in sequences)
    count = sum(len(tokens) for tokens, _ in sequences)
    rows, cells, ids = [], np.zeros((len(sequences), longest), bool), []
    seen_emit, seen_move = np.zeros_like(emit), np.zeros_like(move)
    for k, (tokens, labels) in enumerate(sequences):
        cells[k, : len(tokens)] = True
        for t, (token, label) in enumerate(zip(tokens, labels)):
            rows += [k * longest + t] * len(token)
            ids += token
            seen_emit[list(token), label] += 1
            if t:
                seen_move[labels[t - 1], label] += 1
    rows, ids = np.array(rows, np.int64), np.array(ids, np.int64)
    inner = (cells[:, 1:] & cells[:, :-1])[..., None, None]
    weights = np.concatenate([emit.ravel(), move.ravel()])
    mean, power = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        emit = weights[: emit.size].reshape(emit.shape)
        move = weights[emit.size :].reshape(move.shape)
        flat = np.stack([np.bincount(rows, emit[ids, k], cells.size) for k in range(states)], 1)
        scores = flat.reshape(*cells.shape, states)
        ahead, behind = _sums(scores, move, cells)
        both = ahead + behind
        total = _logsum(both, 2)
        each = np.exp(both - total[..., None]) * cells[..., None]
        pairs = np.exp(
            ahead[:, :-1, :, None]
            + move
            + (scores[:, 1:] + behind[:, 1:])[:, :, None, :]
            - total[:, :1, None, None]
        )
        each = each.reshape(-1, states)[rows]
        want_emit = np.stack([np.bincount(ids, each[:, k], features) for k in range(states)], 1)
        want_move = (pairs * inner).sum(axis=(0, 1))
        slope = np.concatenate([(want_emit - seen_emit).ravel(), (want_move - seen_move).ravel()])
        slope = slope / count + penalty / count * weights
        mean = 0.9 * mean + 0.1 * slope
        power = 0.99 * power + 0.01 * slope**2
        weights = weights - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(power / (1 - 0.99**step)) + 1e-9
        )
    return Chain(weights[: emit.size].reshape(emit.shape), weights[emit.size :].reshape(move.shape))


def logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last one is the constant."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    keep = penalty * np.eye(x.shape[1])
    keep[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + keep @ w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, slope)
    return w
