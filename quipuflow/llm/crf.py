"""A linear-chain conditional random field over sequences of feature lists."""

from __future__ import annotations

from collections.abc import Callable, Hashable

import numpy as np


class Crf:
    """Labels of a sequence; trained by stochastic gradient on the likelihood, decoded by Viterbi.

    A place may have no label: the likelihood then sums over all labels it could have.
    """

    def __init__(self, labels: tuple[str, ...]):
        self.labels = labels
        self.index: dict[str, int] = {}
        self.emit = np.zeros((0, len(labels)))
        self.move = np.zeros((len(labels), len(labels)))
        self.met: dict[Hashable, list[float]] = {}  # scores of descriptions met, of which there are few different ones

    def _ids(self, features: list[str]) -> list[int]:
        return [self.index[f] for f in features if f in self.index]

    def fit(self, sequences: list[list[list[str]]], tags: list[list[str | None]], epochs: int = 5, rate: float = 0.5, seed: int = 7) -> "Crf":
        for seq in sequences:
            for features in seq:
                for f in features:
                    self.index.setdefault(f, len(self.index))
        n = len(self.labels)
        self.emit = np.zeros((len(self.index), n))
        ge, gm = np.full_like(self.emit, 1e-2), np.full_like(self.move, 1e-2)
        data = []
        for seq, tag in zip(sequences, tags):
            if seq and any(t is not None for t in tag):
                data.append(([self._ids(f) for f in seq], np.array([[t is None or t == x for x in self.labels] for t in tag], dtype=float), all(t is not None for t in tag)))
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in order.permutation(len(data)):
                ids, allowed, whole = data[k]
                s = self._scores(ids)
                node, pair = self._marginals(s)
                if whole:
                    want = allowed
                    seen = want[:-1].T @ want[1:]
                else:
                    want, seen = self._marginals(s, allowed)
                d = want - node
                for x, g in zip(ids, d):
                    ge[x] += g * g
                    self.emit[x] += rate * g / np.sqrt(ge[x])
                if len(ids) > 1:
                    g = seen - pair
                    gm += g * g
                    self.move += rate * g / np.sqrt(gm)
        return self

    def _scores(self, ids: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[x].sum(axis=0) if x else np.zeros(len(self.labels)) for x in ids])

    def _marginals(self, s: np.ndarray, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Chances of labels and, summed over the sequence, of pairs of labels; of the allowed labels only."""
        if allowed is not None:
            s = np.where(allowed > 0, s, -np.inf)
        e = np.exp(s - s.max(axis=1, keepdims=True))
        m = np.exp(self.move - self.move.max())
        a, b = np.empty_like(e), np.ones_like(e)
        a[0] = e[0] / e[0].sum()
        for t in range(1, len(e)):
            x = (a[t - 1] @ m) * e[t]
            a[t] = x / x.sum()
        for t in range(len(e) - 2, -1, -1):
            x = m @ (e[t + 1] * b[t + 1])
            b[t] = x / x.sum()
        node = a * b
        node /= node.sum(axis=1, keepdims=True)
        right = e[1:] * b[1:]
        weight = ((a[:-1] @ m) * right).sum(axis=1)
        pair = ((a[:-1] / weight[:, None]).T @ right) * m
        return node, pair

    def decode(self, sequence: list, features: Callable[[Hashable], list[str]] | None = None) -> list[str]:
        """Best labels of a sequence of feature lists, or of descriptions from which `features` makes them."""
        if not sequence:
            return []
        if features is None:
            s = self._scores([self._ids(f) for f in sequence]).tolist()
        else:
            s = []
            for d in sequence:
                if d not in self.met:
                    self.met[d] = self._scores([self._ids(features(d))])[0].tolist()
                s.append(self.met[d])
        move = self.move.T.tolist()
        best, back = s[0], []
        for row in s[1:]:
            step = []
            new = []
            for into, score in zip(move, row):
                reach = [x + y for x, y in zip(best, into)]
                top = max(reach)
                step.append(reach.index(top))
                new.append(top + score)
            back.append(step)
            best = new
        y = [best.index(max(best))]
        for k in reversed(back):
            y.append(k[y[-1]])
        return [self.labels[i] for i in reversed(y)]
