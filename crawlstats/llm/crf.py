"""Linear-chain conditional random field over word shapes, in numpy.

A word scores each label by the fine and the coarse shape of the word before,
of itself and of the word after; neighbouring labels score by a transition
table. A word without digit, '@' and '+' is outside of every span, so a text
falls into chains of the other words, each between two such words or edges,
and likelihoods and best paths of the chains are those of the text. Training
maximises the penalised log-likelihood of short labelled rows by full-batch
Adam with gradients from forward and backward sums; decoding is Viterbi over
many chains at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

import numpy as np

#: What stands beside the first and the last word of a text.
EDGE = "#"
#: The shape of a word without digit, '@' and '+'.
PLAIN = "a"
#: Longest fine shape; longer ones are cut, as no format has so many parts.
SHAPE_CHARS = 24
OUTSIDE = 0
NEVER = -1e4

_LETTERS = re.compile(r"[^\x00-\x7f]+|[A-Za-z]+")
_DIGITS = re.compile(r"[0-9]+")
_REPEATS = re.compile(r"([^9a])\1+")


def fine_shape(word: str) -> str:
    """Letters as one 'a', digits as up to five '9', other characters once."""
    s = _LETTERS.sub("a", word[: 8 * SHAPE_CHARS])
    s = _DIGITS.sub(lambda m: "9" * min(5, len(m.group())), s)
    return _REPEATS.sub(r"\1", s)[:SHAPE_CHARS]


def coarse_shape(shape: str) -> str:
    """Runs of digits as one '9', repeated groups of digits and dots once, what follows the last letter or digit left out."""
    s = re.sub("9+", "9", shape)
    s = re.sub(r"(9[.-])\1+", r"\1", s)
    return re.sub(r"[^9a]+$", "", s) or s[:1]


def chain_labels(kinds: Sequence[str]) -> list[str]:
    return ["O", *(f"{at}-{k}" for k in kinds for at in "BI")]


def transitions_allowed(labels: Sequence[str]) -> np.ndarray:
    """allowed[a, b]: label b may follow label a; a span's inside follows only its own begin or inside."""
    return np.array([[not b.startswith("I-") or a[2:] == b[2:] and a != "O" for b in labels] for a in labels])


class Features:
    """Rows of the weight table for a shape at one of three places: fine and coarse, 0 for unknown ones."""

    def __init__(self, shapes: Counter, least: int = 2):
        coarse = Counter()
        for s, n in shapes.items():
            coarse[coarse_shape(s)] += n
        self.fine = {s: i for i, s in enumerate(sorted(s for s, n in shapes.items() if n >= least), 1)}
        self.coarse = {s: i for i, s in enumerate(sorted(s for s, n in coarse.items() if n >= least), 1 + len(self.fine))}
        self.size = 1 + len(self.fine) + len(self.coarse)

    def of(self, shape: str) -> tuple[int, int]:
        return self.fine.get(shape, 0), self.coarse.get(coarse_shape(shape), 0)


class Crf:
    def __init__(self, kinds: Sequence[str], features: Features):
        self.kinds, self.labels, self.features = list(kinds), chain_labels(kinds), features
        n = len(self.labels)
        self.weights = np.zeros((3, features.size, n))
        self.free = transitions_allowed(self.labels)
        self.transitions = np.zeros((n, n))

    # --- scores --------------------------------------------------------------

    def table(self, shapes: Sequence[str]) -> np.ndarray:
        """score[place, shape, label] of distinct shapes."""
        f = np.array([self.features.of(s) for s in shapes], dtype=np.int64).reshape(-1, 2)
        return self.weights[:, f[:, 0]] + self.weights[:, f[:, 1]]

    def moves(self) -> np.ndarray:
        return np.where(self.free, self.transitions, NEVER)

    # --- training ------------------------------------------------------------

    def fit(self, rows: Sequence[tuple[Sequence[str], Sequence[str]]], steps: int = 120, rate: float = 0.2, penalty: float = 0.02) -> Crf:
        """Learn from (shapes with the shape on either side first and last, labels of the words between)."""
        n, longest = len(rows), max(len(y) for _, y in rows)
        place = np.zeros((3, 2, n, longest), dtype=np.int64)
        gold, length = np.zeros((n, longest), dtype=np.int64), np.array([len(y) for _, y in rows])
        number = {x: i for i, x in enumerate(self.labels)}
        for i, (shapes, y) in enumerate(rows):
            f = np.array([self.features.of(s) for s in shapes]).T
            for p in range(3):
                place[p, :, i, : len(y)] = f[:, p : p + len(y)]
            gold[i, : len(y)] = [number[x] for x in y]
        inside = np.arange(longest) < length[:, None]
        hot = np.eye(len(self.labels))[gold] * inside[..., None]
        before = np.concatenate([np.full((n, 1), OUTSIDE), gold[:, :-1]], axis=1)
        seen = np.zeros_like(self.transitions)
        np.add.at(seen, (before[inside], gold[inside]), 1)
        np.add.at(seen, (gold[np.arange(n), length - 1], OUTSIDE), 1)
        params = [self.weights, self.transitions]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            score = sum(self.weights[p, place[p, k]] for p in range(3) for k in range(2))
            label, move = self._expected(score, inside, length)
            miss = hot - label
            up = np.zeros_like(self.weights)
            for p in range(3):
                for k in range(2):
                    np.add.at(up[p], place[p, k][inside], miss[inside])
            slopes = [up - penalty * self.weights, np.where(self.free, seen - move, 0) - penalty * self.transitions]
            for x, g, m, v in zip(params, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _expected(self, score: np.ndarray, inside: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels of each word and expected transitions of all rows."""
        n, longest, k = score.shape
        moves = self.moves()
        step = np.exp(moves)
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        log = lambda x: np.log(np.maximum(x, 1e-300))
        a = moves[OUTSIDE] + score[:, 0]
        for t in range(longest):
            if t:
                top = a.max(axis=1, keepdims=True)
                a = np.where(inside[:, t, None], top + log(np.exp(a - top) @ step) + score[:, t], a)
            alpha[:, t] = a
        total = alpha[np.arange(n), length - 1] + moves[:, OUTSIDE]
        top = total.max(axis=1)
        total = top + log(np.exp(total - top[:, None]).sum(axis=1))
        b = np.zeros((n, k))
        for t in range(longest - 1, -1, -1):
            end = (length - 1 == t)[:, None]
            if t + 1 < longest:
                x = score[:, t + 1] + b
                top = x.max(axis=1, keepdims=True)
                b = np.where(inside[:, t + 1, None], top + log(np.exp(x - top) @ step.T), b)
            b = np.where(end, moves[:, OUTSIDE], b)
            beta[:, t] = b
        label = np.exp(alpha + beta - total[:, None, None]) * inside[..., None]
        move = np.zeros((k, k))
        for t in range(1, longest):
            m = inside[:, t]
            x = alpha[m, t - 1][:, :, None] + moves + (score[m, t] + beta[m, t])[:, None, :] - total[m, None, None]
            move += np.exp(x).sum(axis=0)
        move[OUTSIDE] += label[:, 0].sum(axis=0)
        move[:, OUTSIDE] += label[np.arange(n), length - 1].sum(axis=0)
        return label, move

    # --- decoding ------------------------------------------------------------

    def decode(self, chains: Sequence[Sequence[str]], words: int = 1 << 16) -> list[np.ndarray]:
        """Best labels of each chain; a chain is its shapes with the shape on either side first and last."""
        distinct = sorted({s for c in chains for s in c})
        number = {s: i for i, s in enumerate(distinct)}
        table = self.table(distinct)
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(chains)
        order, at = sorted(range(len(chains)), key=lambda i: len(chains[i])), 0
        while at < len(order):
            longest, upto = len(chains[order[at]]) - 2, at + 1
            while upto < len(order) and (upto + 1 - at) * (len(chains[order[upto]]) - 2) <= words:
                longest, upto = len(chains[order[upto]]) - 2, upto + 1
            lanes = [np.array([number[s] for s in chains[i]]) for i in order[at:upto]]
            for i, y in zip(order[at:upto], self._viterbi(lanes, longest, table)):
                out[i] = y
            at = upto
        return out

    def _viterbi(self, lanes: list[np.ndarray], longest: int, table: np.ndarray) -> list[np.ndarray]:
        n, k, moves = len(lanes), len(self.labels), self.moves()
        length = np.array([len(x) - 2 for x in lanes])
        ids = np.zeros((n, longest + 2), dtype=np.int64)
        for i, x in enumerate(lanes):
            ids[i, : len(x)] = x
        back = np.zeros((longest, n, k), dtype=np.int8)
        best = np.full((n, k), NEVER)
        best[:, OUTSIDE] = 0
        for t in range(longest):
            on = length > t
            x = best[on][:, :, None] + moves
            back[t, on] = x.argmax(axis=1)
            best[on] = x.max(axis=1) + table[0, ids[on, t]] + table[1, ids[on, t + 1]] + table[2, ids[on, t + 2]]
        label = (best + moves[:, OUTSIDE]).argmax(axis=1)
        path = np.zeros((longest, n), dtype=np.int64)
        for t in range(longest - 1, -1, -1):
            on = length > t
            path[t, on] = label[on]
            label[on] = back[t, on, label[on]]
        return [path[: length[i], i] for i in range(n)]
