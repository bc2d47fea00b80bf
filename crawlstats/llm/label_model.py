"""A generative label model over voters, and a linear classifier on its posteriors.

Votes are +1, -1 or 0 (abstains). The model holds, per voter and class, the
probabilities of the three votes, and the prior of the class; expectation and
maximisation alternate from a starting posterior. Voters that say the same
things are not independent evidence: their correlation within the classes is
estimated as well, and a voter counts by one over the evidence that it shares.
The first voter is the annotator who labelled the rows, fallible like the rest.
"""

from __future__ import annotations

import numpy as np

VOTES = (-1, 0, 1)
#: Prior for the annotator: right labels, as a multiple of the rows.
ANNOTATOR = 1.0


class LabelModel:
    def __init__(self, rounds: int = 25, smoothing: float = 1.0):
        self.rounds, self.smoothing = rounds, smoothing

    def fit(self, votes: np.ndarray, start: np.ndarray) -> LabelModel:
        """``votes`` rows x voters, the first an annotator's labels; ``start`` first posteriors."""
        one_hot = np.stack([votes == v for v in VOTES], axis=-1).astype(np.float64)
        post = start.astype(np.float64)
        self.weight = np.ones(votes.shape[1])
        for _ in range(self.rounds):
            self._maximise(one_hot, post)
            self._correlate(votes, post)
            new = self.posterior(votes)
            done = np.abs(new - post).max(initial=0) < 1e-4
            post = new
            if done:
                break
        return self

    def _maximise(self, one_hot: np.ndarray, post: np.ndarray) -> None:
        s = self.smoothing
        self.prior = (post.sum() + s) / (len(post) + 2 * s)
        per_class = [np.einsum("r,rvk->vk", p, one_hot) for p in (1 - post, post)]
        for c, right in zip(per_class, (0, 2)):  # the annotator's prior: seldom wrong
            c[0, right] += ANNOTATOR * len(post)
        self.log_p = np.log(np.stack([(c + s) / (c.sum(axis=1, keepdims=True) + 3 * s) for c in per_class]))

    def _correlate(self, votes: np.ndarray, post: np.ndarray) -> None:
        """Shared evidence: squared correlations of the votes within the classes, averaged by class."""
        shared = np.zeros((votes.shape[1], votes.shape[1]))
        for p in (1 - post, post):
            total = p.sum()
            if total < 2:
                continue
            centred = votes - (p @ votes) / total
            cov = (centred * p[:, None]).T @ centred / total
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            shared += (cov / np.outer(sd, sd)) ** 2 * (total / len(post))
        np.fill_diagonal(shared, 1.0)
        self.correlation, self.weight = shared, 1 / shared.sum(axis=1)
        self.weight[0] = 1.0  # the annotator saw the text, not the voters

    def accuracies(self) -> np.ndarray:
        """Per voter: the probability that a vote that is not 0 is right."""
        p = np.exp(self.log_p)
        right = p[0, :, 0] * (1 - self.prior) + p[1, :, 2] * self.prior
        wrong = p[0, :, 2] * (1 - self.prior) + p[1, :, 0] * self.prior
        return right / (right + wrong)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = self.log_p[1] - self.log_p[0]
        evidence = np.take_along_axis(ratio, (votes.T + 1).astype(np.int64), axis=1).T @ self.weight
        z = np.log(self.prior) - np.log1p(-self.prior) + evidence
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(start: np.ndarray, feature: np.ndarray, target: np.ndarray, width: int, *, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a logistic regression on soft targets.

    Row r has the features ``feature[start[r]:start[r + 1]]``. Both classes
    weigh the same, so that 0.5 is a fair cut. Adam on the whole sample.
    """
    rows = len(start) - 1
    row = np.repeat(np.arange(rows), np.diff(start))
    positive = target.sum()
    cost = target / max(2 * positive, 1e-9) + (1 - target) / max(2 * (rows - positive), 1e-9)
    w, m, s = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[feature], minlength=rows) + w[width]
        err = cost * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        g = np.bincount(feature, weights=err[row], minlength=width + 1) + decay * w
        g[width] = err.sum()
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return w
