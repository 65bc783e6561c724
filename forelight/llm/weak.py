"""A generative model of labellers that vote, abstain and agree by chance.

Votes are 1, -1 or 0 (abstains). Expectation-maximisation over counts of vote
patterns estimates, for each true class, how often each labeller casts each
vote. Labellers that agree beyond what the class explains are correlated; their
evidence is shared out, so that ten copies of one labeller don't count as ten.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class LabelModel:
    prior: float
    log_odds: np.ndarray  # labellers x votes (-1, 0, 1): evidence for the class
    accuracy: np.ndarray  # of each labeller where it votes
    correlation: np.ndarray  # between labellers, given the class

    def logit(self, votes: np.ndarray) -> np.ndarray:
        votes = np.atleast_2d(votes)
        bias = np.log(self.prior) - np.log1p(-self.prior)
        return bias + self.log_odds[np.arange(votes.shape[1])[None, :], votes + 1].sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(votes), -30, 30)))


def fit(votes: np.ndarray, counts: np.ndarray, prior: float = 0.5, rounds: int = 60, smooth: float = 1.0, start: np.ndarray | None = None, apart: tuple[int, ...] = ()) -> LabelModel:
    """EM from a start at which every vote is strong evidence.

    ``votes``: patterns x labellers; ``counts``: how often each pattern occurs.
    ``start``: first beliefs instead, which also hold the prior where it is:
    for classes that are rare and known in part, which EM would else widen.
    ``apart``: labellers that judge on their own account, so that agreeing with
    others takes nothing of their say.
    """
    votes, counts = np.asarray(votes, np.int64), np.asarray(counts, float)
    n, m = votes.shape if votes.ndim == 2 else (0, 0)
    if not n or not counts.sum():
        return LabelModel(prior, np.zeros((m, 3)), np.full(m, 0.5), np.zeros((m, m)))
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    # Labellers that vote alike throughout are copies; they share one say from the start, or they would be the class.
    centred = votes - np.average(votes, axis=0, weights=counts)
    cov = (centred * counts[:, None]).T @ centred / counts.sum()
    sd = np.sqrt(np.diag(cov)) + 1e-9
    alike = np.clip((cov / np.outer(sd, sd) - 0.7) / 0.3, 0, 1)
    np.fill_diagonal(alike, 0)
    own = 1 / (1 + alike.sum(axis=1))
    belief = start if start is not None else 1 / (1 + np.exp(-np.clip(4 * votes @ own + np.log(prior / (1 - prior)), -30, 30)))
    model = None
    for _ in range(rounds):
        yes, no = counts * belief, counts * (1 - belief)
        # Before any count, wrong votes are ten times as rare as others: labellers mean what they say.
        p = (np.einsum("n,nmv->mv", yes, hot) + smooth * np.array([0.1, 1, 1])) / (yes.sum() + 2.1 * smooth)
        q = (np.einsum("n,nmv->mv", no, hot) + smooth * np.array([1, 1, 0.1])) / (no.sum() + 2.1 * smooth)
        prior = prior if start is not None else float(np.clip((yes.sum() + smooth) / (counts.sum() + 2 * smooth), 1e-4, 1 - 1e-4))
        # What is left of each vote once the class is known, and how much it moves with others'.
        signs = np.array([-1.0, 0.0, 1.0])
        rest = votes - belief[:, None] * (p @ signs) - (1 - belief[:, None]) * (q @ signs)
        cov = (rest * counts[:, None]).T @ rest / counts.sum()
        sd = np.sqrt(np.diag(cov)) + 1e-9
        corr = np.clip(cov / np.outer(sd, sd), -1, 1)
        np.fill_diagonal(corr, 0)
        share = np.minimum(own, 1 / (1 + np.clip(corr - 0.1, 0, None).sum(axis=1)))
        share[list(apart)] = 1
        model = LabelModel(prior, (np.log(p) - np.log(q)) * share[:, None], (prior * p[:, 2] + (1 - prior) * q[:, 0]) / np.maximum(prior * (p[:, 0] + p[:, 2]) + (1 - prior) * (q[:, 0] + q[:, 2]), 1e-9), corr)
        new = model.posterior(votes)
        if np.abs(new - belief).max() < 1e-6:
            break
        belief = new
    return model


def logistic(features: np.ndarray, targets: np.ndarray, weights: np.ndarray, l2: float = 1e-3, rounds: int = 300) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression on soft targets, by Newton steps on dense features."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    weights = weights / max(weights.sum(), 1e-9)
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - targets)) + ridge * w
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def hashed_logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, targets: np.ndarray, dims: int, weights: np.ndarray | None = None, l2: float = 1e-4, rounds: int = 300, rate: float = 0.5) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression over sparse hashed features, by Adam on whole batches."""
    n = len(targets)
    weights = np.ones(n) / n if weights is None else weights / weights.sum()
    w, m, v = np.zeros(dims + 1), np.zeros(dims + 1), np.zeros(dims + 1)
    for t in range(1, rounds + 1):
        score = np.bincount(rows, values * w[columns], n) + w[-1]
        gap = weights * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - targets)
        slope = np.append(np.bincount(columns, values * gap[rows], dims) + l2 * w[:-1], gap.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w -= rate * 0.98 ** (t / 3) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
    return w
