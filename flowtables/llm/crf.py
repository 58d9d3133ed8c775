"""Linear-chain conditional random fields in NumPy: training on a small table, Viterbi decoding of batches of chains."""

from __future__ import annotations

import numpy as np


def viterbi(scores: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The best labels of many chains at once.

    ``scores[i, y]`` is item i's score for label y; chain k has the items ``first[k]:first[k + 1]`` (at least one).
    ``start``, ``step[before, after]`` and ``end`` are the scores of borders and neighbours.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    out = np.zeros(len(scores), np.int8)
    if not len(sizes):
        return out
    back = np.zeros(scores.shape, np.int8)
    best = start + scores[begin]
    # Chains of more than t items; they come first.
    longer = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="left")
    for t in range(1, sizes[0]):
        m = longer[t]
        ways = best[:m, :, None] + step
        back[begin[:m] + t] = ways.argmax(1)
        best[:m] = ways.max(1) + scores[begin[:m] + t]
    label = (best + end).argmax(1)
    for t in range(sizes[0] - 1, -1, -1):
        at = begin[: longer[t]] + t
        out[at] = label[: len(at)]
        if t:
            label[: len(at)] = back[at, label[: len(at)]]
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    high = x.max(axis=axis, keepdims=True)
    return np.squeeze(high, axis) + np.log(np.exp(x - high).sum(axis=axis))


def fit(
    features: np.ndarray, labels: np.ndarray, first: np.ndarray, n_labels: int, steps: int = 200, ridge: float = 1e-3
) -> dict[str, np.ndarray]:
    """Weights ``emit`` (features x labels), ``start``, ``step``, ``end`` by penalised maximum likelihood.

    Full-gradient steps with momentum and per-weight scales (Adam), from zero, so equal input gives equal weights.
    """
    sizes = np.diff(first)
    n, longest = len(sizes), int(sizes.max())
    place = np.zeros((n, longest), np.int64)
    there = np.arange(longest) < sizes[:, None]
    place[there] = np.arange(len(features))
    gold = np.zeros((n, longest, n_labels))
    gold[there, labels] = 1
    last = sizes - 1
    weights = {
        "emit": np.zeros((features.shape[1], n_labels)),
        "start": np.zeros(n_labels),
        "step": np.zeros((n_labels, n_labels)),
        "end": np.zeros(n_labels),
    }
    moment = {k: np.zeros_like(v) for k, v in weights.items()}
    scale = {k: np.zeros_like(v) for k, v in weights.items()}
    rows = np.arange(n)
    gold_step = np.einsum("ntx,nty->xy", gold[:, :-1] * there[:, 1:, None], gold[:, 1:])
    for k in range(1, steps + 1):
        scores = (features @ weights["emit"])[place]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[:, 0] = weights["start"] + scores[:, 0]
        for t in range(1, longest):
            grown = _logsum(alpha[:, t - 1, :, None] + weights["step"], 1) + scores[:, t]
            alpha[:, t] = np.where(there[:, t, None], grown, alpha[:, t - 1])
        total = _logsum(alpha[rows, last] + weights["end"], 1)
        beta[rows, last] = weights["end"]
        for t in range(longest - 2, -1, -1):
            grown = _logsum(weights["step"] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where((t < last)[:, None], grown, beta[:, t])
        marginal = np.where(there[:, :, None], np.exp(alpha + beta - total[:, None, None]), 0)
        pairs = np.zeros((n_labels, n_labels))
        for t in range(longest - 1):
            m = there[:, t + 1]
            joint = alpha[m, t, :, None] + weights["step"] + (scores[m, t + 1] + beta[m, t + 1])[:, None, :]
            pairs += np.exp(joint - total[m, None, None]).sum(0)
        gradient = {
            "emit": features.T @ (gold - marginal)[there],
            "start": (gold[:, 0] - marginal[:, 0]).sum(0),
            "step": gold_step - pairs,
            "end": (gold[rows, last] - marginal[rows, last]).sum(0),
        }
        for name, w in weights.items():
            g = gradient[name] / n - ridge * w
            moment[name] = 0.9 * moment[name] + 0.1 * g
            scale[name] = 0.99 * scale[name] + 0.01 * g * g
            w += 0.1 * (moment[name] / (1 - 0.9**k)) / (np.sqrt(scale[name] / (1 - 0.99**k)) + 1e-8)
    return weights
