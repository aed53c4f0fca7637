"""A character-level bidirectional LSTM with a CRF on top, in numpy.

All windows of a batch go through the time steps together, and both directions in one step. Training
is Adam on the CRF's negative log likelihood with gradients written out by hand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Shape:
    symbols: int
    tags: int
    embedding: int = 12
    hidden: int = 24


def initial(shape: Shape, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    e, h, k = shape.embedding, shape.hidden, shape.tags
    bias = np.zeros((2, 1, 4 * h))
    bias[:, :, h : 2 * h] = 1.0  # forget gates start open
    return {
        "embed": draw.normal(0, 0.3, (shape.symbols, e)),
        "w": draw.normal(0, 1 / np.sqrt(e + h), (2, e + h, 4 * h)),
        "b": bias,
        "out": draw.normal(0, 0.2, (2 * h, k)),
        "out_b": np.zeros(k),
        "move": draw.normal(0, 0.1, (k, k)),  # CRF transitions from row to column
        "first": np.zeros(k),
        "last": np.zeros(k),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _forward(p: dict[str, np.ndarray], symbols: np.ndarray, keep: bool) -> tuple[np.ndarray, list, np.ndarray]:
    """Emission scores (batch, time, tags); what the backward pass needs if ``keep``."""
    n, steps = symbols.shape
    h = p["w"].shape[2] // 4
    both = np.stack([symbols, symbols[:, ::-1]])  # direction, batch, time
    x = p["embed"][both]
    state, cell = np.zeros((2, n, h)), np.zeros((2, n, h))
    hidden, cache = np.zeros((2, n, steps, h)), []
    for t in range(steps):
        inside = np.concatenate([x[:, :, t], state], axis=2)
        gates = inside @ p["w"] + p["b"]
        ifo, g = _sigmoid(gates[:, :, : 3 * h]), np.tanh(gates[:, :, 3 * h :])
        before, cell = cell, ifo[:, :, h : 2 * h] * cell + ifo[:, :, :h] * g
        bent = np.tanh(cell)
        state = ifo[:, :, 2 * h :] * bent
        hidden[:, :, t] = state
        if keep:
            cache.append((inside, ifo, g, before, bent))
    features = np.concatenate([hidden[0], hidden[1][:, ::-1]], axis=2)
    return features @ p["out"] + p["out_b"], cache, features


def emissions(p: dict[str, np.ndarray], symbols: np.ndarray) -> np.ndarray:
    return _forward(p, symbols, False)[0]


def viterbi(p: dict[str, np.ndarray], scores: np.ndarray) -> np.ndarray:
    """The best tag sequence of every window (batch, time)."""
    n, steps, k = scores.shape
    best, back = scores[:, 0] + p["first"], np.zeros((steps, n, k), np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + p["move"]
        back[t] = through.argmax(1)
        best = through.max(1) + scores[:, t]
    tags = np.zeros((n, steps), np.int8)
    tags[:, -1] = (best + p["last"]).argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
    return tags


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _crf(p: dict[str, np.ndarray], scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
    """Mean negative log likelihood and its gradients, by forward and backward sums."""
    n, steps, k = scores.shape
    ahead, behind = np.zeros((steps, n, k)), np.zeros((steps, n, k))
    ahead[0] = scores[:, 0] + p["first"]
    for t in range(1, steps):
        ahead[t] = _lse(ahead[t - 1][:, :, None] + p["move"], 1) + scores[:, t]
    behind[-1] = p["last"]
    for t in range(steps - 2, -1, -1):
        behind[t] = _lse(p["move"] + (scores[:, t + 1] + behind[t + 1])[:, None, :], 2)
    total = _lse(ahead[-1] + p["last"], 1)
    rows, times = np.arange(n), np.arange(steps)
    gold = scores[rows[:, None], times, tags].sum(1) + p["move"][tags[:, :-1], tags[:, 1:]].sum(1)
    gold += p["first"][tags[:, 0]] + p["last"][tags[:, -1]]
    expected = np.exp(ahead + behind - total[:, None]).transpose(1, 0, 2)  # batch, time, tags
    hot = np.zeros_like(scores)
    hot[rows[:, None], times, tags] = 1
    pairs = np.exp(ahead[:-1, :, :, None] + p["move"] + (scores[:, 1:].transpose(1, 0, 2) + behind[1:])[:, :, None, :] - total[:, None, None])
    moved = np.zeros((k, k))
    np.add.at(moved, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    d_scores = (expected - hot) / n
    grads = {"move": (pairs.sum((0, 1)) - moved) / n, "first": d_scores[:, 0].sum(0), "last": d_scores[:, -1].sum(0)}
    return float((total - gold).mean()), d_scores, grads


def loss_and_gradients(p: dict[str, np.ndarray], symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    n, steps = symbols.shape
    h = p["w"].shape[2] // 4
    scores, cache, features = _forward(p, symbols, True)
    loss, d_scores, grads = _crf(p, scores, tags)
    grads["out"] = features.reshape(-1, 2 * h).T @ d_scores.reshape(-1, scores.shape[2])
    grads["out_b"] = d_scores.sum((0, 1))
    d_features = d_scores @ p["out"].T
    d_hidden = np.stack([d_features[:, :, :h], d_features[:, ::-1, h:]])
    grads["w"], grads["b"] = np.zeros_like(p["w"]), np.zeros_like(p["b"])
    e = p["embed"].shape[1]
    d_x = np.zeros((2, n, steps, e))
    d_state, d_cell = np.zeros((2, n, h)), np.zeros((2, n, h))
    flipped = p["w"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        inside, ifo, g, before, bent = cache[t]
        i, f, o = ifo[:, :, :h], ifo[:, :, h : 2 * h], ifo[:, :, 2 * h :]
        d_state = d_state + d_hidden[:, :, t]
        d_cell = d_cell + d_state * o * (1 - bent**2)
        d_gates = np.concatenate([d_cell * g * i * (1 - i), d_cell * before * f * (1 - f), d_state * bent * o * (1 - o), d_cell * i * (1 - g**2)], axis=2)
        grads["w"] += inside.transpose(0, 2, 1) @ d_gates
        grads["b"] += d_gates.sum(1, keepdims=True)
        d_inside = d_gates @ flipped
        d_x[:, :, t], d_state = d_inside[:, :, :e], d_inside[:, :, e:]
        d_cell = d_cell * f
    grads["embed"] = np.zeros_like(p["embed"])
    np.add.at(grads["embed"], np.stack([symbols, symbols[:, ::-1]]), d_x)
    return loss, grads


def train(symbols: np.ndarray, tags: np.ndarray, shape: Shape, steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 3) -> dict[str, np.ndarray]:
    """Adam with gradient clipping and a falling rate; the same input gives the same model."""
    p, draw = initial(shape, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        rows = draw.integers(0, len(symbols), batch)
        _, grads = loss_and_gradients(p, symbols[rows], tags[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale, now = min(1.0, 5.0 / max(norm, 1e-9)), rate * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = g * scale
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            p[k] = p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return p
