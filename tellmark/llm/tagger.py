"""A character tagger in numpy: bidirectional LSTM with CRF transitions, trained by Adam."""
from __future__ import annotations

import numpy as np

#: Printable ASCII one by one, then letters, digits and all else beyond ASCII, then padding.
LETTER, DIGIT, OTHER, PAD = 95, 96, 97, 98
SIZE = 99


def char_ids(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ids = np.where((points >= 32) & (points < 127), points - 32, OTHER)
    for i in np.flatnonzero(points > 127).tolist():
        c = text[i]
        ids[i] = LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER
    return ids


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def new_weights(tags: int, embedding: int = 12, hidden: int = 16, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"embedding": draw(SIZE, embedding) * 3, "out": draw(2 * hidden, tags), "out_bias": np.zeros(tags, np.float32),
         "moves": np.zeros((tags, tags), np.float32), "first": np.zeros(tags, np.float32)}
    for side in ("left", "right"):
        w |= {f"{side}_in": draw(embedding, 4 * hidden), f"{side}_back": draw(hidden, 4 * hidden), f"{side}_bias": np.zeros(4 * hidden, np.float32)}
        w[f"{side}_bias"][hidden : 2 * hidden] = 1  # remember by default
    return w


def _lstm(x: np.ndarray, w_in: np.ndarray, w_back: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, tuple]:
    batch, steps, _ = x.shape
    hidden = w_back.shape[0]
    z = x @ w_in + bias
    h, c = np.zeros((batch, hidden), x.dtype), np.zeros((batch, hidden), x.dtype)
    gates, cells, hs = np.empty_like(z), np.empty((batch, steps, hidden), x.dtype), np.empty((batch, steps, hidden), x.dtype)
    for t in range(steps):
        g = z[:, t] + h @ w_back
        g[:, : 3 * hidden] = sigmoid(g[:, : 3 * hidden])
        g[:, 3 * hidden :] = np.tanh(g[:, 3 * hidden :])
        c = g[:, hidden : 2 * hidden] * c + g[:, :hidden] * g[:, 3 * hidden :]
        h = g[:, 2 * hidden : 3 * hidden] * np.tanh(c)
        gates[:, t], cells[:, t], hs[:, t] = g, c, h
    return hs, (x, gates, cells, hs)


def _lstm_grads(dh_all: np.ndarray, kept: tuple, w_in: np.ndarray, w_back: np.ndarray) -> tuple[np.ndarray, ...]:
    x, gates, cells, hs = kept
    batch, steps, hidden = hs.shape
    dz = np.empty_like(gates)
    dh, dc = np.zeros((batch, hidden), x.dtype), np.zeros((batch, hidden), x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g = (gates[:, t, k * hidden : (k + 1) * hidden] for k in range(4))
        squashed = np.tanh(cells[:, t])
        dh = dh + dh_all[:, t]
        dc = dc + dh * o * (1 - squashed * squashed)
        before = cells[:, t - 1] if t else np.zeros_like(dc)
        dz[:, t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], 1)
        dh, dc = dz[:, t] @ w_back.T, dc * f
    flat = dz.reshape(-1, 4 * hidden)
    earlier = np.concatenate([np.zeros((batch, 1, hidden), x.dtype), hs[:, :-1]], 1).reshape(-1, hidden)
    return dz @ w_in.T, x.reshape(-1, x.shape[2]).T @ flat, earlier.T @ flat, flat.sum(0)


def emissions(w: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Scores (batch, steps, tags) of windows of character ids."""
    x = w["embedding"][ids]
    left, a = _lstm(x, w["left_in"], w["left_back"], w["left_bias"])
    right, b = _lstm(x[:, ::-1], w["right_in"], w["right_back"], w["right_bias"])
    h = np.concatenate([left, right[:, ::-1]], 2)
    return h @ w["out"] + w["out_bias"], (h, a, b)


def crf_loss(scores: np.ndarray, tags: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood and its gradients for scores, moves and first."""
    batch, steps, k = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = first + scores[:, 0]
    for t in range(1, steps):
        alpha[:, t] = logsumexp(alpha[:, t - 1, :, None] + moves, 1) + scores[:, t]
    for t in range(steps - 2, -1, -1):
        beta[:, t] = logsumexp(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = logsumexp(alpha[:, -1], 1)
    rows, at = np.arange(batch)[:, None], np.arange(steps)
    marginal = np.exp(alpha + beta - total[:, None, None])
    pairs = np.exp(alpha[:, :-1, :, None] + moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]).sum((0, 1))
    gold = scores[rows, at, tags].sum(1) + first[tags[:, 0]] + moves[tags[:, :-1], tags[:, 1:]].sum(1)
    d_scores = marginal.copy()
    d_scores[rows, at, tags] -= 1
    d_moves = pairs
    np.subtract.at(d_moves, (tags[:, :-1], tags[:, 1:]), 1)
    d_first = marginal[:, 0].sum(0)
    np.subtract.at(d_first, tags[:, 0], 1)
    return float((total - gold).mean()), d_scores / batch, d_moves / batch, d_first / batch


def gradients(w: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    scores, (h, a, b) = emissions(w, ids)
    loss, ds, d_moves, d_first = crf_loss(scores, tags, w["moves"], w["first"])
    hidden = w["left_back"].shape[0]
    g = {"out": h.reshape(-1, 2 * hidden).T @ ds.reshape(-1, ds.shape[2]), "out_bias": ds.sum((0, 1)), "moves": d_moves, "first": d_first}
    dh = ds @ w["out"].T
    dx, g["left_in"], g["left_back"], g["left_bias"] = _lstm_grads(dh[:, :, :hidden], a, w["left_in"], w["left_back"])
    dr, g["right_in"], g["right_back"], g["right_bias"] = _lstm_grads(dh[:, ::-1, hidden:], b, w["right_in"], w["right_back"])
    g["embedding"] = np.zeros_like(w["embedding"])
    np.add.at(g["embedding"], ids, dx + dr[:, ::-1])
    return loss, g


def train(ids: np.ndarray, tags: np.ndarray, n_tags: int, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights fitted to windows (n, steps) and their tags; the same input gives the same weights."""
    w, rng = new_weights(n_tags, seed=seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for _ in range(epochs if len(ids) else 0):
        order = rng.permutation(len(ids))
        for s in range(0, len(ids), batch):
            at, step = order[s : s + batch], step + 1
            _, g = gradients(w, ids[at], tags[at])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k, x in g.items():
                x = x * min(1.0, 5.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * x
                second[k] = 0.999 * second[k] + 0.001 * x * x
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return w


def decode(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best tag path of each row of (batch, steps, tags)."""
    batch, steps, k = scores.shape
    best, back = first + scores[:, 0], np.empty((batch, steps, k), np.int8)
    for t in range(1, steps):
        options = best[:, :, None] + moves
        back[:, t] = options.argmax(1)
        best = options.max(1) + scores[:, t]
    out = np.empty((batch, steps), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[np.arange(batch), t, out[:, t]]
    return out
