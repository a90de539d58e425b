"""A character-level bidirectional LSTM with a CRF on top, in numpy: training and batched decoding.

Arrays are time-major: inputs (T, B) of character ids, states (T, B, H), emissions (T, B, K). The model is a dict of
small float32 arrays (a few tens of kilobytes), so it can travel with a task.
"""

from __future__ import annotations

import numpy as np

Model = dict[str, np.ndarray]


def new_model(n_chars: int, n_tags: int, embed: int = 16, hidden: int = 24, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    g = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    m = {"E": g(n_chars, embed) * 2, "Wo": g(2 * hidden, n_tags), "bo": np.zeros(n_tags, np.float32),
         "A": np.zeros((n_tags, n_tags), np.float32), "s": np.zeros(n_tags, np.float32)}
    for d in "fb":
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden:2 * hidden] = 1  # forget gates begin open
        m |= {f"Wx{d}": g(embed, 4 * hidden), f"Wh{d}": g(hidden, 4 * hidden), f"b{d}": bias}
    return m


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(pre: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction; ``pre`` (T, B, 4H) are the gates' inputs in the order input, forget, output, cell."""
    t_max, batch, h4 = pre.shape
    n = h4 // 4
    h, c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
    out, cache = np.empty((t_max, batch, n), np.float32), []
    for t in range(t_max):
        z = pre[t] + h @ wh
        gates = _sigmoid(z[:, :3 * n])
        g = np.tanh(z[:, 3 * n:])
        i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        cache.append((h, c, i, f, o, g, tc))
        h, c = o * tc, c_new
        out[t] = h
    return out, cache


def _lstm_back(d_out: np.ndarray, cache: list, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of ``wh``."""
    t_max, batch, n = d_out.shape
    d_pre, d_wh = np.empty((t_max, batch, 4 * n), np.float32), np.zeros_like(wh)
    dh, dc = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
    for t in range(t_max - 1, -1, -1):
        h, c, i, f, o, g, tc = cache[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = d_pre[t]
        dz[:, :n] = dc * g * i * (1 - i)
        dz[:, n:2 * n] = dc * c * f * (1 - f)
        dz[:, 2 * n:3 * n] = dh * tc * o * (1 - o)
        dz[:, 3 * n:] = dc * i * (1 - g * g)
        d_wh += h.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return d_pre, d_wh


def emissions(m: Model, x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Tag scores (T, B, K) of character ids (T, B)."""
    hf, cf = _lstm((m["E"] @ m["Wxf"] + m["bf"])[x], m["Whf"])
    hb, cb = _lstm((m["E"] @ m["Wxb"] + m["bb"])[x[::-1]], m["Whb"])
    h = np.concatenate([hf, hb[::-1]], axis=2)
    return h @ m["Wo"] + m["bo"], (h, cf, cb)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf_gradient(m: Model, e: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood and its gradients by emissions, transitions and start, by forward-backward."""
    t_max, batch, k = e.shape
    a, s = m["A"].astype(np.float64), m["s"].astype(np.float64)
    e = e.astype(np.float64)
    alpha, beta = np.empty((t_max, batch, k)), np.zeros((t_max, batch, k))
    alpha[0] = s + e[0]
    for t in range(1, t_max):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + a, 1) + e[t]
    for t in range(t_max - 2, -1, -1):
        beta[t] = _lse(a[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _lse(alpha[-1], 1)
    de = np.exp(alpha + beta - z[None, :, None])
    da = np.zeros_like(a)
    for t in range(1, t_max):
        da += np.exp(alpha[t - 1][:, :, None] + a + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
    ds = de[0].sum(0)
    rows, times = np.arange(batch), np.arange(t_max)[:, None]
    gold = e[times, rows[None], y].sum(0) + s[y[0]] + a[y[:-1], y[1:]].sum(0)
    np.subtract.at(de, (times, rows[None], y), 1)
    np.subtract.at(da, (y[:-1], y[1:]), 1)
    np.subtract.at(ds, y[0], 1)
    return float((z - gold).mean()), (de / batch).astype(np.float32), (da / batch).astype(np.float32), \
        (ds / batch).astype(np.float32)


def gradient(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, Model]:
    e, (h, cf, cb) = emissions(m, x)
    loss, de, da, ds = _crf_gradient(m, e, y)
    n = m["Whf"].shape[0]
    g = {"A": da, "s": ds, "bo": de.sum((0, 1)), "Wo": np.einsum("tbh,tbk->hk", h, de, optimize=True)}
    dh = de @ m["Wo"].T
    g["E"] = np.zeros_like(m["E"])
    for d, part, cache, ids in (("f", dh[:, :, :n], cf, x), ("b", dh[::-1, :, n:], cb, x[::-1])):
        d_pre, g[f"Wh{d}"] = _lstm_back(np.ascontiguousarray(part), cache, m[f"Wh{d}"])
        flat = d_pre.reshape(-1, d_pre.shape[2])
        by_char = np.zeros((len(m["E"]), flat.shape[1]), np.float32)
        np.add.at(by_char, ids.reshape(-1), flat)
        g[f"b{d}"] = flat.sum(0)
        g[f"Wx{d}"] = m["E"].T @ by_char
        g["E"] += by_char @ m[f"Wx{d}"].T
    return loss, g


def train(m: Model, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 32, rate: float = 0.01, seed: int = 5
          ) -> list[float]:
    """Adam over shuffled batches of windows (N, T); returns the mean loss of each epoch."""
    rng, losses, step = np.random.default_rng(seed), [], 0
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    for epoch in range(epochs):
        order, total = rng.permutation(len(x)), 0.0
        now = rate * (1 - 0.8 * epoch / max(1, epochs - 1))
        for i in range(0, len(x), batch):
            own = order[i:i + batch]
            loss, g = gradient(m, x[own].T, y[own].T)
            total += loss * len(own)
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 5.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                m[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        losses.append(total / max(1, len(x)))
    return losses


def decode(m: Model, x: np.ndarray) -> np.ndarray:
    """The best tag sequence (Viterbi) of each window; ids and tags are (N, T)."""
    e, _ = emissions(m, x.T)
    t_max, batch, k = e.shape
    best, back = m["s"] + e[0], np.empty((t_max, batch, k), np.int8)
    for t in range(1, t_max):
        score = best[:, :, None] + m["A"]
        back[t] = score.argmax(1)
        best = score.max(1) + e[t]
    tags = np.empty((t_max, batch), np.int8)
    tags[-1] = best.argmax(1)
    for t in range(t_max - 1, 0, -1):
        tags[t - 1] = back[t, np.arange(batch), tags[t]]
    return tags.T
