"""Character-level bidirectional LSTM with a CRF on top, in numpy.

Small on purpose: it is trained on the driver from a bounded set of labelled windows and
then runs inside tasks.  Shapes are time first: ``(T, B, ..)``.
"""

from __future__ import annotations

import numpy as np

#: character classes: ASCII as it is, other letters, everything else; 0 is padding
CLASSES = 131
EMBED, HIDDEN = 12, 24


def encode(text: str) -> np.ndarray:
    """Class of every character."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.where(code < 128, code + 1, 130).astype(np.int16)
    for i in np.flatnonzero(code >= 128):
        if text[i].isalpha():
            out[i] = 129
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def new_model(tags: int, seed: int = 10) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    near = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    m = {"embed": near(CLASSES, EMBED) * np.float32(np.sqrt(CLASSES) * 0.5), "out": near(2 * HIDDEN, tags),
         "out_b": np.zeros(tags, np.float32), "move": np.zeros((tags, tags), np.float32),
         "first": np.zeros(tags, np.float32)}
    for d in "fb":
        m[f"x{d}"], m[f"h{d}"] = near(EMBED, 4 * HIDDEN), near(HIDDEN, 4 * HIDDEN)
        m[f"c{d}"] = np.zeros(4 * HIDDEN, np.float32)
        m[f"c{d}"][HIDDEN:2 * HIDDEN] = 1.0  # forget gates start open
    return m


def _lstm(m: dict, d: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, batch, _ = x.shape
    pre = x @ m[f"x{d}"] + m[f"c{d}"]
    h = np.zeros((batch, HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    cache = []
    for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
        gate = pre[t] + h @ m[f"h{d}"]
        ifo = _sigmoid(gate[:, :3 * HIDDEN])
        g = np.tanh(gate[:, 3 * HIDDEN:])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN:2 * HIDDEN], ifo[:, 2 * HIDDEN:]
        was_h, was_c = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            cache.append((t, i, f, o, g, tc, was_h, was_c))
    return out, cache


def emissions(m: dict, x: np.ndarray) -> np.ndarray:
    """Tag scores of class arrays ``x`` (B, T): (B, T, tags)."""
    e = m["embed"][x.T]
    h = np.concatenate([_lstm(m, d, e, False)[0] for d in "fb"], axis=2)
    return (h @ m["out"] + m["out_b"]).transpose(1, 0, 2)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _crf(m: dict, score: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Loss and gradients (emissions, moves, first) of a batch, time first."""
    steps, batch, tags = score.shape
    alpha = np.empty_like(score)
    beta = np.zeros_like(score)
    alpha[0] = score[0] + m["first"]
    for t in range(1, steps):
        alpha[t] = score[t] + _logsum(alpha[t - 1][:, :, None] + m["move"], 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsum(m["move"] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _logsum(alpha[-1], 1)
    mark = np.exp(alpha + beta - total[None, :, None])
    rows = np.arange(batch)
    path = m["first"][gold[0]] + score[0, rows, gold[0]]
    move = np.zeros_like(m["move"])
    for t in range(1, steps):
        path = path + score[t, rows, gold[t]] + m["move"][gold[t - 1], gold[t]]
        pair = np.exp(alpha[t - 1][:, :, None] + m["move"] + (score[t] + beta[t])[:, None, :] - total[:, None, None])
        move += pair.sum(axis=0)
        np.add.at(move, (gold[t - 1], gold[t]), -1.0)
    grad = mark.copy()
    for t in range(steps):
        grad[t, rows, gold[t]] -= 1.0
    return float((total - path).mean()), grad / batch, move / batch, grad[0].sum(axis=0) / batch


def _lstm_back(m: dict, d: str, x: np.ndarray, cache: list, grad: np.ndarray, g: dict) -> np.ndarray:
    dx = np.zeros_like(x)
    dh_next = np.zeros((x.shape[1], HIDDEN), np.float32)
    dc_next = np.zeros_like(dh_next)
    for t, i, f, o, c_in, tc, was_h, was_c in reversed(cache):
        dh = grad[t] + dh_next
        dc = dc_next + dh * o * (1 - tc * tc)
        gate = np.concatenate([dc * c_in * i * (1 - i), dc * was_c * f * (1 - f), dh * tc * o * (1 - o),
                               dc * i * (1 - c_in * c_in)], axis=1)
        g[f"x{d}"] += x[t].T @ gate
        g[f"h{d}"] += was_h.T @ gate
        g[f"c{d}"] += gate.sum(axis=0)
        dx[t] = gate @ m[f"x{d}"].T
        dh_next = gate @ m[f"h{d}"].T
        dc_next = dc * f
    return dx


def train(windows: np.ndarray, gold: np.ndarray, tags: int, epochs: int = 6, batch: int = 32,
          rate: float = 0.01, seed: int = 10) -> dict[str, np.ndarray]:
    """Adam on the CRF likelihood of ``windows`` (N, T) with tag paths ``gold`` (N, T)."""
    m = new_model(tags, seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in m.items()}
    square = {k: np.zeros_like(v) for k, v in m.items()}
    step, rounds = 0, epochs * max(1, -(-len(windows) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            x, y = windows[pick].T, gold[pick].T
            e = m["embed"][x]
            (hf, cf), (hb, cb) = _lstm(m, "f", e, True), _lstm(m, "b", e, True)
            h = np.concatenate([hf, hb], axis=2)
            _, de, move, first = _crf(m, h @ m["out"] + m["out_b"], y)
            g = {k: np.zeros_like(v) for k, v in m.items()}
            flat_h, flat_e = h.reshape(-1, 2 * HIDDEN), de.reshape(-1, tags)
            g["out"], g["out_b"], g["move"], g["first"] = flat_h.T @ flat_e, flat_e.sum(axis=0), move, first
            dh = de @ m["out"].T
            dx = _lstm_back(m, "f", e, cf, dh[:, :, :HIDDEN], g) + _lstm_back(m, "b", e, cb, dh[:, :, HIDDEN:], g)
            np.add.at(g["embed"], x, dx)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            lr = rate * (1 - 0.9 * step / rounds)
            for k in m:
                v = (g[k] * min(1.0, 5.0 / (norm + 1e-9))).astype(np.float32)
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.999 * square[k] + 0.001 * v * v
                m[k] = (m[k] - lr * (mean[k] / (1 - 0.9 ** step))
                        / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return m


def viterbi(m: dict, score: np.ndarray, lengths: np.ndarray, allowed: np.ndarray) -> list[np.ndarray]:
    """Best allowed path of every padded row of ``score`` (B, T, tags)."""
    batch, steps, tags = score.shape
    move = np.where(allowed, m["move"], -1e9)
    best = np.where(np.arange(tags) % 2 == 0, np.where(np.arange(tags) > 0, -1e9, 0.0), 0.0) + score[:, 0] + m["first"]
    back = np.zeros((steps, batch, tags), dtype=np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + move
        back[t] = through.argmax(axis=1)
        value = through.max(axis=1) + score[:, t]
        best = np.where((t < lengths)[:, None], value, best)
    last = best.argmax(axis=1)
    out = []
    for b in range(batch):
        path = np.empty(lengths[b], dtype=np.int8)
        tag = int(last[b])
        for t in range(int(lengths[b]) - 1, -1, -1):
            path[t] = tag
            if t:
                tag = int(back[t, b, tag])
        out.append(path)
    return out
