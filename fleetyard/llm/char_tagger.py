"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Training and decoding work on fixed windows of WINDOW code points. A text is
cut into tiles of TILE code points; the window of a tile has the tile in its
second third, so that neighbouring windows overlap by two thirds. A span
belongs to the tile it starts in, and only that tile's window reports it; what
is beyond the window's end is read from later windows.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TILE = 32
WINDOW = 3 * TILE
PAD, OTHER = 0, 97
N_CHARS = 98


def char_ids(points: np.ndarray) -> np.ndarray:
    """Code points to input symbols: all digits alike, ASCII, anything else, padding 0."""
    out = np.where(points < 128, points.astype(np.int64) - 31, OTHER)
    out[points < 32] = 1                       # control characters as space
    out[points == 127] = OTHER
    out[(points >= 48) & (points <= 57)] = 17   # "0"
    return out


def windows(points: np.ndarray, tiles: np.ndarray) -> np.ndarray:
    """Input symbols of the windows of some tiles of a text."""
    return windows_from(points, tiles * TILE - TILE)


def windows_from(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Input symbols of the windows that start at some places of a text, -WINDOW or later."""
    ids = np.zeros(len(points) + 2 * WINDOW, dtype=np.int64)
    ids[WINDOW:WINDOW + len(points)] = char_ids(points)
    return ids[(starts + WINDOW)[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Weights: emb, and for each direction Wx, Wh, b; Wo, bo; CRF trans, first."""

    w: dict[str, np.ndarray]
    n_tags: int

    @staticmethod
    def new(n_tags: int, emb: int = 12, hidden: int = 16, seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        w = {"emb": r.normal(0, 0.3, (N_CHARS, emb))}
        for d in "fb":
            w["Wx" + d] = r.normal(0, emb ** -0.5, (emb, 4 * hidden))
            w["Wh" + d] = r.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
            w["b" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        w["Wo"] = r.normal(0, (2 * hidden) ** -0.5, (2 * hidden, n_tags))
        w["bo"] = np.zeros(n_tags)
        w["trans"] = np.zeros((n_tags, n_tags))
        w["first"] = np.zeros(n_tags)
        return Tagger({k: v.astype(np.float32) for k, v in w.items()}, n_tags)

    # x: (T, B) symbols. All activations are (T, B, .).
    def _run(self, d: str, e: np.ndarray, keep: list | None = None) -> np.ndarray:
        w, hidden = self.w, self.w["Whf"].shape[0]
        steps, size = e.shape[0], e.shape[1]
        xs = e.reshape(-1, e.shape[2]) @ w["Wx" + d] + w["b" + d]
        xs = xs.reshape(steps, size, 4 * hidden)
        h = np.zeros((size, hidden), np.float32)
        c = np.zeros((size, hidden), np.float32)
        out = np.empty((steps, size, hidden), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = xs[t] + h @ w["Wh" + d]
            gates = _sigmoid(z[:, :3 * hidden])
            i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
            g = np.tanh(z[:, 3 * hidden:])
            before, h_before = c, h
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, th, h_before))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        e = self.w["emb"][x]
        h = np.concatenate([self._run("f", e), self._run("b", e)], axis=2)
        return h @ self.w["Wo"] + self.w["bo"]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Most likely tags (B, T) of windows (B, T), by Viterbi."""
        u = self.scores(np.ascontiguousarray(ids.T))
        trans = self.w["trans"]
        steps, size = u.shape[0], u.shape[1]
        back = np.empty((steps, size, self.n_tags), np.int8)
        a = u[0] + self.w["first"]
        for t in range(1, steps):
            s = a[:, :, None] + trans
            back[t] = s.argmax(axis=1)
            a = s.max(axis=1) + u[t]
        tags = np.empty((size, steps), np.int8)
        tags[:, -1] = a.argmax(axis=1)
        rows = np.arange(size)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][rows, tags[:, t]]
        return tags

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean CRF loss of a batch and its gradients; x, y (T, B)."""
        w, hidden = self.w, self.w["Whf"].shape[0]
        steps, size = x.shape
        e = w["emb"][x]
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._run(d, e, kept[d]) for d in "fb"], axis=2)
        u = h @ w["Wo"] + w["bo"]
        trans = w["trans"]

        def lse(v, axis):
            m = v.max(axis=axis, keepdims=True)
            return (m + np.log(np.exp(v - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        fwd, bwd = np.empty_like(u), np.zeros_like(u)
        fwd[0] = u[0] + w["first"]
        for t in range(1, steps):
            fwd[t] = lse(fwd[t - 1][:, :, None] + trans, 1) + u[t]
        for t in range(steps - 2, -1, -1):
            bwd[t] = lse(trans + (u[t + 1] + bwd[t + 1])[:, None, :], 2)
        z = lse(fwd[-1], 1)
        rows = np.arange(size)
        gold = w["first"][y[0]] + u[np.arange(steps)[:, None], rows, y].sum(0) + trans[y[:-1], y[1:]].sum(0)
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        du = np.exp(fwd + bwd - z[:, None])
        grad["first"] = du[0].sum(0)
        for t in range(1, steps):
            grad["trans"] += np.exp(fwd[t - 1][:, :, None] + trans + (u[t] + bwd[t])[:, None, :]
                                    - z[:, None, None]).sum(0)
        np.subtract.at(grad["trans"], (y[:-1].ravel(), y[1:].ravel()), 1)
        np.subtract.at(grad["first"], y[0], 1)
        du[np.arange(steps)[:, None], rows, y] -= 1
        flat = du.reshape(-1, self.n_tags)
        grad["Wo"] = h.reshape(-1, 2 * hidden).T @ flat
        grad["bo"] = flat.sum(0)
        dh_all = du @ w["Wo"].T
        de = np.zeros_like(e)
        for n, d in enumerate("fb"):
            part = dh_all[:, :, n * hidden:(n + 1) * hidden]
            dz_all = np.empty((steps, size, 4 * hidden), np.float32)
            dh = np.zeros((size, hidden), np.float32)
            dc = np.zeros((size, hidden), np.float32)
            for t, i, f, o, g, before, th, h_before in reversed(kept[d]):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - th * th)
                dz = dz_all[t]
                dz[:, :hidden] = dc * g * i * (1 - i)
                dz[:, hidden:2 * hidden] = dc * before * f * (1 - f)
                dz[:, 2 * hidden:3 * hidden] = dh * th * o * (1 - o)
                dz[:, 3 * hidden:] = dc * i * (1 - g * g)
                grad["Wh" + d] += h_before.T @ dz
                dh = dz @ w["Wh" + d].T
                dc = dc * f
            flat = dz_all.reshape(-1, 4 * hidden)
            grad["Wx" + d] = e.reshape(-1, e.shape[2]).T @ flat
            grad["b" + d] = flat.sum(0)
            de += (flat @ w["Wx" + d].T).reshape(e.shape)
        np.add.at(grad["emb"], x.ravel(), de.reshape(-1, e.shape[2]))
        return float((z - gold).mean()), {k: v / size for k, v in grad.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 16,
            rate: float = 0.03, seed: int = 11) -> list[float]:
        """Adam over the windows (N, T); the mean loss of each epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        n, losses = 0, []
        total = epochs * -(-len(ids) // batch)
        for _ in range(epochs):
            order, loss = r.permutation(len(ids)), []
            for at in range(0, len(ids), batch):
                pick = order[at:at + batch]
                value, grad = self._loss(np.ascontiguousarray(ids[pick].T), np.ascontiguousarray(tags[pick].T))
                loss.append(value)
                n += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                step = rate * (1 - 0.9 * n / total) * min(1.0, 5.0 / max(norm, 1e-9))
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - step * (m[k] / (1 - 0.9 ** n))
                                 / (np.sqrt(v2[k] / (1 - 0.99 ** n)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(loss)))
        return losses
