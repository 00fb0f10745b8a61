"""A small bidirectional LSTM in NumPy that labels every step of a sequence."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Weights w[i] of each direction: inputs and state to the four gates; then one output."""

    def __init__(self, inputs: int, hidden: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.inputs, self.hidden = inputs, hidden
        shape = lambda n, m: (rng.standard_normal((n, m)) / np.sqrt(n)).astype(np.float32)
        self.params: list[np.ndarray] = []
        for _ in range(2):
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.params += [shape(inputs, 4 * hidden), shape(hidden, 4 * hidden), bias]
        self.params += [shape(2 * hidden, 1), np.zeros(1, dtype=np.float32)]

    def _run(self, x: np.ndarray, mask: np.ndarray, side: int):
        """States of one direction over x (steps, sequences, inputs), and what the way back needs."""
        w, u, b = self.params[3 * side : 3 * side + 3]
        steps, n, _ = x.shape
        d = self.hidden
        h = c = np.zeros((n, d), dtype=np.float32)
        drive = x @ w + b
        states, kept = np.zeros((steps, n, d), dtype=np.float32), [None] * steps
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            gates = drive[t] + h @ u
            i, f, o = (_sigmoid(gates[:, k * d : (k + 1) * d]) for k in range(3))
            g = np.tanh(gates[:, 3 * d :])
            m = mask[t][:, None]
            new = f * c + i * g
            kept[t] = (i, f, o, g, c, h, np.tanh(new))
            c = m * new + (1 - m) * c
            h = m * (o * kept[t][6]) + (1 - m) * h
            states[t] = h
        return states, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, 0)[0], self._run(x, mask, 1)[0]], axis=2)
        return _sigmoid(both @ self.params[6] + self.params[7])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy of the labels and its gradient by each of params."""
        runs = [self._run(x, mask, side) for side in range(2)]
        both = np.concatenate([r[0] for r in runs], axis=2)
        p = _sigmoid(both @ self.params[6] + self.params[7])[:, :, 0]
        total = max(mask.sum(), 1)
        loss = -float((mask * np.log(np.where(labels > 0, p, 1 - p) + 1e-7)).sum() / total)
        error = ((p - labels) * mask / total)[:, :, None].astype(np.float32)
        out = [None] * 6 + [np.einsum("tnd,tno->do", both, error), error.sum(axis=(0, 1))]
        back = error @ self.params[6].T
        d, (steps, n, _) = self.hidden, x.shape
        for side, (_, kept) in enumerate(runs):
            u = self.params[3 * side + 1]
            dgates = np.zeros((steps, n, 4 * d), dtype=np.float32)
            du = np.zeros_like(u)
            dh = dc = np.zeros((n, d), dtype=np.float32)
            for t in range(steps - 1, -1, -1) if side == 0 else range(steps):
                i, f, o, g, c, h, squashed = kept[t]
                m = mask[t][:, None]
                dh = dh + back[t][:, side * d : (side + 1) * d]
                dnew = m * (dc + dh * o * (1 - squashed**2))
                dgates[t] = np.concatenate(
                    [dnew * g * i * (1 - i), dnew * c * f * (1 - f), m * dh * squashed * o * (1 - o), dnew * i * (1 - g**2)],
                    axis=1,
                )
                du += h.T @ dgates[t]
                dh = (1 - m) * dh + dgates[t] @ u.T
                dc = (1 - m) * dc + dnew * f
            flat = dgates.reshape(-1, 4 * d)
            out[3 * side : 3 * side + 3] = [x.reshape(-1, self.inputs).T @ flat, du, flat.sum(axis=0)]
        return loss, out

    def fit(self, batches: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int, rate: float = 0.01) -> float:
        """Adam over the batches, so many rounds; the loss of the last one."""
        first = [np.zeros_like(p) for p in self.params]
        second = [np.zeros_like(p) for p in self.params]
        step, loss = 0, 0.0
        for _ in range(rounds):
            losses = []
            for batch in batches:
                step += 1
                loss, grads = self.gradients(*batch)
                losses.append(loss)
                norm = float(np.sqrt(sum((g**2).sum() for g in grads)))
                for p, g, m, v in zip(self.params, grads, first, second, strict=True):
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            loss = float(np.mean(losses)) if losses else 0.0
        return loss
