"""A bidirectional LSTM with a logistic output per step, in numpy: training with Adam on padded batches
(step first), and inference."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    def __init__(self, inputs: int, hidden: int = 24, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, (1 / inputs) ** 0.5, (inputs, 4 * hidden)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, (1 / hidden) ** 0.5, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p["b" + d] = bias
        self.p["V"] = rng.normal(0, 0.2, (2 * hidden, 1)).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _run(self, x, mask, d):
        """x (steps, pages, inputs), mask (steps, pages, 1); gates are input, forget, output, candidate."""
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, self.h), np.float32)
        out, kept = np.zeros((steps, pages, self.h), np.float32), []
        mixed = x @ self.p["W" + d] + self.p["b" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = mixed[t] + h @ self.p["U" + d]
            gates, g = _sigmoid(z[:, :3 * self.h]), np.tanh(z[:, 3 * self.h:])
            i, f, o = gates[:, :self.h], gates[:, self.h:2 * self.h], gates[:, 2 * self.h:]
            new = f * c + i * g
            squashed = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, squashed))
            h = mask[t] * (o * squashed) + (1 - mask[t]) * h
            c = mask[t] * new + (1 - mask[t]) * c
            out[t] = h
        return out, kept

    def forward(self, x, mask):
        self.kept = {}
        parts = []
        for d in "fb":
            out, self.kept[d] = self._run(x, mask, d)
            parts.append(out)
        self.joined = np.concatenate(parts, 2)
        return _sigmoid((self.joined @ self.p["V"] + self.p["c"])[:, :, 0])

    def gradients(self, x, mask, target):
        p = self.forward(x, mask)
        delta = ((p - target) * mask[:, :, 0] / max(mask.sum(), 1))[:, :, None].astype(np.float32)
        grads = {"V": np.einsum("tbh,tbo->ho", self.joined, delta), "c": delta.sum((0, 1))}
        back = delta @ self.p["V"].T
        for n, d in enumerate("fb"):
            into = back[:, :, n * self.h:(n + 1) * self.h]
            dz = np.zeros((*x.shape[:2], 4 * self.h), np.float32)
            before = np.zeros((*x.shape[:2], self.h), np.float32)
            dh = dc = np.zeros((x.shape[1], self.h), np.float32)
            for t, h, c, i, f, o, g, squashed in reversed(self.kept[d]):
                m = mask[t]
                total = into[t] + dh
                live, live_c = total * m, dc * m
                do = live * squashed
                dnew = live * o * (1 - squashed**2) + live_c
                z = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), do * o * (1 - o), dnew * i * (1 - g**2)], 1)
                dz[t], before[t] = z, h
                dh = z @ self.p["U" + d].T + total * (1 - m)
                dc = dnew * f + dc * (1 - m)
            grads["W" + d] = np.einsum("tbi,tbz->iz", x, dz, optimize=True)
            grads["U" + d] = np.einsum("tbh,tbz->hz", before, dz, optimize=True)
            grads["b" + d] = dz.sum((0, 1))
        return grads

    def fit(self, sequences, targets, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 1):
        """sequences: arrays (steps, inputs); targets: arrays (steps,) of 0 and 1."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        n = 0
        size = np.array([len(s) for s in sequences])
        for epoch in range(epochs):
            order = np.argsort(size + rng.random(len(size)) * 4, kind="stable")  # like lengths together
            starts = np.arange(0, len(order), batch)
            for s in rng.permutation(starts):
                pick = order[s:s + batch]
                x, mask = pad([sequences[k] for k in pick])
                y = pad([targets[k][:, None] for k in pick])[0][:, :, 0]
                n += 1
                for k, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    step = rate * (1 - epoch / epochs) * first[k] / (1 - 0.9**n) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)
                    self.p[k] = (self.p[k] - step).astype(np.float32)
        self.kept, self.joined = {}, None
        return self

    def predict(self, sequences, cells: int = 20_000):
        """Probabilities per step; pages of like length share a padded batch of at most ``cells`` steps."""
        out = [np.zeros(0, np.float32)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        while order:
            pick = [order.pop()]
            longest = len(sequences[pick[0]])
            while order and (len(pick) + 1) * longest <= cells and len(sequences[order[-1]]) * 2 >= longest:
                pick.append(order.pop())
            p = self.forward(*pad([sequences[k] for k in pick]))
            for n, k in enumerate(pick):
                out[k] = p[:len(sequences[k]), n]
        self.kept, self.joined = {}, None
        return out


def pad(sequences):
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences), 1), np.float32)
    for n, s in enumerate(sequences):
        x[:len(s), n], mask[:len(s), n] = s, 1
    return x, mask
