"""A gated recurrent layer in numpy, with its gradients, and the Adam update."""

from __future__ import annotations

import numpy as np

FLOAT = np.float32


def uniform(rng: np.random.Generator, *shape: int, scale: float | None = None) -> np.ndarray:
    scale = 1 / np.sqrt(shape[0]) if scale is None else scale
    return rng.uniform(-scale, scale, shape).astype(FLOAT)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def step(x: np.ndarray, h: np.ndarray, recurrent: np.ndarray):
    """One time step. ``x``: (batch, 3 * hidden), the input's share of update
    gate, reset gate and candidate. Returns the new state and what the
    gradient needs."""
    n = h.shape[1]
    hh = h @ recurrent
    gates = sigmoid(x[:, : 2 * n] + hh[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    c = np.tanh(x[:, 2 * n :] + r * hh[:, 2 * n :])
    return c + z * (h - c), (z, r, c, hh[:, 2 * n :], h)


def forward(x: np.ndarray, mask: np.ndarray, h: np.ndarray, recurrent: np.ndarray):
    """``x``: (time, batch, 3 * hidden); where ``mask`` (time, batch) is 0 the
    state stays as it is. Returns the states and what the gradient needs."""
    states, kept = np.empty((*x.shape[:2], h.shape[1]), FLOAT), []
    for t in range(len(x)):
        new, parts = step(x[t], h, recurrent)
        h = np.where(mask[t][:, None], new, h)
        states[t] = h
        kept.append(parts)
    return states, kept


def backward(d_states: np.ndarray, mask: np.ndarray, kept: list, recurrent: np.ndarray):
    """Back-propagation through time: gradients of ``x`` and ``recurrent``."""
    time, batch, n = d_states.shape
    d_x, d_recurrent, d_h = np.zeros((time, batch, 3 * n), FLOAT), np.zeros_like(recurrent), np.zeros((batch, n), FLOAT)
    for t in range(time - 1, -1, -1):
        z, r, c, hc, h = kept[t]
        total = d_h + d_states[t]
        own = np.where(mask[t][:, None], total, 0)
        d_c = own * (1 - z) * (1 - c * c)
        d_x[t, :, :n] = own * (h - c) * z * (1 - z)
        d_x[t, :, n : 2 * n] = d_c * hc * r * (1 - r)
        d_x[t, :, 2 * n :] = d_c
        d_hh = d_x[t].copy()
        d_hh[:, 2 * n :] *= r
        d_recurrent += h.T @ d_hh
        d_h = np.where(mask[t][:, None], own * z, total) + d_hh @ recurrent.T
    return d_x, d_recurrent


class Adam:
    """Adam with gradients clipped to a norm of ``clip``."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, clip: float = 1.0):
        self.params, self.rate, self.clip, self.t = params, rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.work = {k: (np.empty_like(v), np.empty_like(v)) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray], rate: float | None = None) -> None:
        self.t += 1
        norm = np.sqrt(sum(float(np.multiply(g, g, out=self.work[k][0]).sum()) for k, g in grads.items()))
        scale = min(1.0, self.clip / (norm + 1e-12))
        rate = (self.rate if rate is None else rate) * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():  # in place: new arrays of this size cost more than the arithmetic
            (one, two), m, v = self.work[k], self.m[k], self.v[k]
            np.multiply(g, FLOAT(scale), out=one)
            np.subtract(one, m, out=two)
            two *= FLOAT(0.1)
            m += two
            one *= one
            one -= v
            one *= FLOAT(0.001)
            v += one
            np.sqrt(v, out=one)
            one += FLOAT(1e-8)
            np.multiply(m, FLOAT(rate), out=two)
            two /= one
            self.params[k] -= two
