"""A byte-level convolutional classifier in numpy (Kim 2014): embedding, filters of several widths, maximum over
positions, softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBED = 8
WINDOW = 128
REACH = max(WIDTHS)
STRIDE = WINDOW - REACH + 1
STEPS = 500
BATCH = 192
RATE = 0.01
SEED = 11
#: Windows put through the filters at once.
CHUNK = 256
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


@dataclass
class ByteConv:
    """``filters`` has a row for each (offset, embedding) and a column for each filter; narrower
    filters have zeros at the offsets they do not reach."""

    labels: list[str]
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """(windows * positions, REACH * EMBED): the embedded bytes each filter position sees."""
        seen = np.ascontiguousarray(self.embed[FOLD[windows]])
        n, length, width = seen.shape
        step = seen.strides
        view = np.lib.stride_tricks.as_strided(
            seen, (n, length - REACH + 1, REACH * width), (step[0], step[1], step[2]), writeable=False)
        return view.reshape(-1, REACH * width)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self.patches(windows)
        z = (cols @ self.filters).reshape(len(windows), -1, self.filters.shape[1])
        return cols, z, z.max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.labels)), dtype=np.float32)
        for at in range(0, len(windows), CHUNK):
            hidden = np.maximum(self.pooled(windows[at:at + CHUNK])[2] + self.shift, 0)
            out[at:at + CHUNK] = softmax(hidden @ self.weight + self.bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, owner): fixed-length windows over every text, the last filled up with zeros.

    Neighbours share as many bytes as the widest filter needs, so no filter position is lost.
    """
    lengths = np.diff(bounds)
    count = np.maximum(1, -(-(lengths - (REACH - 1)) // STRIDE))
    owner = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[:-1][owner] + place * STRIDE
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    left = bounds[1:][owner] - start
    short = np.flatnonzero(left < WINDOW)
    windows[short] *= (np.arange(WINDOW) < left[short, None]).astype(np.uint8)
    return windows, owner


class Adam:
    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, grads: list[np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        rate = scale * self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for a, g, m, v in zip(self.arrays, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= (rate * m / (np.sqrt(v) + 1e-8)).astype(a.dtype)


def train(windows: np.ndarray, y: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = SEED) -> ByteConv:
    """Fit on labelled windows, labels drawn equally often; a fixed number of steps."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    reach = np.repeat(WIDTHS, FILTERS)
    mask = (np.arange(REACH)[:, None, None] < reach).repeat(EMBED, axis=1).reshape(REACH * EMBED, n_filters).astype(np.float32)
    net = ByteConv(
        labels, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.3, (REACH * EMBED, n_filters)) * mask).astype(np.float32), np.zeros(n_filters, np.float32),
        rng.normal(0, 0.3, (n_filters, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))
    if len(labels) < 2:
        return net
    members = [np.flatnonzero(y == k) for k in range(len(labels))]
    adam = Adam([net.embed, net.filters, net.shift, net.weight, net.bias], RATE)
    for step in range(steps):
        wanted = rng.integers(len(labels), size=BATCH)
        chosen = np.array([members[k][rng.integers(len(members[k]))] for k in wanted])
        x = windows[chosen]
        cols, z, top = net.pooled(x)
        best = z.argmax(axis=1)
        hidden = np.maximum(top + net.shift, 0)
        p = softmax(hidden @ net.weight + net.bias)
        p[np.arange(BATCH), wanted] -= 1
        p /= BATCH
        dh = (p @ net.weight.T) * (hidden > 0)
        rows = np.arange(BATCH)[:, None] * z.shape[1] + best
        seen = cols[rows]
        dk = np.einsum("bfc,bf->cf", seen, dh) * mask
        dcols = dh[:, :, None] * net.filters.T[None]
        de = np.zeros_like(net.embed)
        at = best[:, :, None] + np.arange(REACH)
        np.add.at(de, FOLD[np.take_along_axis(x[:, None, :], at.reshape(BATCH, 1, -1), axis=2)].reshape(-1),
                  dcols.reshape(-1, EMBED))
        adam.step([de, dk, dh.sum(axis=0), hidden.T @ p, p.sum(axis=0)], 1 - step / steps)
    return net
