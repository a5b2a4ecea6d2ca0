"""A small convolutional text classifier in numpy: embedding, filters of several widths, max pooling.

Inputs are rows of symbol ids, one or more ids per position (their embeddings add up). Id 0 pads and
its embedding stays zero. Training is mini-batch Adam over rows in memory; scoring needs the parameters
only, which are of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


PIECE = 400_000


@dataclass
class ConvNet:
    embedding: np.ndarray  # (symbols, dim)
    filters: list[np.ndarray]  # per width: (width, dim, filters)
    filter_bias: list[np.ndarray]
    dense: np.ndarray  # (all filters, classes)
    dense_bias: np.ndarray

    @property
    def widths(self) -> list[int]:
        return [len(f) for f in self.filters]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.filter_bias, self.dense, self.dense_bias]


def new_net(symbols: int, dim: int, widths: tuple, filters: int, classes: int, seed: int) -> ConvNet:
    draw = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    net = ConvNet(
        normal(symbols, dim, scale=0.5),
        [normal(w, dim, filters, scale=(w * dim) ** -0.5) for w in widths],
        [np.zeros(filters, np.float32) for _ in widths],
        normal(filters * len(widths), classes, scale=0.1),
        np.zeros(classes, np.float32),
    )
    net.embedding[0] = 0
    return net


def embed(net: ConvNet, ids: np.ndarray) -> np.ndarray:
    """(positions, ids per position) to (positions, dim)."""
    out = net.embedding[ids[:, 0]]
    for k in range(1, ids.shape[1]):
        out = out + net.embedding[ids[:, k]]
    return out


def responses(net: ConvNet, k: int, vectors: np.ndarray) -> np.ndarray:
    """Filter responses at every position of one flat run; windows may look past the run's end."""
    filters = net.filters[k]
    width = len(filters)
    n = len(vectors)
    out = vectors @ filters[0]
    for j in range(1, width):
        out[: n - j] += (vectors @ filters[j])[j:]
    return out


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def pooled(net: ConvNet, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Max-pooled features of the runs that begin at `starts` in the flat positions.

    Every run must end in at least (largest width - 1) padding positions.
    """
    vectors = embed(net, ids)
    parts = [
        np.maximum.reduceat(responses(net, k, vectors), starts, axis=0) + net.filter_bias[k]
        for k in range(len(net.filters))
    ]
    return np.maximum(np.concatenate(parts, axis=1), 0)


def probabilities(net: ConvNet, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return softmax(pooled(net, ids, starts) @ net.dense + net.dense_bias)


def flat(rows: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (positions, ids) as one flat array, each followed by `pad` padding positions."""
    lengths = np.array([len(r) + pad for r in rows])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    ids = np.zeros((int(lengths.sum()), rows[0].shape[1]), np.int64)
    for start, row in zip(starts, rows, strict=True):
        ids[start : start + len(row)] = row
    return ids, starts


def _gradients(net: ConvNet, ids: np.ndarray, starts: np.ndarray, target: np.ndarray, weight, total):
    """Gradients of the cross entropy, weighted by weight / total; maxima pass theirs to one position."""
    vectors = embed(net, ids)
    ends = np.concatenate([starts[1:], [len(ids)]])
    tops, values = [], []
    for k in range(len(net.filters)):
        r = responses(net, k, vectors)
        top = np.stack([s + r[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
        tops.append(top)
        values.append(np.take_along_axis(r, top, axis=0) + net.filter_bias[k])
    features = np.concatenate(values, axis=1)
    active = features > 0
    features = features * active
    p = softmax(features @ net.dense + net.dense_bias)
    p[np.arange(len(target)), target] -= 1
    delta = (p * (weight / total)[:, None]).astype(np.float32)
    back = (delta @ net.dense.T) * active
    g_embedding = np.zeros_like(net.embedding)
    g_filters, g_bias = [], []
    done = 0
    for k, filters in enumerate(net.filters):
        width, dim, count = filters.shape
        g = back[:, done : done + count]
        done += count
        g_f = np.zeros_like(filters)
        for j in range(width):
            at = np.minimum(tops[k] + j, len(ids) - 1)
            g_f[j] = np.einsum("nfd,nf->df", vectors[at], g)
            into = (g[:, :, None] * filters[j].T[None]).reshape(-1, dim)
            for c in range(ids.shape[1]):
                np.add.at(g_embedding, ids[at, c].ravel(), into)
        g_filters.append(g_f)
        g_bias.append(g.sum(axis=0))
    g_embedding[0] = 0
    return [g_embedding, *g_filters, *g_bias, features.T @ delta, delta.sum(axis=0)]


def _pieces(pick: np.ndarray, rows: list[np.ndarray]) -> list[np.ndarray]:
    """A batch in runs of at most about `PIECE` positions, so that long rows don't fill the memory."""
    size = np.cumsum([len(rows[i]) for i in pick]) // PIECE
    return [pick[size == n] for n in np.unique(size)]


def train(
    net: ConvNet,
    rows: list[np.ndarray],
    target: np.ndarray,
    steps: int,
    batch: int,
    rate: float,
    seed: int,
    l2: float = 1e-4,
    after: int = 0,
    end: int | None = None,
) -> ConvNet:
    """Adam with classes weighted alike; batches are drawn with a fixed seed.

    `after` and `end`: the part of the steps to do here, all by default; the moments start anew.
    """
    draw = np.random.default_rng(seed)
    pad = max(net.widths) - 1
    share = np.bincount(target, minlength=net.dense.shape[1]).astype(np.float64)
    by_class = np.where(share > 0, share.sum() / np.maximum(share, 1), 0)
    params = net.parameters()
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for at in range(after + 1, (end or steps) + 1):
        pick = draw.integers(0, len(rows), batch)
        total = by_class[target[pick]].sum()
        grads = None
        for piece in _pieces(pick, rows):
            ids, starts = flat([rows[i] for i in piece], pad)
            part = _gradients(net, ids, starts, target[piece], by_class[target[piece]], total)
            grads = part if grads is None else [a + b for a, b in zip(grads, part, strict=True)]
        step = at - after
        now = rate * min(1.0, 3 * (1 - at / (steps + 1)))
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            g = g + l2 * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        net.embedding[0] = 0
    return net
