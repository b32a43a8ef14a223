"""Declarative network description and its arithmetic on one batch of arrays.

Tasks call ``forward`` and ``backward`` on the batches Spark hands them; everything that crosses rows
or partitions is in ``dense``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np

EPS = 1e-3  # batch normalisation
MOMENTUM = 0.99
CLIP = 1e-7
LOSSES = ("mse", "mae", "bce", "focal", "sparse_ce")


@dataclass(frozen=True)
class Layer:
    """``kind``: dense, embed, concat, norm or drop. ``inputs``: names of inputs or earlier layers."""

    name: str
    kind: str
    inputs: tuple[str, ...]
    units: int = 0
    activation: str = "linear"
    vocab: int = 0
    rate: float = 0.0


@dataclass(frozen=True)
class Head:
    """``layer`` is trained against column ``label`` with ``loss``; head losses are summed."""

    layer: str
    label: str
    loss: str


@dataclass(frozen=True)
class DenseSpec:
    """``inputs`` maps a feature column to its width; 0 means an integer id."""

    inputs: dict[str, int]
    layers: tuple[Layer, ...]
    heads: tuple[Head, ...]

    def widths(self) -> dict[str, int]:
        width = dict(self.inputs)
        for y in self.layers:
            given = sum(width[i] for i in y.inputs)
            width[y.name] = y.units if y.kind in ("dense", "embed") else given
        return width

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> DenseSpec:
        raw = json.loads(text)
        layers = tuple(Layer(**{**y, "inputs": tuple(y["inputs"])}) for y in raw["layers"])
        return DenseSpec(raw["inputs"], layers, tuple(Head(**h) for h in raw["heads"]))


def dense_chain(source: str, units: list[int], names: list[str], activation: str = "relu") -> list[Layer]:
    out = []
    for n, u in zip(names, units):
        out.append(Layer(n, "dense", (source,), u, activation))
        source = n
    return out


def regressor_spec(column: str, width: int, label: str, hidden: list[int], loss: str = "mse") -> DenseSpec:
    chain = dense_chain(column, hidden, [f"dense_{i + 1}" for i in range(len(hidden))])
    out = Layer("output", "dense", (chain[-1].name if chain else column,), 1, "linear")
    return DenseSpec({column: width}, (*chain, out), (Head("output", label, loss),))


def classifier_spec(column: str, width: int, label: str, hidden: list[int], loss: str = "bce") -> DenseSpec:
    spec = regressor_spec(column, width, label, hidden, loss)
    out = spec.layers[-1]
    return DenseSpec(spec.inputs, (*spec.layers[:-1], Layer(out.name, "dense", out.inputs, 1, "sigmoid")), spec.heads)


def multitask_spec(width: int, target: int, classes: int = 2, vocab: tuple[int, int] = (300, 250), embed: int = 32,
                   encoder: tuple[int, ...] = (512, 256, 128), top: tuple[int, ...] = (128, 64, 32),
                   ids: tuple[str, str] = ("input_1", "input_2"), vector: str = "input_3",
                   labels: tuple[str, str] = ("decoder_4", "output")) -> DenseSpec:
    """Two embedded ids and a vector: one head rebuilds a vector, the other classifies.
    Fixed values: layer names, widths, vocabularies, column names."""
    layers: list[Layer] = []
    for i, c in enumerate(ids, 1):
        layers.append(Layer(f"embed_{i}", "embed", (c,), embed, vocab=vocab[i - 1]))
        layers += dense_chain(f"embed_{i}", [8, 16], [f"s{i}_dense_1", f"s{i}_dense_2"])
    layers += dense_chain(vector, list(encoder), [f"encoder_{i + 1}" for i in range(len(encoder))])
    code = f"encoder_{len(encoder)}"
    back = [*reversed(encoder), target]
    layers += dense_chain(code, back, [f"decoder_{i + 1}" for i in range(len(back))])
    layers.append(Layer("concatenate", "concat", ("s1_dense_2", "s2_dense_2", code)))
    layers += dense_chain("concatenate", list(top), [f"dense_3_{i + 1}" for i in range(len(top))])
    layers.append(Layer("norm", "norm", (f"dense_3_{len(top)}",)))
    layers.append(Layer("drop", "drop", ("norm",), rate=0.2))
    layers.append(Layer("output", "dense", ("drop",), classes, "softmax"))
    return DenseSpec({ids[0]: 0, ids[1]: 0, vector: width}, tuple(layers),
                     (Head(f"decoder_{len(back)}", labels[0], "mse"), Head("output", labels[1], "sparse_ce")))


def initial(spec: DenseSpec, seed: int = 0) -> dict[str, np.ndarray]:
    """Glorot-uniform weights, zero biases, small uniform embeddings; keys are ``layer/part``."""
    rng, width, p = np.random.default_rng(seed), spec.widths(), {}
    for y in spec.layers:
        fan = sum(width[i] for i in y.inputs)
        if y.kind == "dense":
            limit = (6.0 / (fan + y.units)) ** 0.5
            p[f"{y.name}/weight"] = rng.uniform(-limit, limit, (fan, y.units))
            p[f"{y.name}/bias"] = np.zeros(y.units)
        elif y.kind == "embed":
            p[f"{y.name}/table"] = rng.uniform(-0.05, 0.05, (y.vocab, y.units))
        elif y.kind == "norm":
            for part, value in (("gamma", 1.0), ("beta", 0.0), ("mean", 0.0), ("variance", 1.0)):
                p[f"{y.name}/{part}"] = np.full(fan, value)
    return p


def trainable(name: str) -> bool:
    return not name.endswith(("/mean", "/variance"))


def squared_spread(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parameters with every running variance replaced by variance + mean^2, which averages over tasks; ``spread`` undoes it.
    So the merged variance holds the spread between the tasks' means, as one task over all rows would see it."""
    return {n: a + p[n[:-8] + "mean"] ** 2 if n.endswith("/variance") else a for n, a in p.items()}


def spread(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {n: a - p[n[:-8] + "mean"] ** 2 if n.endswith("/variance") else a for n, a in p.items()}


def _activate(z: np.ndarray, kind: str) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0.0)
    if kind == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if kind == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return z


def _through(d: np.ndarray, a: np.ndarray, kind: str) -> np.ndarray:
    """Gradient before the activation, from the gradient after it."""
    if kind == "relu":
        return d * (a > 0)
    if kind == "sigmoid":
        return d * a * (1.0 - a)
    if kind == "softmax":
        return a * (d - (d * a).sum(axis=1, keepdims=True))
    return d


def forward(spec: DenseSpec, p: dict, x: dict, rng=None, until: str | None = None, across=None) -> tuple[dict, dict]:
    """Values of every layer, and what ``backward`` needs. Training mode if ``rng`` is given. With ``across`` the rows are one
    task's part of a batch: ``across.moments`` gives mean and variance over the whole batch."""
    a, memo = dict(x), {}
    for y in spec.layers:
        v = a[y.inputs[0]] if len(y.inputs) == 1 else np.concatenate([a[i] for i in y.inputs], axis=1)
        if y.kind == "dense":
            v = _activate(v @ p[f"{y.name}/weight"] + p[f"{y.name}/bias"], y.activation)
        elif y.kind == "embed":
            at = v.astype(np.int64).ravel()
            if len(at) and not 0 <= at.min() <= at.max() < y.vocab:
                raise ValueError(f"ids of {y.inputs[0]} must lie in 0..{y.vocab - 1}")
            v = p[f"{y.name}/table"][at]
        elif y.kind == "norm":
            mean, var = p[f"{y.name}/mean"], p[f"{y.name}/variance"]
            if rng is not None:
                mean, var = (v.mean(axis=0), v.var(axis=0)) if across is None else across.moments(v)
            unit = (v - mean) / np.sqrt(var + EPS)
            memo[y.name] = (unit, mean, var)
            v = unit * p[f"{y.name}/gamma"] + p[f"{y.name}/beta"]
        elif y.kind == "drop" and rng is not None:
            memo[y.name] = (rng.random(v.shape) >= y.rate) / (1.0 - y.rate)
            v = v * memo[y.name]
        a[y.name] = v
        if y.name == until:
            break
    return a, memo


def loss_and_slope(loss: str, out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss of a batch and its gradient with respect to ``out``."""
    n = len(out)
    if loss == "sparse_ce":
        rows, c = np.arange(n), y.astype(np.int64).ravel()
        q, d = np.clip(out[rows, c], CLIP, 1.0), np.zeros_like(out)
        d[rows, c] = -1.0 / q / n
        return float(-np.log(q).mean()), d
    y = y.reshape(out.shape)
    if loss == "mse":
        return float(((out - y) ** 2).mean()), 2.0 * (out - y) / out.size
    if loss == "mae":
        return float(np.abs(out - y).mean()), np.sign(out - y) / out.size
    q = np.clip(out, CLIP, 1.0 - CLIP)
    pt, sign = np.where(y == 1, q, 1.0 - q), np.where(y == 1, 1.0, -1.0)
    if loss == "bce":
        return float(-np.log(pt).mean()), -sign / pt / out.size
    if loss == "focal":
        slope = 2.0 * (1.0 - pt) * np.log(pt) - (1.0 - pt) ** 2 / pt
        return float((-((1.0 - pt) ** 2) * np.log(pt)).mean()), sign * slope / out.size
    raise ValueError(f"unknown loss {loss}; use one of {LOSSES}")


def backward(spec: DenseSpec, p: dict, x: dict, labels: dict, rng, across=None, seen=None) -> tuple[list[float], dict, dict]:
    """Losses per head, gradients, and new running statistics of the normalised layers.

    With ``across`` the rows are one task's part (none, perhaps) of a batch of ``across.rows``: losses are means over the
    part, gradients are the part's share of those of the batch, statistics are of the whole batch. ``seen(head, value,
    label, loss)`` is called with the part's predictions.
    """
    a, memo = forward(spec, p, x, rng, across=across)
    down = {y.name: 0.0 for y in spec.layers}
    losses, grads, stats = [], {}, {}
    for h in spec.heads:
        rows = len(a[h.layer])
        value, d = loss_and_slope(h.loss, a[h.layer], labels[h.label]) if rows else (0.0, np.zeros_like(a[h.layer]))
        if across is not None:
            d = d * (rows / across.rows)
        if seen is not None and rows:
            seen(h, a[h.layer], labels[h.label], value)
        losses.append(value)
        down[h.layer] = down[h.layer] + d
    for y in reversed(spec.layers):
        d = down[y.name]
        if np.ndim(d) == 0:  # no head hangs on this layer
            continue
        if y.kind == "dense":
            d = _through(d, a[y.name], y.activation)
            v = a[y.inputs[0]] if len(y.inputs) == 1 else np.concatenate([a[i] for i in y.inputs], axis=1)
            grads[f"{y.name}/weight"], grads[f"{y.name}/bias"] = v.T @ d, d.sum(axis=0)
            d = d @ p[f"{y.name}/weight"].T
        elif y.kind == "embed":
            g = np.zeros_like(p[f"{y.name}/table"])
            np.add.at(g, a[y.inputs[0]].astype(np.int64).ravel(), d)
            grads[f"{y.name}/table"] = g
            continue
        elif y.kind == "norm":
            unit, mean, var = memo[y.name]
            grads[f"{y.name}/gamma"], grads[f"{y.name}/beta"] = (d * unit).sum(axis=0), d.sum(axis=0)
            for part, now in (("mean", mean), ("variance", var)):
                stats[f"{y.name}/{part}"] = MOMENTUM * p[f"{y.name}/{part}"] + (1 - MOMENTUM) * now
            d = d * p[f"{y.name}/gamma"]
            means = [d.mean(axis=0), (d * unit).mean(axis=0)] if across is None else \
                [t / across.rows for t in across.sums([d.sum(axis=0), (d * unit).sum(axis=0)])]
            d = (d - means[0] - unit * means[1]) / np.sqrt(var + EPS)
        elif y.kind == "drop":
            d = d * memo[y.name]
        start = 0
        for i in y.inputs:
            width = a[i].shape[1] if np.ndim(a[i]) == 2 else 1
            if i in down:
                down[i] = down[i] + d[:, start:start + width]
            start += width
    return losses, grads, stats


def adam(p: dict, grads: dict, m: dict, v: dict, step: int, rate: float) -> None:
    """One update in place; ``step`` counts from 1."""
    for name, g in grads.items():
        m[name] = 0.9 * m[name] + 0.1 * g
        v[name] = 0.999 * v[name] + 0.001 * g * g
        p[name] = p[name] - rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-7)
