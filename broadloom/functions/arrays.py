"""Linear algebra on array columns, for small fixed networks, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def activate(x: Column, kind: str) -> Column:
    if kind == "relu":
        return F.greatest(x, F.lit(0.0))
    if kind == "sigmoid":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    if kind == "linear":
        return x
    raise ValueError(f"unknown activation {kind}")


def softmax(a: Column) -> Column:
    top = F.array_max(a)
    e = F.transform(a, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, w: s + w))


def dense_layer(x: Column, weights: Sequence[Sequence[float]], bias: Sequence[float], activation: str) -> Column:
    """``weights[i]`` holds the input weights of unit i. Order of summation is fixed: input order."""
    if activation == "softmax":
        return softmax(dense_layer(x, weights, bias, "linear"))
    units = F.arrays_zip(F.lit([[float(w) for w in row] for row in weights]).alias("w"),
                         F.lit([float(b) for b in bias]).alias("b"))
    return F.transform(units, lambda u: activate(dot(u["w"], x) + u["b"], activation))


def batch_norm_apply(x: Column, mean: Sequence[float], variance: Sequence[float], gamma: Sequence[float],
                     beta: Sequence[float], eps: float = 1e-3) -> Column:
    """Scoring form of batch normalisation: one affine map per position, folded on the driver."""
    scale = [g / (v + eps) ** 0.5 for g, v in zip(gamma, variance)]
    shift = [b - m * s for b, m, s in zip(beta, mean, scale)]
    scaled = F.zip_with(x, F.lit(scale), lambda a, s: a * s)
    return F.zip_with(scaled, F.lit(shift), lambda a, s: a + s)
