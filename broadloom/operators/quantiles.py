"""Weighted quantiles of many features at once, from mergeable summaries built in the tasks.

A task reads rows as they are, without exploding rows x features. Per feature it sorts blocks of values into summaries of at
most POINTS points; FAN summaries of one level are merged into one of the next. Spark shuffles one summary per feature and
task, and merges those of a feature as a stream in the same way. A summary of POINTS distinct values or fewer is exact;
each level that compresses adds at most half a point's weight, total / (2 * POINTS), to the error of a rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.columns import floats

POINTS = 1024
FAN = 4
BLOCK_ROWS = 4096


def summary(values: np.ndarray, weights: np.ndarray, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their weights; above ``points`` of them, that many values of equal weight at the
    middles of equal parts of the total."""
    order = np.argsort(values, kind="stable")
    v, w = values[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.empty(0, np.int64)
    v, w = v[starts], np.add.reduceat(w, starts) if len(starts) else w
    if len(v) <= points:
        return v, w
    total = np.cumsum(w)
    at = np.searchsorted(total, (np.arange(points) + 0.5) * (total[-1] / points))
    return v[np.minimum(at, len(v) - 1)], np.full(points, total[-1] / points)


class Summaries:
    """Summaries of one feature, FAN of a level at most."""

    def __init__(self, points: int):
        self.points, self.levels = points, []

    def add(self, values: np.ndarray, weights: np.ndarray, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(summary(values, weights, self.points))
        if len(self.levels[level]) == FAN:
            held, self.levels[level] = self.levels[level], []
            self.add(*(np.concatenate(x) for x in zip(*held)), level + 1)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        held = [s for level in self.levels for s in level]
        if not held:
            return np.empty(0), np.empty(0)
        return summary(*(np.concatenate(x) for x in zip(*held)), self.points)


def cut_points(values: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """Distinct values at which the running weight reaches i / parts of the total, 0 < i < parts, above the smallest value."""
    if not len(values):
        return np.empty(0)
    total = np.cumsum(weights)
    at = np.searchsorted(total, np.arange(1, parts) * (total[-1] / parts) * (1 - 1e-12))
    found = np.unique(values[np.minimum(at, len(values) - 1)])
    return found[found > values[0]]


def weighted_edges(df: DataFrame, features: str, weight: Column | None = None, max_bins: int = 255, points: int = POINTS) -> list[list[float]]:
    """Cut points per feature of an array<double> column, at most ``max_bins - 1``, that split the total ``weight`` evenly.

    ``weight``: a column, 1 by default; for boosting the second derivative of the loss. Null and NaN elements are left out, a
    feature without values has no cut points; rows of weight 0 or null weigh nothing; a negative weight is an error. Arrays of
    unequal length are an error, an empty table gives an empty list. The driver sees the cut points only.
    """
    schema = "feature int, values array<double>, weights array<double>"

    def row(feature: int, v: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([feature], pa.int32()), pa.array([v], pa.list_(pa.float64())), pa.array([w], pa.list_(pa.float64()))],
                                          names=["feature", "values", "weights"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Summaries] = []
        for batch in batches:
            x = floats(batch.column(0), name=features)
            w = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            if (w < 0).any():
                raise ValueError("negative weight")
            if len(x) and not held:
                held = [Summaries(points) for _ in range(x.shape[1])]
            if len(x) and x.shape[1] != len(held):
                raise ValueError(f"{features}: arrays of {len(held)} and of {x.shape[1]} values")
            for a in range(0, len(x), BLOCK_ROWS):
                part, some = np.ascontiguousarray(x[a:a + BLOCK_ROWS].T), w[a:a + BLOCK_ROWS]
                for f, s in enumerate(held):
                    keep = ~np.isnan(part[f]) & (some > 0)
                    s.add(part[f][keep], some[keep])
        for f, s in enumerate(held):
            yield row(f, *s.merged())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for f, v, w in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if f != at:
                    if held is not None:
                        yield row(at, cut_points(*held.merged(), max_bins), np.empty(0))
                    at, held = f, Summaries(points)
                held.add(v.values.to_numpy(zero_copy_only=False), w.values.to_numpy(zero_copy_only=False))
        if held is not None:
            yield row(at, cut_points(*held.merged(), max_bins), np.empty(0))

    weighed = df.select(F.col(features), F.coalesce((F.lit(1.0) if weight is None else weight).cast("double"), F.lit(0.0)).alias("_w"))
    parts = weighed.mapInArrow(summarise, schema).repartition("feature").sortWithinPartitions("feature")
    found = {r.feature: list(r["values"]) for r in parts.mapInArrow(merge, schema).collect()}  # one row per feature
    return [found[f] for f in sorted(found)]
