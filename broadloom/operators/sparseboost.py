"""Boosting over column-compressed blocks: work and storage follow the cells that are not zero.

Rows are laid out once as blocks of up to BLOCK_ROWS rows. A block holds, feature by feature, the row numbers and bins of
the cells that do not fall into the bin of 0.0; the rest is implied. A level adds the gradients of stored cells only. What
the bin of 0.0 holds is the node's total minus the stored cells of the feature, made once a task and level.
Splits, sibling subtraction and the model are those of ``boosting``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.boosting import MISSING, BoostModel, class_weight, gradient, grow_trees, tree_values
from broadloom.operators.boosting import tree_nodes as nodes_of
from broadloom.operators.columns import floats
from broadloom.operators.quantiles import weighted_edges
from broadloom.session import materialize

BLOCK_ROWS = 16384  # row numbers of a block take 16 bits
BLOCK_SCHEMA = "label binary, weight binary, margin binary, starts binary, rows binary, bins binary"


def zero_bins(edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of 0.0 of every feature."""
    return np.array([np.searchsorted(np.asarray(e, float), 0.0, side="right") for e in edges], np.int64)


def to_blocks(df: DataFrame, features: str, label: Column, weight: Column, edges: Sequence[Sequence[float]],
              base_margin: float = 0.0) -> DataFrame:
    """Blocks of ``df``: one row per block, numbers as plain bytes. NaN and null elements are stored as missing; an empty
    partition gives no block."""
    cuts, zeros = [np.asarray(e, dtype=np.float64) for e in edges], zero_bins(edges)
    if max((len(c) for c in cuts), default=0) >= MISSING:
        raise ValueError(f"at most {MISSING - 1} cut points per feature")

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = floats(batch.column(0), len(cuts), features)
                starts, rows, bins = np.zeros(len(cuts) + 1, np.int64), [], []
                for f, c in enumerate(cuts):
                    v = x[:, f]
                    b = np.full(len(v), zeros[f], np.uint8)
                    other = np.flatnonzero(v)  # NaN counts as not zero
                    b[other] = np.searchsorted(c, v[other], side="right")
                    b[np.isnan(v)] = MISSING
                    kept = other[b[other] != zeros[f]]
                    rows.append(kept.astype(np.uint16))
                    bins.append(b[kept])
                    starts[f + 1] = starts[f] + len(kept)
                y, w = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2))
                margin = np.full(len(y), float(base_margin))
                parts = (y, w, margin, starts, np.concatenate(rows), np.concatenate(bins))
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts],
                                                 names=["label", "weight", "margin", "starts", "rows", "bins"])

    return df.select(F.col(features), label, weight).mapInArrow(lay_out, BLOCK_SCHEMA)


def _numbers(batch: pa.RecordBatch, name: str, kind: type, row: int) -> np.ndarray:
    return np.frombuffer(batch.column(batch.schema.get_field_index(name))[row].as_buffer(), kind)


def narrow(trees: Sequence[dict], zeros: np.ndarray, starts: np.ndarray, rows: np.ndarray, bins: np.ndarray,
           n: int) -> tuple[list[dict], np.ndarray]:
    """The trees with their split features renumbered, and a dense matrix of these features only."""
    used = np.unique(np.concatenate([t["feature"][t["feature"] >= 0] for t in trees] + [np.zeros(0, np.int32)])).astype(np.int64)
    x = np.empty((n, max(1, len(used))), np.uint8)
    for k, f in enumerate(used):
        x[:, k] = zeros[f]
        cells = slice(starts[f], starts[f + 1])
        x[rows[cells], k] = bins[cells]
    return [t | {"feature": np.where(t["feature"] >= 0, np.searchsorted(used, t["feature"]), -1)} for t in trees], x


def block_histograms(zeros: np.ndarray):
    """``boosting._histograms`` over blocks."""

    def histograms(data: DataFrame, trees: list[dict], current: dict, active: Sequence[int], dim: int, bins: int,
                   objective: str) -> DataFrame:
        slots = np.full(len(current["feature"]), -1, np.int64)
        slots[list(active)] = np.arange(len(active))
        width, count = bins + 1, len(active)
        shared = data.sparkSession.sparkContext.broadcast((trees, current))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done, now = shared.value
            total = np.zeros((2, count, dim, width))
            flat = total.reshape(2, -1)
            whole, rows_of, cells_of = np.zeros((2, count)), np.zeros(count, np.int64), np.zeros(count * dim, np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    y, w, margin = (_numbers(batch, c, np.float64, i) for c in ("label", "weight", "margin"))
                    starts, rows, cells = (_numbers(batch, c, t, i) for c, t in (("starts", np.int64), ("rows", np.uint16), ("bins", np.uint8)))
                    few, x = narrow([*done, now], zeros, starts, rows, cells, len(y))
                    margin = tree_values(few[:-1], x, margin)
                    if objective == "binary:logistic":
                        p = 1.0 / (1.0 + np.exp(-margin))
                        g, h = w * (p - y), w * p * (1.0 - p)
                    else:
                        g, h = w * (margin - y), w
                    slot = slots[nodes_of(few[-1], x)]
                    mine = slot >= 0
                    for k, v in enumerate((g, h)):
                        whole[k] += np.bincount(slot[mine], weights=v[mine], minlength=count)
                    rows_of += np.bincount(slot[mine], minlength=count)
                    keep = np.flatnonzero(mine[rows])
                    row = rows[keep]
                    cell = slot[row] * dim + np.repeat(np.arange(dim), np.diff(starts))[keep]
                    np.add.at(cells_of, cell, 1)
                    place = cell * width + np.minimum(cells[keep], bins)
                    np.add.at(flat[0], place, g[row])
                    np.add.at(flat[1], place, h[row])
            implied = cells_of.reshape(count, dim) < rows_of[:, None]  # rows whose cell of the feature is not stored
            for k, node in enumerate(active):
                if not rows_of[k]:
                    continue
                part = total[:, k]
                left = np.where(implied[k], whole[:, k, None] - part.sum(axis=2), 0.0)
                left[1] = np.maximum(left[1], 0.0)
                part[:, np.arange(dim), zeros] += left
                part[:, :, :bins] = np.cumsum(part[:, :, :bins], axis=2)
                both = np.concatenate([part[0], part[1]], axis=1)
                offsets = np.arange(dim + 1, dtype=np.int32) * (2 * width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(dim, node, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(both.ravel()))], names=["node", "feature", "sums"])

        partial = data.mapInArrow(sums, "node int, feature int, sums array<double>")
        return partial.groupBy("node", "feature").agg(
            vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("sums"))["sum"]).alias("s"))

    return histograms


def block_margins(zeros: np.ndarray):
    """Adds trees to the margins of blocks."""

    def with_margins(data: DataFrame, trees: list[dict]) -> DataFrame:
        @F.arrow_udf("binary")
        def added(margin: pa.Array, starts: pa.Array, rows: pa.Array, bins: pa.Array) -> pa.Array:
            out = []
            for m, *cells in zip(margin, starts, rows, bins):
                m = np.frombuffer(m.as_buffer(), np.float64)
                s, r, b = (np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, (np.int64, np.uint16, np.uint8)))
                few, x = narrow(trees, zeros, s, r, b, len(m))
                out.append(tree_values(few, x, m).tobytes())
            return pa.array(out, pa.binary())

        return data.withColumn("margin", added("margin", "starts", "rows", "bins"))

    return with_margins


def fit_sparse_boost(df: DataFrame, features: str, label: str, objective: str = "binary:logistic", eta: float = 0.1,
                     gamma: float = 0.1, reg_lambda: float = 1.0, min_child_weight: float = 30.0, pos_weight: float = 1.0,
                     max_depth: int = 6, num_round: int = 200, base_margin: float = 0.0,
                     edges: Sequence[Sequence[float]] | None = None, max_bins: int = MISSING, refresh: int = 25,
                     subtract: bool = True, partitions: int | None = None) -> BoostModel:
    """``boosting.fit_hist_boost`` for tables with many zeros: same arguments, same trees up to rounding, and the model is
    scored by the same functions. A null or NaN label, a null array and arrays of unequal length are errors."""
    y = F.col(label).cast("double")
    weight = class_weight(y, pos_weight)
    if edges is None:
        edges = weighted_edges(df, features, gradient(y, F.lit(float(base_margin)), weight, objective)[1], max_bins)
    if not df.where(y.isNull() | F.isnan(y)).isEmpty():
        raise ValueError(f"{label}: null or NaN labels")
    rows = df if partitions is None else df.repartition(partitions)
    zeros = zero_bins(edges)
    data = materialize(to_blocks(rows, features, y.alias("label"), weight.alias("weight"), edges, base_margin), "blocks")
    return grow_trees(data, block_histograms(zeros), block_margins(zeros), edges, objective, eta, gamma, reg_lambda,
                      min_child_weight, max_depth, num_round, base_margin, refresh, subtract)
