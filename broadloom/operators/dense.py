"""Data-parallel dense networks: fit by local mini-batches with averaging, gradients, scoring, storage.

One Spark job per epoch. Every task starts from the broadcast parameters, walks its partition in
mini-batches with Adam and returns its parameters; Spark averages them, weighted by rows, in an
aggregate keyed by parameter chunk (parallel SGD: Zinkevich et al. 2010; local SGD: Stich 2019). The
driver and the broadcast hold one copy of the parameters: their size is set by the spec, not by the
data. Averaging per epoch is not the curve of synchronous steps; with ``partitions=1`` it is.

Training is deterministic up to the last bits of the averages: rows are laid out by key before the
first epoch, and a lost task replays the same rows from the same parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadloom.functions import metrics
from broadloom.operators import network as net
from broadloom.operators.columns import floats
from broadloom.operators.network import DenseSpec
from broadloom.operators.prepare import batch_plan
from broadloom.session import latest, publish

CHUNK = 65536
LOG_SCHEMA = "run string, epoch int, step long, metric string, value double"


PARAM_SCHEMA = "part string, layer string, name string, shape array<int>, values array<double>, text string"


@dataclass
class DenseModel:
    spec: DenseSpec
    params: dict[str, np.ndarray]

    def param_table(self, spark: SparkSession) -> DataFrame:
        rows = [(*n.split("/"), list(v.shape), v.ravel().tolist()) for n, v in sorted(self.params.items())]
        return spark.createDataFrame(rows, "layer string, name string, shape array<int>, values array<double>")


@dataclass
class TrainState:
    """A model in training: Adam's moments, epochs done and steps done."""

    model: DenseModel
    m: dict[str, np.ndarray]
    v: dict[str, np.ndarray]
    epoch: int = 0
    step: int = 0

    @staticmethod
    def start(model: DenseModel) -> TrainState:
        return TrainState(model, *({n: np.zeros_like(a) for n, a in model.params.items()} for _ in range(2)))


def save_state(spark: SparkSession, state: TrainState, path: str) -> None:
    """One row a parameter or moment, published as the next version in ``path``: a save that fails leaves the last one."""
    rows = [("spec", "", "", [state.epoch, state.step], [], state.model.spec.to_json())]
    for part, values in (("p", state.model.params), ("m", state.m), ("v", state.v)):
        rows += [(part, *n.split("/"), list(a.shape), a.ravel().tolist(), None) for n, a in sorted(values.items())]
    publish(spark.createDataFrame(rows, PARAM_SCHEMA), path)


def load_state(spark: SparkSession, path: str) -> TrainState:
    parts: dict[str, dict] = {"p": {}, "m": {}, "v": {}}
    for r in latest(spark, path).collect():  # one row a parameter
        if r.part == "spec":
            spec, (epoch, step) = DenseSpec.from_json(r.text), r["shape"]
        else:
            parts[r.part][f"{r.layer}/{r.name}"] = np.array(r["values"]).reshape(r["shape"])
    return TrainState(DenseModel(spec, parts["p"]), parts["m"], parts["v"], epoch, step)


def save_params(spark: SparkSession, model: DenseModel, path: str) -> None:
    save_state(spark, TrainState(model, {}, {}), path)


def load_params(spark: SparkSession, path: str) -> DenseModel:
    return load_state(spark, path).model


# --- batches ------------------------------------------------------------------------------------


def _matrix(column: pa.Array, name: str, width: int | None = None) -> np.ndarray:
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        return floats(column, width or None, name)
    return column.to_numpy(zero_copy_only=False).reshape(-1, 1)


def _columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Numbers as double, arrays as array<double>."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [F.col(n).cast("array<double>" if isinstance(kinds[n], T.ArrayType) else "double").alias(n)
            for n in names]


def _rebatch(batches: Iterator[pa.RecordBatch], size: int, widths: dict[str, int]) -> Iterator[dict[str, np.ndarray]]:
    """Batches of ``size`` rows; what is left at the end of the partition is a smaller one."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {n: _matrix(batch.column(i), n, widths.get(n)) for i, n in enumerate(batch.schema.names)}
        held = {n: np.concatenate([held[n], v]) if held else v for n, v in new.items()}
        n = len(next(iter(held.values())))
        full = n - n % size
        for at in range(0, full, size):
            yield {k: v[at:at + size] for k, v in held.items()}
        held = {k: v[full:] for k, v in held.items()}
    if held and len(next(iter(held.values()))):
        yield held


# --- fit ----------------------------------------------------------------------------------------


def _epoch(spec: DenseSpec, shared, size: int, first: int, rate: Callable[[int], float], seed: int):
    names, labels = list(spec.inputs), [h.label for h in spec.heads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, m, v = (dict(d) for d in shared.value)
        step, rows, total, rng = first, 0, np.zeros(len(spec.heads)), None
        for b in _rebatch(batches, size, spec.inputs):
            if rng is None:  # dropout masks depend on the data held, not on the task number
                mark = int(abs(np.nan_to_num(next(iter(b.values()))).sum()) * 1e6) % 2 ** 31
                rng = np.random.default_rng([seed, first, mark])
            losses, grads, stats = net.backward(spec, p, {n: b[n] for n in names}, {n: b[n] for n in labels}, rng)
            if not np.isfinite(losses).all():
                raise ValueError("loss is not finite: null or NaN in the rows, or a rate too high")
            step += 1
            n = len(next(iter(b.values())))
            if n < size:  # a partial batch weighs as many rows as it has
                grads = {k: g * (n / size) for k, g in grads.items()}
            net.adam(p, grads, m, v, step, rate(step))
            p.update(stats)
            rows += n
            total += np.array(losses) * n
        if rows == 0:
            return
        parts = {f"{k}:{n}": a for k, d in (("p", net.squared_spread(p)), ("m", m), ("v", v)) for n, a in d.items()}
        parts["loss:"] = total / rows
        parts["rows:"] = np.array([float(rows)])
        for n, a in parts.items():
            flat = np.ravel(a)
            for c, at in enumerate(range(0, len(flat), CHUNK)):
                yield pa.RecordBatch.from_pydict({
                    "name": [n], "chunk": pa.array([c], pa.int32()), "rows": pa.array([rows], pa.int64()),
                    "values": pa.array([flat[at:at + CHUNK]], pa.list_(pa.float64()))})

    return run


def _average(parts: DataFrame) -> dict[str, np.ndarray]:
    """Means over the tasks, weighted by rows, put together from their chunks; ``rows:`` is the number of rows."""
    mean = Summarizer.metrics("mean").summary(array_to_vector("values"), F.col("rows").cast("double"))["mean"]
    out: dict[str, dict[int, list]] = {}
    for r in parts.groupBy("name", "chunk").agg(vector_to_array(mean).alias("values"), F.sum("rows").alias("rows")).collect():
        out.setdefault(r.name, {})[r.chunk] = [r.rows] if r.name == "rows:" else r["values"]
    return {n: np.concatenate([np.array(c[i]) for i in sorted(c)]) for n, c in out.items()}


def head_losses(df: DataFrame, spec: DenseSpec, prediction: str = "prediction") -> list[Column]:
    """Loss of every head as a row expression over a scored table."""
    out, width = [], spec.widths()
    for h in spec.heads:
        value = F.col(prediction) if len(spec.heads) == 1 else F.col(prediction)[h.layer]
        if h.loss == "mse" and width[h.layer] > 1:
            out.append(metrics.squared_array(h.label, value))
        else:
            row = {"mse": metrics.squared, "mae": metrics.absolute, "bce": metrics.bce, "focal": metrics.focal,
                   "sparse_ce": metrics.sparse_ce}[h.loss]
            out.append(row(F.col(h.label), value))
    return out


def validation_metrics(df: DataFrame, model: DenseModel) -> dict[str, float]:
    scored = score_dense(df, model)
    names = [f"val_{h.layer}_{h.loss}" for h in model.spec.heads]
    row = scored.agg(*[F.avg(e).alias(n) for e, n in zip(head_losses(scored, model.spec), names)]).first()
    return {n: row[n] for n in names}


def fit_dense(df: DataFrame, spec: DenseSpec, key: str, batch_size: int = 32, epochs: int = 1,
              rate: float | Callable[[int], float] = 1e-3, validation: DataFrame | None = None,
              init: DenseModel | None = None, partitions: int | None = None, seed: int = 0,
              run: str = "fit", drop_last: bool = False) -> tuple[DenseModel, DataFrame]:
    """Fit; returns the model and the log table (run, epoch, step, metric, value).

    ``key`` is a unique row id; it fixes the layout. ``batch_size`` is global: each of P partitions steps through
    batch_size // P rows at a time, so an epoch has about rows / batch_size steps. P is ``partitions``, by default the
    number of partitions of the input; with more partitions than rows in a batch, each takes one row a step. Every row is
    trained in every epoch: the batch at the end of a partition may be smaller and weighs as many rows as it has. ``drop_last`` trains on whole batches of the
    table only: the first rows // batch_size * batch_size rows by key. The log's metric ``rows`` counts trained rows.
    ``init`` continues from a fitted model of the same spec.
    """
    spark = df.sparkSession
    columns = list(dict.fromkeys([*spec.inputs, *(h.label for h in spec.heads)]))
    parts = max(1, partitions or df.rdd.getNumPartitions())
    local = max(1, batch_size // parts)
    taken = df.select(F.col(key).alias("_key"), *_columns(df, columns))
    if drop_last:
        taken = batch_plan(taken, "_key", batch_size).drop("row_index", "batch")
    laid = taken.repartition(parts, "_key").sortWithinPartitions("_key").select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    rows = laid.count()
    if not rows:
        laid.unpersist()
        raise ValueError("no rows to train on" + (f": fewer than one batch of {batch_size}" if drop_last else ""))
    steps = -(-rows // max(batch_size, parts))
    if validation is not None:
        validation = validation.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        params = dict(init.params) if init else net.initial(spec, seed)
        zeros = {n: np.zeros_like(a) for n, a in params.items() if net.trainable(n)}
        m, v, log = zeros, dict(zeros), []
        at = rate if callable(rate) else (lambda step, r=rate: r)
        for epoch in range(epochs):
            shared = spark.sparkContext.broadcast((params, m, v))
            task = _epoch(spec, shared, local, epoch * steps, at, seed)
            found = _average(laid.mapInArrow(task, "name string, chunk int, rows long, values array<double>"))
            shared.unpersist()
            shaped = net.spread({n: found[f"p:{n}"].reshape(a.shape) for n, a in params.items()})
            m, v = ({n: found[f"{k}:{n}"].reshape(a.shape) for n, a in zeros.items()} for k in "mv")
            params = shaped
            done = (epoch + 1) * steps
            for h, value in zip(spec.heads, found["loss:"]):
                log.append((run, epoch, done, f"{h.layer}_{h.loss}", float(value)))
            log.append((run, epoch, done, "rows", float(found["rows:"].sum())))
            if validation is not None:
                now = validation_metrics(validation, DenseModel(spec, params))
                log += [(run, epoch, done, n, float(x)) for n, x in now.items()]
    finally:
        laid.unpersist()
        if validation is not None:
            validation.unpersist()
    return DenseModel(spec, params), spark.createDataFrame(log, LOG_SCHEMA)


def _gradient_parts(df: DataFrame, model: DenseModel) -> DataFrame:
    """Gradients of the mean loss by task: (name, chunk, rows, values)."""
    spec = model.spec
    names, labels = list(spec.inputs), list(dict.fromkeys(h.label for h in spec.heads))
    shared = df.sparkSession.sparkContext.broadcast(model.params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = {}, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            b = {n: _matrix(batch.column(i), n, spec.inputs.get(n)) for i, n in enumerate(batch.schema.names)}
            _, grads, _ = net.backward(spec, shared.value, {n: b[n] for n in names},
                                       {n: b[n] for n in labels}, np.random.default_rng(0))
            rows += batch.num_rows
            for n, g in grads.items():
                total[n] = total.get(n, 0.0) + np.ravel(g) * batch.num_rows
        for n, g in total.items():
            for c, at in enumerate(range(0, len(g), CHUNK)):
                yield pa.RecordBatch.from_pydict({
                    "name": [n], "chunk": pa.array([c], pa.int32()), "rows": pa.array([rows], pa.int64()),
                    "values": pa.array([g[at:at + CHUNK] / rows], pa.list_(pa.float64()))})

    return df.select(*_columns(df, list(dict.fromkeys([*names, *labels])))).mapInArrow(
        run, "name string, chunk int, rows long, values array<double>")


def batch_gradient(df: DataFrame, model: DenseModel) -> DataFrame:
    """Gradient of the mean loss over the whole table: (name, position, value). One job; every task
    gives one row per parameter chunk."""
    parts = _gradient_parts(df, model)
    mean = Summarizer.metrics("mean").summary(array_to_vector("values"), F.col("rows").cast("double"))["mean"]
    averaged = parts.groupBy("name", "chunk").agg(vector_to_array(mean).alias("values"))
    return averaged.select("name", F.posexplode("values").alias("pos", "value"), "chunk").select(
        "name", (F.col("chunk") * F.lit(CHUNK) + F.col("pos")).alias("position"), "value")


def fit_full_batch(df: DataFrame, spec: DenseSpec, epochs: int = 1, rate: float = 1e-3,
                   init: DenseModel | None = None, seed: int = 0) -> DenseModel:
    """Synchronous training: each epoch is one gradient over the whole table and one Adam update.

    The result does not depend on partitioning, up to the last bits. For small nets on large tables; use
    ``fit_dense`` where many steps per pass are wanted. Not for normalised or dropped layers, whose values
    depend on the batch.
    """
    if any(y.kind in ("norm", "drop") for y in spec.layers):
        raise ValueError("full-batch steps are defined for dense, embed and concat layers")
    params = dict(init.params) if init else net.initial(spec, seed)
    m, v = ({n: np.zeros_like(a) for n, a in params.items()} for _ in range(2))
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for step in range(1, epochs + 1):
            found = _average(_gradient_parts(df, DenseModel(spec, params)))
            grads = {n: found.get(n, np.zeros(a.size)).reshape(a.shape) for n, a in params.items()}
            net.adam(params, grads, m, v, step, rate)
    finally:
        df.unpersist()
    return DenseModel(spec, params)


# --- score --------------------------------------------------------------------------------------


def score_dense(df: DataFrame, model: DenseModel, out: str = "prediction", layer: str | None = None) -> DataFrame:
    """Append ``out``: a double for one head of one unit, an array for one wider head, a struct of
    arrays (by head layer) for several. ``layer`` asks for the value of an inner layer instead."""
    spec, width = model.spec, model.spec.widths()
    heads = [layer] if layer else [h.layer for h in spec.heads]
    names = list(spec.inputs)
    shared = df.sparkSession.sparkContext.broadcast(model.params)

    def values(columns: Sequence[pa.Array]) -> list[pa.Array]:
        a, _ = net.forward(spec, shared.value, {n: _matrix(c, n, spec.inputs[n]) for n, c in zip(names, columns)}, until=layer)
        found = []
        for h in heads:
            m = np.ascontiguousarray(a[h], dtype=np.float64)
            offsets = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
            found.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel())))
        return found

    arguments = _columns(df, names)
    if len(heads) == 1:
        if width[heads[0]] == 1 and layer is None:
            @F.arrow_udf("double")
            def one(*columns: pa.Array) -> pa.Array:
                return values(columns)[0].flatten()
            return df.withColumn(out, one(*arguments))

        @F.arrow_udf("array<double>")
        def many(*columns: pa.Array) -> pa.Array:
            return values(columns)[0]
        return df.withColumn(out, many(*arguments))

    @F.arrow_udf("struct<" + ", ".join(f"{h}: array<double>" for h in heads) + ">")
    def several(*columns: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(values(columns), names=heads)
    return df.withColumn(out, several(*arguments))


def transfer_spec(width: int, label: str, units: Sequence[int] = (512, 256, 128, 64),
                  column: str = "frozen") -> DenseSpec:
    """New head over the frozen features of a fitted model. Units and layer names."""
    chain = net.dense_chain(column, list(units), [f"d{i}" for i in range(len(units))])
    out = net.Layer("output", "dense", (chain[-1].name,), 1, "linear")
    return DenseSpec({column: width}, (*chain, out), (net.Head("output", label, "mse"),))


def frozen_features(df: DataFrame, parent: DenseModel, layer: str = "concatenate", out: str = "frozen") -> DataFrame:
    """Value of an inner layer of the parent: computed once per row, as its weights no longer move."""
    return score_dense(df, parent, out, layer)
