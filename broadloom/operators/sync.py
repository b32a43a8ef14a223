"""Synchronous data-parallel training: one barrier stage an epoch, gradients summed over all tasks at every step.

A row's place in key order fixes its batch, so the steps are those of one task over the whole table, whatever the number of
tasks: every task sums the gradients of its part of the batch, the parts are gathered chunk by chunk and added in the same
order everywhere, and each task takes the same step; of an embedding table only the rows that a part looks up are sent. Batch normalisation uses the moments of the whole batch, dropout a
hash of (row, unit, step). With ``sync_every`` = k > 1 tasks take k steps of their own and then average (local SGD: Stich 2019).
The k steps of all tasks are one small job then, on the partitions that hold their rows, and the driver averages what the tasks
return; a net of more than ROUND_BYTES is averaged by gathers instead.

Each gather sends the gradients of all tasks to each task, through the barrier coordinator, and takes a second at least, as
waiting tasks look for its end once a second; each normalised layer takes two more. So ``sync_every`` = 1 is for steps of
seconds of work, else take more: 10 to 100 steps between averages. What a task holds is its parameters, one part of a batch,
and counters.

Metrics are counted where the rows are: losses, confusion counts, score histograms, errors. Tasks emit these counters for every
``log_every`` steps and the epoch's aggregate adds them. If an executor is lost, Spark repeats the epoch from its start, or the
job of its k steps; a fit that ends half-way is taken up after its last saved epoch.
"""

from __future__ import annotations

import base64
import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, BarrierTaskContext, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.operators import network as net
from broadloom.operators.dense import CHUNK, LOG_SCHEMA, DenseModel, TrainState, _columns, _matrix, load_state, save_state
from broadloom.operators.network import DenseSpec, Head
from broadloom.operators.prepare import with_running_totals
from broadloom.session import versions

BINS = 200  # of the score histogram behind the area under the curve
#: Bytes of parameters and moments up to which they go with a job of some steps and come back to the driver from each task.
ROUND_BYTES = 1 << 20
#: Rows that a partition of such jobs should hold at least: those of one job, or of several in a row.
ROUND_ROWS = 100000
NOT_FINITE = "loss is not finite: null or NaN in the rows, or a rate too high"
PART_SCHEMA = "name string, chunk int, values array<double>"


# --- metrics as mergeable counters --------------------------------------------------------------


def head_kind(spec: DenseSpec, head: Head) -> str:
    if head.loss in ("bce", "focal"):
        return "binary"
    return "classes" if head.loss == "sparse_ce" else "values"


def head_counts(kind: str, out: np.ndarray, y: np.ndarray, loss: float) -> np.ndarray:
    """Counters of one head over some rows; counters of different rows add up.

    All: rows, summed loss. Binary: true and false positives and negatives at one half, then the scores of the positives and
    of the negatives in BINS bins. Classes: right ones. Values: summed absolute and squared error.
    """
    n = len(out)
    base = [n, loss * n]
    if kind == "classes":
        return np.array([*base, (out.argmax(axis=1) == y.ravel()).sum()])
    y = y.reshape(out.shape)
    if kind == "values":
        gap = out - y
        return np.array([*base, np.abs(gap).mean(axis=1).sum(), (gap * gap).mean(axis=1).sum()])
    p, positive = out.ravel(), y.ravel() == 1
    said = p > 0.5
    four = [(said & positive).sum(), (~said & ~positive).sum(), (said & ~positive).sum(), (~said & positive).sum()]
    bins = np.minimum((p * BINS).astype(np.int64), BINS - 1)
    return np.concatenate([base, four, np.bincount(bins[positive], minlength=BINS), np.bincount(bins[~positive], minlength=BINS)]).astype(float)


def head_metrics(kind: str, counts: np.ndarray) -> dict[str, float]:
    """Metrics of one head from its counters. The area under the curve takes scores of one bin as tied."""
    n = max(counts[0], 1.0)
    if kind == "classes":
        return {"accuracy": counts[2] / n}
    if kind == "values":
        return {"mae": counts[2] / n, "mse": counts[3] / n}
    tp, tn, fp, fn = counts[2:6]
    pos, neg = counts[6:6 + BINS], counts[6 + BINS:]
    below = np.concatenate([[0.0], np.cumsum(neg)[:-1]])
    pairs = pos.sum() * neg.sum()
    return {"accuracy": (tp + tn) / n, "precision": tp / (tp + fp) if tp + fp else 0.0, "recall": tp / (tp + fn) if tp + fn else 0.0,
            "auc": float((pos * (below + neg / 2)).sum() / pairs) if pairs else 0.0, "tp": tp, "tn": tn, "fp": fp, "fn": fn}


def _named(spec: DenseSpec, counts: Sequence[np.ndarray]) -> dict[str, float]:
    out = {}
    for h, c in zip(spec.heads, counts):
        out[f"{h.layer}_{h.loss}"] = float(c[1] / max(c[0], 1.0))
        out |= {f"{h.layer}_{m}": float(v) for m, v in head_metrics(head_kind(spec, h), c).items() if m != h.loss}
    return out


def _emit(name: str, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = np.ravel(values)
    for c, at in enumerate(range(0, len(flat), CHUNK)):
        yield pa.RecordBatch.from_pydict({"name": [name], "chunk": pa.array([c], pa.int32()), "values": pa.array([flat[at:at + CHUNK]], pa.list_(pa.float64()))})


def _added(parts: DataFrame) -> dict[str, np.ndarray]:
    """Sums over the tasks, by name, put together from their chunks."""
    total = vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("values"))["sum"])
    out: dict[str, dict[int, list]] = {}
    for r in parts.groupBy("name", "chunk").agg(total.alias("values")).collect():
        out.setdefault(r.name, {})[r.chunk] = r["values"]
    return {n: np.concatenate([np.array(c[i]) for i in sorted(c)]) for n, c in out.items()}


def evaluate(df: DataFrame, model: DenseModel) -> dict[str, float]:
    """Losses and metrics of every head over a table, in one pass; a task sends one row of counters a head."""
    spec = model.spec
    names, labels = list(spec.inputs), list(dict.fromkeys(h.label for h in spec.heads))
    shared = df.sparkSession.sparkContext.broadcast(model.params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                b = {n: _matrix(batch.column(i), n, spec.inputs.get(n)) for i, n in enumerate(batch.schema.names)}
                a, _ = net.forward(spec, shared.value, {n: b[n] for n in names})
                for i, h in enumerate(spec.heads):
                    loss, _ = net.loss_and_slope(h.loss, a[h.layer], b[h.label])
                    total[i] = total.get(i, 0.0) + head_counts(head_kind(spec, h), a[h.layer], b[h.label], loss)
        for i, counts in total.items():
            yield from _emit(str(i), counts)

    found = _added(df.select(*_columns(df, list(dict.fromkeys([*names, *labels])))).mapInArrow(run, PART_SCHEMA))
    return _named(spec, [found[str(i)] for i in range(len(spec.heads))]) if found else {}


# --- inside a task ------------------------------------------------------------------------------


class Across:
    """Sums over the tasks of a barrier stage. All tasks add in the same order: their results are equal to the last bit."""

    def __init__(self, context, tasks: int):
        self.context, self.tasks, self.rows = context, tasks, 0

    def gathered(self, values: np.ndarray) -> list[np.ndarray]:
        if self.tasks == 1:
            return [values]
        parts: list[list[bytes]] = [[] for _ in range(self.tasks)]
        for at in range(0, len(values), CHUNK):
            sent = self.context.allGather(base64.b64encode(values[at:at + CHUNK].astype("<f8").tobytes()).decode())
            for p, text in zip(parts, sent):
                p.append(base64.b64decode(text))
        return [np.frombuffer(b"".join(p), "<f8") for p in parts]

    def sums(self, arrays: Sequence[np.ndarray]) -> list[np.ndarray]:
        total = np.add.reduce(self.gathered(np.concatenate([np.ravel(a) for a in arrays]).astype(np.float64)))
        cuts = np.cumsum([np.size(a) for a in arrays])[:-1]
        return [t.reshape(np.shape(a)) for t, a in zip(np.split(total, cuts), arrays)]

    def table_sum(self, grad: np.ndarray, most: int) -> np.ndarray:
        """Sum of a gradient of which each task touches at most ``most`` rows: only these are sent, with their numbers. Equal to
        the sum of whole tables to the last bit."""
        most = min(most, len(grad))
        touched = np.flatnonzero(grad.any(axis=1))
        told = np.full((most, 1 + grad.shape[1]), -1.0)
        told[:len(touched), 0], told[:len(touched), 1:] = touched, grad[touched]
        total = np.zeros_like(grad)
        for part in self.gathered(told.ravel()):
            part = part.reshape(most, -1)
            part = part[part[:, 0] >= 0]
            total[part[:, 0].astype(np.int64)] += part[:, 1:]
        return total

    def moments(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and variance of the columns over all tasks, from each task's (n, mean, squared deviations)."""
        width, n = v.shape[1], len(v)
        mean = v.mean(axis=0) if n else np.zeros(width)
        told = np.concatenate([[float(n)], mean, ((v - mean) ** 2).sum(axis=0)])
        rows, middle, apart = 0.0, np.zeros(width), np.zeros(width)
        for t in self.gathered(told):
            if t[0]:
                gap, both = t[1:1 + width] - middle, rows + t[0]
                apart = apart + t[1 + width:] + gap * gap * (rows * t[0] / both)
                middle, rows = middle + gap * (t[0] / both), both
        return middle, apart / max(rows, 1.0)


class RowRandom:
    """Uniform numbers that depend on the row, the unit and the step only, not on who asks."""

    def __init__(self, rows: np.ndarray, *seeds: int):
        self.rows, self.calls = rows.astype(np.uint64), 0
        self.seed = np.uint64(sum(s * k for s, k in zip(seeds, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) % 2 ** 64)

    def random(self, shape: tuple[int, int]) -> np.ndarray:
        self.calls += 1
        with np.errstate(over="ignore"):
            x = self.rows[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(shape[1], dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
            x = x + self.seed + np.uint64(self.calls) * np.uint64(0x2545F4914F6CDD1D)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            return (x ^ x >> np.uint64(31)).astype(np.float64) / 2.0 ** 64


def _cuts(batches: Iterator[pa.RecordBatch], widths: dict[str, int]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Rows of one step that came in one Arrow batch, with the step."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {n: _matrix(batch.column(i), n, widths.get(n)) for i, n in enumerate(batch.schema.names) if not n.startswith("_")}
        new["_row"] = batch.column("_row").to_numpy(zero_copy_only=False)
        step = batch.column("_step").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), len(step)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(step[a]), {n: v[a:b] for n, v in new.items()}


def _steps(cuts: Iterator[tuple[int, dict[str, np.ndarray]]], first: int, end: int) -> Iterator[dict[str, np.ndarray]]:
    """This task's part of every batch of steps ``first`` to ``end`` in turn; a batch without a row here gives empty arrays."""
    held: list[dict] = []
    empty: dict[str, np.ndarray] = {}
    at = first

    def joined() -> dict[str, np.ndarray]:
        if not held:
            return empty
        return held[0] if len(held) == 1 else {n: np.concatenate([h[n] for h in held]) for n in held[0]}

    for step, new in cuts:
        empty = empty or {n: v[:0] for n, v in new.items()}
        while at < step:
            yield joined()
            held, at = [], at + 1
        held.append(new)
    while at < end:
        yield joined()
        held, at = [], at + 1


def _local_step(spec: DenseSpec, state: tuple[dict, dict, dict], part: dict[str, np.ndarray], step: int, full: float, rate: Callable[[int], float],
                seed: int, seen: Callable) -> None:
    """One step of a task of its own; a part of fewer rows than ``full`` weighs as many as it has."""
    p, m, v = state
    x, y = {n: part[n] for n in spec.inputs}, {h.label: part[h.label] for h in spec.heads}
    _, grads, stats = net.backward(spec, p, x, y, RowRandom(part["_row"], seed, step, 1), None, seen)
    net.adam(p, {n: g * min(1.0, len(part["_row"]) / full) for n, g in grads.items()}, m, v, step, rate(step))
    p.update(stats)


def _round(spec: DenseSpec, start: tuple[dict, dict, dict], tasks: int, size: int, before: int, first: int, end: int, marks: Sequence[int],
           rate: Callable[[int], float], seed: int):
    """Steps ``first`` to ``end`` of an epoch that ``before`` steps came before, on one task's rows: their number, the task's parameters
    and moments, and counters by (mark, head)."""

    def run(cuts: Iterator[tuple[int, dict[str, np.ndarray]]]) -> Iterator[tuple]:
        p, m, v = ({n: a.copy() for n, a in d.items()} for d in start)
        counts: dict[tuple[int, int], np.ndarray] = {}
        since, mark = 0, 0

        def seen(h: Head, out: np.ndarray, y: np.ndarray, loss: float) -> None:
            key = (mark, spec.heads.index(h))
            counts[key] = counts.get(key, 0.0) + head_counts(head_kind(spec, h), out, y, loss)

        mine = ((step, part) for step, part in cuts if first <= step < end)
        for at, part in enumerate(_steps(mine, first, end), first):
            rows = len(part["_row"]) if part else 0
            if rows:
                mark, since = marks[at - first], since + rows
                _local_step(spec, (p, m, v), part, before + at + 1, size / tasks, rate, seed, seen)
        for c in counts.values():
            if not np.isfinite(c).all():
                raise ValueError(NOT_FINITE)
        yield since, (net.squared_spread(p), m, v), counts

    return run


def _epoch(spec: DenseSpec, shared, tasks: int, rows: int, size: int, first: int, rate: Callable[[int], float], seed: int, sync_every: int, log_every: int):
    names, labels = list(spec.inputs), list(dict.fromkeys(h.label for h in spec.heads))
    steps = -(-rows // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        across = Across(context, tasks)
        p, m, v = ({n: a.copy() for n, a in d.items()} for d in shared.value)
        tables = sorted(f"{y.name}/table" for y in spec.layers if y.kind == "embed")
        order, moved = sorted(p), sorted(n for n in p if net.trainable(n) and n not in tables)
        counts: dict[int, np.ndarray] = {}
        since = 0

        def seen(h: Head, out: np.ndarray, y: np.ndarray, loss: float) -> None:
            i = spec.heads.index(h)
            counts[i] = counts.get(i, 0.0) + head_counts(head_kind(spec, h), out, y, loss)

        def averaged() -> None:
            """Parameters and moments of all tasks, weighted by the rows since they last agreed."""
            parts = [d[n] * since for d in (net.squared_spread(p), m, v) for n in order]
            *total, weight = across.sums([*parts, np.array([float(since)])])
            found = [t / max(weight[0], 1.0) for t in total]
            k = len(order)
            p.update(net.spread(dict(zip(order, found[:k]))))
            m.update(zip(order, found[k:2 * k]))
            v.update(zip(order, found[2 * k:]))

        for at, part in enumerate(_steps(_cuts(batches, spec.inputs), 0, steps)):
            step = first + at + 1
            count = min(size, rows - at * size)
            mine = len(part["_row"]) if part else 0
            if not part:  # a task without a row in this epoch
                part = {n: np.empty((0, max(spec.inputs.get(n, 1), 1))) for n in dict.fromkeys([*names, *labels])} | {"_row": np.empty(0)}
            if sync_every == 1:
                random = RowRandom(part["_row"], seed, step, 1)
                x, y = {n: part[n] for n in names}, {n: part[n] for n in labels}
                across.rows = count
                _, grads, stats = net.backward(spec, p, x, y, random, across, seen)
                grads = {n: grads[n] * (count / size) if n in grads else np.zeros_like(p[n]) for n in [*moved, *tables]}
                total = dict(zip(moved, across.sums([grads[n] for n in moved])))
                total |= {n: across.table_sum(grads[n], -(-size // tasks)) for n in tables}  # a part has no more rows
                net.adam(p, total, m, v, step, rate(step))
                p.update(stats)
            elif mine:
                _local_step(spec, (p, m, v), part, step, size / tasks, rate, seed, seen)
            since += mine
            last = at + 1 == steps
            if sync_every > 1 and ((at + 1) % sync_every == 0 or last):
                averaged()
                since = 0
            if (at + 1) % log_every == 0 or last:
                for i, c in counts.items():
                    if not np.isfinite(c).all():
                        raise ValueError(NOT_FINITE)
                    yield from _emit(f"log:{at + 1}:{i}", c)
                counts.clear()
        if context.partitionId() == 0:
            for k, d in (("p", p), ("m", m), ("v", v)):
                for n, a in d.items():
                    yield from _emit(f"{k}:{n}", a)

    return run


# --- fit ----------------------------------------------------------------------------------------


def laid_out(df: DataFrame, columns: Sequence[str], key: str, batch_size: int, tasks: int, steps: int | None = None, ranges: int = 1) -> DataFrame:
    """Rows with ``_row`` (place in key order) and ``_step`` (batch of an epoch), place modulo ``tasks`` in each partition, in order.
    With ``steps``, so many steps of a task are a partition: those of the ``ranges`` ranges of steps come one after the other."""
    taken = df.select(F.col(key).alias("_key"), *_columns(df, columns))
    placed = with_running_totals(taken, "_key", {"_n": F.lit(1).cast("bigint")})
    numbered = placed.select(*columns, (F.col("_n") - 1).alias("_row"), F.expr(f"(_n - 1) div {int(batch_size)}").alias("_step"))
    place = F.pmod(F.col("_row"), F.lit(tasks))
    if steps is not None:
        place = place + F.expr(f"_step div {int(steps)}") * tasks
    return numbered.repartitionById(tasks * ranges, place.cast("int")).sortWithinPartitions("_row")


def _stored_cuts(laid: DataFrame, widths: dict[str, int]) -> RDD:
    """(step, arrays) of the rows of ``laid``, partition by partition, as ``_cuts`` gives them."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cut in _cuts(batches, widths):
            yield pa.RecordBatch.from_pydict({"cut": pa.array([pickle.dumps(cut, 5)], pa.binary())})

    return laid.mapInArrow(packed, "cut binary").rdd.map(lambda r: pickle.loads(r.cut))


def _epoch_of_rounds(cuts: RDD, state: TrainState, tasks: int, rows: int, size: int, first: int, rate: Callable[[int], float], seed: int,
                     sync_every: int, log_every: int, steps_held: int) -> dict[str, np.ndarray]:
    """An epoch as one job every ``sync_every`` steps, each on the partitions of its steps only. Gives what tasks emit in a barrier
    stage, added; parameters and moments of all tasks are averaged by rows in the order of the tasks."""
    spec, steps = state.model.spec, -(-rows // size)
    now, found = (state.model.params, state.m, state.v), {}
    for a in range(0, steps, sync_every):
        b = min(a + sync_every, steps)
        marks = [min(-(-(at + 1) // log_every) * log_every, steps) for at in range(a, b)]
        job = _round(spec, now, tasks, size, first, a, b, marks, rate, seed)
        at = a // steps_held * tasks
        told = cuts.context.runJob(cuts, job, list(range(at, at + tasks)))  # one a task, of bounded size
        weight = max(float(sum(t[0] for t in told)), 1.0)
        p, m, v = ({n: np.add.reduce([t[1][k][n] * t[0] for t in told]) / weight for n in d} for k, d in enumerate(now))
        now = (net.spread(p), m, v)
        for t in told:
            for (mark, i), c in t[2].items():
                found[f"log:{mark}:{i}"] = found.get(f"log:{mark}:{i}", 0.0) + c
    return found | {f"{k}:{n}": x for k, d in zip("pmv", now) for n, x in d.items()}


def fit_sync(df: DataFrame, spec: DenseSpec, key: str, batch_size: int = 32, epochs: int = 1, rate: float | Callable[[int], float] = 1e-3,
             validation: DataFrame | None = None, init: DenseModel | None = None, tasks: int | None = None, seed: int = 0, run: str = "fit",
             sync_every: int = 1, log_every: int | None = None, path: str | None = None) -> tuple[DenseModel, DataFrame]:
    """Fit; returns the model and the log table (run, epoch, step, metric, value).

    ``key`` is a unique numeric row id: batch i of an epoch holds the rows at i * batch_size and on in its order. ``tasks`` run at
    once (barrier): no more than the cluster's cores, by default all of them, and no more than rows in a batch. With ``sync_every`` 1 the result
    does not depend on them, up to the last bits. The last batch of an epoch may be smaller; its gradient weighs as many
    rows as it has. Every ``log_every`` steps, and after each epoch, the log has losses and metrics since the epoch began,
    and with ``validation`` those of that table (``val_``) after each epoch.

    With ``path`` the state is saved after every epoch; a fit whose ``path`` holds one goes on after its last epoch, as
    if it had never stopped. Null or NaN values raise; an empty table is an error.
    """
    spark = df.sparkSession
    if min(batch_size, sync_every) < 1:
        raise ValueError("batch_size and sync_every start at 1")
    columns = list(dict.fromkeys([*spec.inputs, *(h.label for h in spec.heads)]))
    tasks = min(tasks or spark.sparkContext.defaultParallelism, batch_size)
    state = TrainState.start(init or DenseModel(spec, net.initial(spec, seed)))
    if path is not None and versions(spark, path):
        state = load_state(spark, path)
        if state.model.spec != spec:
            raise ValueError(f"{path} holds a net of another shape")
    held = None  # steps of a partition, where some steps are a job
    if sync_every > 1 and 24 * sum(a.size for a in state.model.params.values()) <= ROUND_BYTES:
        held = sync_every * max(1, ROUND_ROWS * tasks // (sync_every * batch_size))
    if held is None:
        laid = laid_out(df, columns, key, batch_size, tasks).persist(StorageLevel.MEMORY_AND_DISK)
        rows = laid.count()
    else:
        rows = df.count()
        ranges = max(1, -(-rows // (batch_size * held)))
        laid = _stored_cuts(laid_out(df, columns, key, batch_size, tasks, held, ranges), spec.inputs).persist(StorageLevel.MEMORY_AND_DISK)
        laid.count()  # on all cores: a job of some steps would lay out its own rows only
    if not rows:
        laid.unpersist()
        raise ValueError("no rows to train on")
    if validation is not None:
        validation = validation.persist(StorageLevel.MEMORY_AND_DISK)
    steps, log = -(-rows // batch_size), []
    at = rate if callable(rate) else (lambda step, r=rate: r)
    try:
        for epoch in range(state.epoch, epochs):
            params = state.model.params
            if held is not None:
                found = _epoch_of_rounds(laid, state, tasks, rows, batch_size, epoch * steps, at, seed, sync_every, log_every or steps, held)
            else:
                shared = spark.sparkContext.broadcast((params, state.m, state.v))
                task = _epoch(spec, shared, tasks, rows, batch_size, epoch * steps, at, seed, sync_every, log_every or steps)
                found = _added(laid.mapInArrow(task, PART_SCHEMA, barrier=True))
                shared.unpersist()
            p, m, v = ({n: found[f"{k}:{n}"].reshape(a.shape) for n, a in params.items()} for k in "pmv")
            state = TrainState(DenseModel(spec, p), m, v, epoch + 1, (epoch + 1) * steps)
            total: dict[str, np.ndarray] = {}
            marks = sorted({int(n.split(":")[1]) for n in found if n.startswith("log:")})
            for mark in marks:
                for i in range(len(spec.heads)):
                    total[str(i)] = total.get(str(i), 0.0) + found.get(f"log:{mark}:{i}", 0.0)
                now = _named(spec, [total[str(i)] for i in range(len(spec.heads))]) | {"rows": float(total["0"][0])}
                log += [(run, epoch, epoch * steps + mark, n, float(x)) for n, x in now.items()]
            if validation is not None:
                log += [(run, epoch, state.step, f"val_{n}", x) for n, x in evaluate(validation, state.model).items()]
            if path is not None:
                save_state(spark, state, path)
    finally:
        laid.unpersist()
        if validation is not None:
            validation.unpersist()
    return state.model, spark.createDataFrame(log, LOG_SCHEMA)
