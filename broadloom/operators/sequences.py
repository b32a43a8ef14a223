"""Fixed-length histories per entity, pooling, and per-step embeddings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadloom.functions.mixing import mix
from broadloom.operators.columns import floats
from broadloom.operators.features import bounded, lookup


def last_rows(df: DataFrame, key: str, order: Sequence[str], length: int, salts: int = 16) -> DataFrame:
    """The last ``length`` rows of each key; ``order`` must be unique within a key, and its last
    column an integer id.

    Two rounds: first within (key, salt), then within key. A key with a third of all rows is thus
    spread over ``salts`` tasks, and the second round sees at most salts x length rows of it. Spark
    also trims each map task's output to ``length`` rows per group before either shuffle.
    """
    newest = [F.col(c).desc() for c in order]
    spread = df.withColumn("_salt", mix(order[-1], seed=11) % F.lit(salts))
    for keys in ([key, "_salt"], [key]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        spread = spread.withColumn("_rank", rank).where(F.col("_rank") <= length).drop("_rank")
    return spread.drop("_salt")


def sequence_pad(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], length: int = 200,
                 pad: float = 0.0, salts: int = 16) -> DataFrame:
    """One row per key: for each value column an array of exactly ``length`` (oldest first, padded on
    the left), and ``n_steps``, the number of real steps."""
    step = F.struct(*[F.col(c) for c in order], *[F.col(v).cast("double").alias(f"_v_{v}") for v in values])
    kept = last_rows(df.select(key, *order, *[v for v in values if v not in order]), key, order, length, salts)
    grouped = kept.groupBy(key).agg(F.array_sort(F.collect_list(step)).alias("_steps"))  # <= length steps
    n = F.size("_steps")
    fill = F.array_repeat(F.lit(float(pad)), F.lit(length) - n)
    return grouped.select(
        key, n.alias("n_steps"),
        *[F.concat(fill, F.col(f"_steps._v_{v}")).alias(v) for v in values])


def max_pool(a: Column | str) -> Column:
    return F.array_max(a)


def average_pool(a: Column | str, n_steps: Column | str | None = None) -> Column:
    """Mean over all positions, padding included; with ``n_steps`` over the real steps only."""
    a = F.col(a) if isinstance(a, str) else a
    total = F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    if n_steps is None:
        return total / F.size(a)
    n = F.col(n_steps) if isinstance(n_steps, str) else n_steps
    return F.when(n > 0, F.try_divide(total, n)).otherwise(F.lit(0.0))


def sequence_pool(df: DataFrame, columns: Sequence[str], keep: Sequence[str], out: str = "pooled",
                  n_steps: str | None = None) -> DataFrame:
    """Max and average of every sequence, concatenated: all maxima first. Masked if ``n_steps`` is given:
    padding on the left is then left out of both."""
    def real(c: str) -> Column:
        return F.col(c) if n_steps is None else F.slice(
            F.col(c), F.size(c) - F.col(n_steps) + 1, F.greatest(F.col(n_steps), F.lit(1)))

    parts = [max_pool(real(c)) for c in columns] + [average_pool(c, n_steps) for c in columns]
    return df.select(*keep, F.array(*parts).alias(out))


def packed_vectors(table: DataFrame) -> DataFrame:
    """An embedding table with its vectors as bytes (doubles, little-endian): joined and sent as one piece, not number by number."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if pa.compute.any(pa.compute.is_null(batch.column(1).flatten())).as_py():
                raise ValueError("a vector of an embedding table holds a null")
            found = [None if v is None else np.array(v, "<f8").tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "vector"])

    return table.select(F.col("id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector")).mapInArrow(packed, "id long, vector binary")


def sequence_embed(df: DataFrame, key: str, categorical: dict[str, DataFrame], numeric: Sequence[str], packed: bool = False) -> DataFrame:
    """One row per (key, step) with ``step_vector``: the embeddings of the categorical sequences, then
    the numeric values. ``categorical`` maps a sequence column to its embedding table (id, vector). ``packed``, for wide
    vectors: a struct of the embeddings as bytes and the numeric values, which ``pool_steps`` takes as well.

    Steps are exploded once; every table is looked up on them. Step rows are not regrouped: pooling
    over them is an aggregate (``pool_steps``).
    """
    columns = [*categorical, *numeric]
    steps = df.select(key, F.posexplode(F.arrays_zip(*columns)).alias("step", "_s"))
    steps = steps.select(key, "step", *[F.col(f"_s.{c}").alias(c) for c in columns])
    for c, table in categorical.items():
        steps = lookup(steps, c, packed_vectors(table) if packed else table, f"_e_{c}", bounded(table, vector="vector"))
    parts, numbers = [F.col(f"_e_{c}") for c in categorical], F.array(*[F.col(c) for c in numeric]).cast("array<double>")
    whole = F.struct(F.concat(*parts).alias("bytes"), numbers.alias("numbers")) if packed else F.concat(*parts, numbers)
    return steps.select(key, "step", whole.alias("step_vector"))


def _step_matrices(vectors: pa.Array, width: int) -> list[np.ndarray]:
    """Step vectors of one length as matrices that stand side by side: packed ones are bytes, where Arrow holds them, and numbers."""
    if not pa.types.is_struct(vectors.type):
        return [floats(vectors, width, "step vector")]
    packed, numbers = vectors.flatten()
    packed = packed.cast(pa.binary())
    at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
    x = np.frombuffer(packed.buffers()[2], np.uint8)[at[0]:at[-1]].view("<f8").reshape(len(packed), -1)
    return [x, floats(numbers, width - x.shape[1], "step vector")]


def _step_lengths(vectors: pa.Array) -> np.ndarray:
    """Length of every step vector; a null vector or element is an error."""
    parts = vectors.flatten() if pa.types.is_struct(vectors.type) else [vectors]
    if any(p.null_count for p in parts) or parts[-1].flatten().null_count:
        raise ValueError("a step vector is null or holds a null")
    lengths = pa.compute.list_value_length(parts[-1]).to_numpy()
    return lengths + pa.compute.binary_length(parts[0]).to_numpy() // 8 if len(parts) == 2 else lengths


def _reduced(pool: np.ufunc, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``pool`` over each run of rows. Runs of many numbers one by one: several numbers are pooled at once then."""
    if x.size < 4096 * len(starts):
        return pool.reduceat(x, starts)
    return np.stack([pool.reduce(x[a:b], axis=0) for a, b in zip(starts, [*starts[1:], len(x)])])


def _pooled_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, most, mean, n) of every run of rows of one key in a batch; arrays of another length are another run."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, vectors = batch.column(0), batch.column(1)
        lengths = _step_lengths(vectors)
        codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (lengths[1:] != lengths[:-1])]))
        counts = np.diff(np.append(first, len(codes)))
        for width in np.unique(lengths):
            runs = np.flatnonzero(lengths[first] == width)
            parts = _step_matrices(vectors.filter(pa.array(lengths == width)) if len(runs) < len(first) else vectors, int(width))
            starts = np.concatenate([[0], np.cumsum(counts[runs])[:-1]])
            offsets = pa.array(np.arange(len(runs) + 1, dtype=np.int32) * int(width))
            most, total = (np.concatenate([_reduced(pool, x, starts) for x in parts], axis=1) for pool in (np.fmax, np.add))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(first[runs])), *(pa.ListArray.from_arrays(offsets, pa.array(v.ravel())) for v in (most, total / counts[runs, None])),
                 pa.array(counts[runs].astype(np.int64))], names=["_key", "most", "mean", "n"])


def pool_steps(steps: DataFrame, key: str, vector: str = "step_vector", out: str = "pooled") -> DataFrame:
    """Elementwise maximum and mean over the steps of a key, concatenated. Steps that follow each other are pooled as matrices
    where they lie, what they give by a partial aggregate: steps of one key are never gathered."""
    conf = steps.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default: batches of wide vectors lie outside the heap
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    given = F.col(vector)
    if not isinstance(steps.schema[vector].dataType, T.StructType):  # packed ones are
        given = given.cast("array<double>")
    runs = steps.select(F.col(key).alias("_key"), given.alias("_v"))
    kind = runs.schema["_key"].dataType.simpleString()
    runs = runs.mapInArrow(_pooled_runs, f"_key {kind}, most array<double>, mean array<double>, n long")
    most = Summarizer.metrics("max").summary(array_to_vector("most"))
    mean = Summarizer.metrics("mean").summary(array_to_vector("mean"), F.col("n").cast("double"))
    pooled = runs.groupBy("_key").agg(most.alias("_m"), mean.alias("_a"))
    return pooled.select(F.col("_key").alias(key), F.concat(vector_to_array("_m.max"), vector_to_array("_a.mean")).alias(out))
