"""Projection, cleaning, layout, splits, global positions and batch plans."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadloom.functions.mixing import mix

SPLIT_SCALE = 1000000
#: Rows of a table that a task should hold at most where many passes follow.
SPREAD_ROWS = 250000


def positional(df: DataFrame, start: int, stop: int) -> list[str]:
    """Names of a positional slice of columns; negative positions count from the end."""
    return df.columns[start:stop]


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin into ``partitions``. Without a number, a table is moved that has fewer partitions than the cluster has cores,
    or than it has times SPREAD_ROWS rows, so that tasks do not grow with it: worth one shuffle where many passes follow. Use it
    on a table as read, whose rows are counted from file footers: after a shuffle Spark sizes partitions itself, and would have
    to run it to tell their number."""
    if partitions is None:
        partitions = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / SPREAD_ROWS))
        if df.rdd.getNumPartitions() >= partitions:
            return df
    return df.repartition(partitions)


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def preview(df: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """First k rows in key order; runs as a distributed top-k, never as collect()[:k]."""
    return df.orderBy(*keys).limit(k)


def with_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 24,
               out: str = "split") -> DataFrame:
    """Number of the piece each row falls in. Depends on the key only, never on partitioning."""
    total, cuts, run = sum(weights), [], 0.0
    for w in weights[:-1]:
        run += w
        cuts.append(round(run / total * SPLIT_SCALE))
    h = mix(*keys, seed=seed) % F.lit(SPLIT_SCALE)
    piece = F.lit(0)
    for c in cuts:
        piece = piece + (h >= F.lit(c)).cast("int")
    return df.withColumn(out, piece)


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 24) -> list[DataFrame]:
    """Disjoint pieces whose union is the input; each is a narrow filter."""
    marked = with_split(df, keys, weights, seed, "_piece")
    return [marked.where(F.col("_piece") == i).drop("_piece") for i in range(len(weights))]


def with_running_totals(df: DataFrame, order: str, values: dict[str, Column], buckets: int = 1024,
                        finer: DataFrame | None = None) -> DataFrame:
    """Running totals over the whole table in ``order``, without a one-task window.

    ``order`` must be numeric and unique per row; rows without it come last, in no fixed order among themselves. Approximate quantiles cut it into ranges; range
    totals (at most ``buckets`` rows) give each range its offset; inside a range an ordinary window
    finishes the sum. The cuts only balance the work: the totals are exact for any cuts. Adds ``<name>``
    (total up to and including the row) and ``<name>_all`` (grand total) per value.

    Cuts and range totals are read from ``finer`` if given: a table with the same columns, of which
    ``df`` is a sum by ``order``. That spares two evaluations of the aggregate. Otherwise ``df`` is read
    three times: pass a stored table rather than an expensive plan.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    source = df if finer is None else finer
    found = source.approxQuantile(order, probabilities, 1 / (4 * buckets))
    edges = sorted({e for e in found if math.isfinite(e)}) or [0.0]
    splits = [float("-inf"), *edges, float("inf")]

    def ranged(table: DataFrame) -> DataFrame:
        table = table.select("*", *[v.alias(f"_v_{n}") for n, v in values.items()],
                             F.col(order).cast("double").alias("_o"))
        placed = Bucketizer(splits=splits, inputCol="_o", outputCol="_r", handleInvalid="keep").transform(table).drop("_o")
        return placed.withColumn("_r", F.coalesce("_r", F.lit(float(len(splits)))))  # null: behind all ranges

    totals = ranged(source).groupBy("_r").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        F.col("_r"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in values],
        *[F.sum(f"_t_{n}").over(everything).alias(f"{n}_all") for n in values],
    )
    inside = Window.partitionBy("_r").orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged(df).join(F.broadcast(offsets), "_r", "left")  # at most `buckets` rows
    return joined.select(
        *df.columns,
        *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_b_{n}")).alias(n) for n in values],
        *[F.col(f"{n}_all") for n in values],
    )


def batch_plan(df: DataFrame, key: str, batch_size: int, buckets: int = 1024) -> DataFrame:
    """``row_index`` and ``batch`` in order of a unique numeric key, null keys last; rows of a partial last batch go.

    The step count is rows // batch_size, so a table smaller than one batch keeps no row.
    """
    placed = with_running_totals(df, key, {"_n": F.lit(1).cast("bigint")}, buckets)
    index = F.col("_n") - 1
    full = F.expr(f"_n_all div {int(batch_size)}")
    batch = F.expr(f"(_n - 1) div {int(batch_size)}")
    return placed.where(batch < full).select(*df.columns, index.alias("row_index"), batch.alias("batch"))


def steps_per_epoch(rows: int, batch_size: int) -> int:
    steps = rows // batch_size
    if steps == 0:
        raise ValueError(f"{rows} rows are fewer than one batch of {batch_size}")
    return steps
