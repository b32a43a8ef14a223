"""Feature vectors: indexing, assembly, scaling, densifying, embedding lookup, concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadloom.session import materialize

# Rows up to which a lookup table is sent to every executor; larger ones are joined by shuffle.
BROADCAST_ROWS = 20000
BROADCAST_BYTES = 32 << 20


def string_index(df: DataFrame, columns: Sequence[str], outputs: Sequence[str],
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Index by falling frequency, ties by value. One frequency aggregate for all the columns.

    The categories go through the driver: for columns of very many values use ``string_index_join``."""
    indexer = StringIndexer(inputCols=list(columns), outputCols=list(outputs))
    return indexer.fit(df if fit_on is None else fit_on).transform(df)


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(value, index) by falling frequency, ties by value, for categories too many for the driver.

    Values are laid out in index order by a range shuffle on (frequency, value), which is unique, so no
    task holds more than its share however many values tie. The layout is stored before it is numbered:
    a second run of a range shuffle may cut elsewhere.
    """
    order = [F.col("n").desc(), F.col("value").asc()]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = materialize(counts.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "index")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_c"))  # one row per partition
    starts = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return placed.join(F.broadcast(starts), "_p").select("value", (rank + F.col("_start")).cast("double").alias("index"))


def string_index_join(df: DataFrame, column: str, out: str, fit_on: DataFrame | None = None) -> DataFrame:
    """``string_index`` by a join with ``frequency_index``: no list of categories on the driver. An unseen
    category gives null. The table is broadcast only if its checked size allows."""
    table = frequency_index(df if fit_on is None else fit_on, column)
    table = F.broadcast(table) if bounded(table) else table
    return df.join(table, F.col(column) == F.col("value"), "left").drop("value").withColumnRenamed("index", out)


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """``invalid``: error (null or NaN raises), skip (row dropped) or keep (null becomes NaN)."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid).transform(df)


def standard_scale(df: DataFrame, column: str = "features", out: str = "scaled_features",
                   fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample deviation; a constant feature becomes 0. Pass the training rows as
    ``fit_on`` to keep test rows out of the moments."""
    scaler = StandardScaler(inputCol=column, outputCol=out, withMean=True, withStd=True)
    return scaler.fit(df if fit_on is None else fit_on).transform(df)


def densify(column: str) -> Column:
    """Sparse or dense vector -> dense vector, inside the JVM."""
    return array_to_vector(vector_to_array(F.col(column)))


def pack(columns: Sequence[str]) -> Column:
    """Scalar columns -> one array<double>, so that later steps have one column whatever the width."""
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def concat_features(*parts: Column | str) -> Column:
    """Arrays and scalars -> one array<double>."""
    return F.concat(*parts)


def bounded(table: DataFrame, limit: int = BROADCAST_ROWS, vector: str | None = None, most: int = BROADCAST_BYTES) -> bool:
    """True if the table has at most ``limit`` rows and its ``vector`` column at most ``most`` bytes. Reads no more than
    limit + 1 rows."""
    size = F.coalesce(F.sum(F.size(vector) * 8 + 24), F.lit(0)) if vector else F.lit(0)
    found = table.limit(limit + 1).agg(F.count("*").alias("n"), size.alias("size")).first()
    return found.n <= limit and found.size <= most


def frequent_hashes(rows: DataFrame, keys: Sequence[str], share: int = 1000) -> list[int]:
    """Hashes of the keys that hold more than 1 / ``share`` of the rows, at most ``share`` of them, from one mergeable
    heavy-hitter sketch (16 * share counters, whatever the number of keys)."""
    sketch = F.expr(f"approx_top_k(_k, {int(share)}, {16 * int(share)})")
    found = rows.select(F.xxhash64(*keys).alias("_k")).agg(F.count("*").alias("n"), sketch.alias("top")).first()
    return [t["item"] for t in found.top or [] if t["count"] * share > found.n]


def split_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", share: int = 1000,
               null_safe: bool = False, small: bool | None = None) -> DataFrame:
    """Join with a table of at most one row a key, whatever its size and however rows crowd on single keys.

    A table of checked size (``small``: the caller has checked) is broadcast. Else the keys that hold more than 1 / ``share`` of
    the rows are found by a sketch: their table rows (at most ``share``) are broadcast, so that rows of a hot key stay where
    they are, and only the others are shuffled. What the sketch takes for frequent decides the path, never the result.
    ``rows`` is read twice: pass a stored table. ``null_safe`` lets null keys meet. Columns: those of ``rows``, then
    those of ``table`` but the keys.
    """
    names = [*rows.columns, *(c for c in table.columns if c not in keys)]

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        if not null_safe:
            return a.join(b, list(keys), how).select(names)
        b = b.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = [a[k].eqNullSafe(b[f"_key_{k}"]) for k in keys]
        return a.join(b, same, how).select(names)

    if bounded(table) if small is None else small:
        return join(rows, F.broadcast(table))
    hot = frequent_hashes(rows, keys, share)
    if not hot:
        return join(rows, table)
    often = F.xxhash64(*keys).isin(hot)
    return join(rows.where(often), F.broadcast(table.where(often))).unionByName(join(rows.where(~often), table.where(~often)))


def lookup(df: DataFrame, id_column: str, table: DataFrame, out: str, small: bool | None = None) -> DataFrame:
    """Embedding lookup: ``table`` has ``id`` and ``vector``; an id outside it gives null.

    A table of checked rows and bytes is broadcast, so a hot id costs nothing. Of a larger one only the vectors of frequent
    ids are broadcast (``split_join``), so that no task holds all rows of a hot id.
    """
    small = bounded(table, vector="vector") if small is None else small
    keyed = table.select(F.col("id").cast("int").alias("_id"), F.col("vector").alias(out))
    return split_join(df.withColumn("_id", F.col(id_column).cast("int")), keyed, ["_id"], small=small).drop("_id")
