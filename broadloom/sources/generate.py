"""Deterministic synthetic tables over a DataFrame of row ids.

Each generator takes ``ids``, any DataFrame with an integer column ``id`` (``spark.range(n)``, or keys
of an existing table), so rows are made in parallel where the ids live, without a shuffle. A cell
depends only on (id, column number, seed); recomputing a partition gives the same rows. The arrays of cells are made
as matrices inside Arrow batches: Spark's ``transform`` would interpret the arithmetic cell by cell.

Features stay in one array column, whatever the width. ``widen`` splits an array into scalar columns
for CSV output or for name-based access.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from broadloom.functions.mixing import CELL_STEP, PRIME, cell, mix, mix_int, uniform

SEQUENCE_COLUMNS = [  # fixed values: column names of the sequence table
    "scaled_trx_amt_v", "scaled_trx_diff_v", "trx_time_hours_v", "txn_month_v", "txn_weekday_v",
    "product_code_v", "cardholder_txn_type_v", "city_name_v", "merchant_name_v", "mcc_code_v",
    "merchant_location_id_v",
]


#: Cells of all arrays in an Arrow batch that a task sends.
BATCH_CELLS = 1 << 19


def _with_cells(based: DataFrame, arrays: dict[str, tuple[int, int]], integers: bool = False, zero: list[bool] | None = None) -> DataFrame:
    """Append array columns: ``arrays`` maps name -> (first column number, length). Cells are ``uniform``, or integers 0..100.
    ``zero`` marks places that are 0.0 in rows with ``_on``."""
    width = max(1, sum(n for _, n in arrays.values()))
    item = pa.int32() if integers else pa.float64()
    steps = {c: (np.arange(first, first + n, dtype=np.uint64) * np.uint64(CELL_STEP)) % np.uint64(PRIME) for c, (first, n) in arrays.items()}
    drawn = None if zero is None else np.array(zero, bool)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prime, modulus = np.uint64(PRIME), np.uint64(101 if integers else 1000000)
        rows = max(1, BATCH_CELLS // width)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                base = part.column("_b").to_numpy(zero_copy_only=False).astype(np.uint64)
                made = []
                for step in steps.values():
                    t = (base[:, None] + step) % prime
                    value = t * t % prime % modulus
                    value = value.astype(np.int32) if integers else value / 1e6
                    if drawn is not None:
                        value[part.column("_on").to_numpy(zero_copy_only=False).astype(bool)[:, None] & drawn] = 0.0
                    offsets = np.arange(len(base) + 1, dtype=np.int32) * len(step)
                    made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.ravel(), item)))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *steps])

    cells = ArrayType(IntegerType() if integers else DoubleType())
    return based.mapInArrow(run, StructType([*based.schema.fields, *[StructField(c, cells) for c in arrays]]))


def _one(j: int, modulus: int) -> Column:
    return (cell(F.col("_b"), j) % F.lit(modulus)).cast("int")


def _based(ids: DataFrame, seed: int) -> DataFrame:
    return ids.select(F.col("id").cast("bigint").alias("id"), mix("id", seed=seed).alias("_b"))


def widen(df: DataFrame, arrays: dict[str, tuple[str, int]], keep: list[str]) -> DataFrame:
    """Split array columns into scalars: ``arrays`` maps column -> (name prefix, length)."""
    scalars = [
        F.get(F.col(c), F.lit(i)).alias(f"{prefix}-{i}")
        for c, (prefix, n) in arrays.items()
        for i in range(n)
    ]
    return df.select(*keep[:1], *scalars, *keep[1:])


def gen_classification(ids: DataFrame, dim: int, seed: int = 0, integers: bool = False) -> DataFrame:
    """``f`` and ``d`` arrays (uniform [0,1), or integers 0..100), ``output`` 0/1, two ids 0..4."""
    return _with_cells(_based(ids, seed), {"f": (0, dim), "d": (dim, dim)}, integers).select(
        "id",
        "f",
        "d",
        _one(2 * dim, 2).alias("output"),
        _one(2 * dim + 1, 5).alias("input_1"),
        _one(2 * dim + 2, 5).alias("input_2"),
    )


def gen_multitask_int(ids: DataFrame, dim: int, seed: int = 0) -> DataFrame:
    return gen_classification(ids, dim, seed, integers=True)


def gen_dense_int(ids: DataFrame, dim: int, seed: int = 0) -> DataFrame:
    """``f``: integers 0..100; ``label`` 0/1."""
    return _with_cells(_based(ids, seed), {"f": (0, dim)}, integers=True).select("id", "f", _one(dim, 2).alias("label"))


def sparse_columns(dim: int, count: int, seed: int = 0) -> list[int]:
    """``count`` of ``dim`` column numbers, drawn without replacement."""
    return sorted(sorted(range(dim), key=lambda j: mix_int(j, seed + 1))[:count])


def gen_block_sparse(ids: DataFrame, dim: int, sparse: int, seed: int = 0) -> DataFrame:
    """Uniform features; the drawn columns are 0.0 in every row whose id is not a multiple of 3."""
    drawn = set(sparse_columns(dim, sparse, seed))
    based = _based(ids, seed).withColumn("_on", F.coalesce(F.pmod("id", F.lit(3)) != 0, F.lit(False)))
    return _with_cells(based, {"f": (0, dim)}, zero=[j in drawn for j in range(dim)]).select("id", "f", _one(dim, 2).alias("output"))


def gen_regression(ids: DataFrame, dim: int, seed: int = 0) -> DataFrame:
    """Uniform features, ``output`` uniform in [100, 200), two ids 0..4."""
    return _with_cells(_based(ids, seed), {"f": (0, dim)}).select(
        "id",
        "f",
        (F.lit(100.0) + uniform(cell(F.col("_b"), dim)) * F.lit(100.0)).alias("output"),
        _one(dim + 1, 5).alias("input_1"),
        _one(dim + 2, 5).alias("input_2"),
    )


def gen_sequence_flat(ids: DataFrame, steps: int = 128, seed: int = 0) -> DataFrame:
    return _with_cells(_based(ids, seed), {"f": (0, steps)}).select("id", "f", uniform(cell(F.col("_b"), steps)).alias("output"))


def gen_sequence_vectors(ids: DataFrame, steps: int = 200, seed: int = 0) -> DataFrame:
    """One array of length ``steps`` per sequence column and a 0/1 ``label_per_client``."""
    return _with_cells(_based(ids, seed), {c: (i * steps, steps) for i, c in enumerate(SEQUENCE_COLUMNS)}).select(
        "id",
        *SEQUENCE_COLUMNS,
        _one(len(SEQUENCE_COLUMNS) * steps, 2).cast("double").alias("label_per_client"),
    )
