"""CSV and Parquet readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with inferred types. Inference reads the files once more: use a schema at scale."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headerless CSV with a fixed schema: one pass, and a bad field fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def wide_int_schema(dim: int, label: str = "label") -> T.StructType:
    names = [f"f-{i}" for i in range(dim)] + [label]
    return T.StructType([T.StructField(n, T.IntegerType(), False) for n in names])


def write_csv(df: DataFrame, path: str, header: bool = False, overwrite: bool = False) -> None:
    """Without ``overwrite`` an existing path is an error."""
    df.write.mode("overwrite" if overwrite else "error").option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """Load with the session's default format (Parquet)."""
    return spark.read.load(path)
