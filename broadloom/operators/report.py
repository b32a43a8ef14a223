"""Training log as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, every: int = 1) -> DataFrame:
    """Logged scalars, of every k-th step."""
    return spark.read.parquet(path).where(F.col("step") % every == 0)


def batch_log(df: DataFrame, run: str, epoch: int, step: str, values: dict[str, str]) -> DataFrame:
    """Mean of each value per batch as log rows; ``values`` maps metric name -> column."""
    per = df.groupBy(step).agg(*[F.avg(c).alias(n) for n, c in values.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in values])
    return per.select(F.lit(run).alias("run"), F.lit(epoch).alias("epoch"), F.col(step).cast("long").alias("step"),
                      F.explode(pairs).alias("_p")).select("run", "epoch", "step", "_p.metric", "_p.value")
