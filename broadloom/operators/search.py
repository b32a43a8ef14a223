"""Hyper-parameter search: trials, runs and the best of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.functions.mixing import mix


@dataclass(frozen=True)
class Grid:
    """Every value is tried."""

    values: Sequence


@dataclass(frozen=True)
class Choice:
    """One value is drawn per trial."""

    values: Sequence


def expand_trials(spark: SparkSession, space: dict[str, Grid | Choice], n_sampling: int = 1,
                  seed: int = 0) -> DataFrame:
    """One row per trial: the full grid, repeated ``n_sampling`` times, with drawn choices.

    ``trial`` counts samples first, then grid values in the order given; draws depend on (trial, seed).
    """
    trials = spark.range(n_sampling).select(F.col("id").alias("trial"))
    for name, p in space.items():
        if isinstance(p, Grid):
            trials = trials.select("*", F.posexplode(F.array(*[F.lit(v) for v in p.values])).alias("_at", name))
            trials = trials.withColumn("trial", F.col("trial") * len(p.values) + F.col("_at")).drop("_at")
    for i, (name, p) in enumerate(space.items()):
        if isinstance(p, Choice):
            at = (mix("trial", seed=seed + i) % F.lit(len(p.values))).cast("int")
            trials = trials.withColumn(name, F.get(F.array(*[F.lit(v) for v in p.values]), at))
    return trials.select("trial", *space)


def run_trials(train: DataFrame, valid: DataFrame, trials: DataFrame,
               fit: Callable[[DataFrame, dict], object],
               evaluate: Callable[[DataFrame, object], DataFrame], metric: str = "error",
               parallel: int = 2) -> tuple[DataFrame, dict[int, object]]:
    """Fit and judge every trial; the results table holds trial, parameters and metric.

    Each fit is itself a distributed job over the cached tables; ``parallel`` of them run at a time.
    """
    spark = train.sparkSession
    train, valid = train.persist(), valid.persist()
    space = [r.asDict() for r in trials.orderBy("trial").collect()]

    def one(p: dict):
        model = fit(train, p)
        return p["trial"], model, float(evaluate(valid, model).first()[metric])

    try:
        with ThreadPoolExecutor(parallel) as pool:
            done = list(pool.map(one, space))
    finally:
        train.unpersist()
        valid.unpersist()
    scores = spark.createDataFrame([(t, s) for t, _, s in done], f"trial long, {metric} double")
    return trials.join(scores, "trial"), {t: m for t, m, _ in done}


def best_trial(results: DataFrame, metric: str, mode: str = "min") -> DataFrame:
    """Best row; equal metrics go to the lower trial number."""
    order = F.col(metric).asc_nulls_last() if mode == "min" else F.col(metric).desc_nulls_last()
    return results.orderBy(order, "trial").limit(1)
