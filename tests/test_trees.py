"""Registered fits of Spark ML trees have all their rounds and levels."""

import pytest
from pyspark.sql import functions as F

from broadloom.operators import trees
from broadloom.plans.queries import QUERIES


@pytest.fixture
def folder(spark, tmp_path):
    """Few lines that one column tells apart, so that a tree is one level and rounds are short."""
    i = F.col("id")
    spark.range(0, 80, 1, 2).select(
        i.alias("l_orderkey"), (i % 7).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i % 3).cast("int").alias("l_linenumber"),
        (i % 2).cast("double").alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.when(i % 2 == 0, "R").otherwise("N").alias("l_returnflag")).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.fixture
def fitted(monkeypatch):
    models, fit = [], trees.fit_gbt
    monkeypatch.setattr(trees, "fit_gbt", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    return models


def test_gbt_classify_fits_every_round(spark, folder, fitted):
    rows = QUERIES["gbt_classify"](spark, folder).collect()
    assert [(m.getNumTrees, m.getMaxDepth(), m.getStepSize()) for m in fitted] == [(200, 6, 0.1)]
    assert rows and all(r.label == r.prediction for r in rows)


def test_gbt_importance_fits_every_round(spark, folder, fitted):
    rows = QUERIES["gbt_importance"](spark, folder).collect()
    assert [(m.getNumTrees, m.getMaxDepth(), m.getStepSize()) for m in fitted] == [(200, 6, 0.1)]
    assert sorted(tuple(r) for r in rows) == [(0, 1.0), (1, 0.0), (2, 0.0), (3, 0.0)]
