"""Boosting over column-compressed blocks against the dense fit of the same table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadloom.operators import boosting, sparseboost
from broadloom.sources import generate

OPTIONS = {"num_round": 3, "max_depth": 3, "min_child_weight": 2.0, "gamma": 0.0, "eta": 0.4}


def close(a, b):
    assert len(a) == len(b) and a
    for x, y in zip(a, b):
        assert x[:4] == y[:4] and x[5] == y[5]
        for i in (4, 6, 7, 8):
            assert (x[i] is None) == (y[i] is None) and (x[i] is None or x[i] == pytest.approx(y[i], rel=1e-6, abs=1e-9))


@pytest.fixture(scope="module")
def table(spark):
    """Zeros, negative values, gaps, a column of zeros only and one without zeros; the label follows three of them."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 6)) * (rng.random((2500, 6)) < 0.3)
    x[:, 3], x[:, 4] = 0.0, rng.random(2500) + 1.0
    y = ((x[:, 0] > 0.2) | (x[:, 1] < -0.4) | (x[:, 4] > 1.8)).astype(int)
    x[rng.random((2500, 6)) < 0.05] = np.nan
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x array<double>, y int").cache()


@pytest.mark.parametrize("subtract", [True, False])
def test_same_trees_as_dense(table, subtract):
    dense = boosting.fit_hist_boost(table, "x", "y", max_bins=16, **OPTIONS)
    close(dense.rows, sparseboost.fit_sparse_boost(table, "x", "y", max_bins=16, subtract=subtract, **OPTIONS).rows)


def test_layout_and_refresh_change_nothing(table, monkeypatch):
    edges = [[-0.5, 0.0, 0.5]] * 4 + [[1.25, 1.5, 1.8], [0.1]]
    one = sparseboost.fit_sparse_boost(table, "x", "y", edges=edges, **OPTIONS)
    monkeypatch.setattr(sparseboost, "BLOCK_ROWS", 100)
    close(one.rows, sparseboost.fit_sparse_boost(table, "x", "y", edges=edges, refresh=1, partitions=5, **OPTIONS).rows)
    target = table.withColumn("t", F.col("y") * 3.0 + F.coalesce(F.get("x", F.lit(4)), F.lit(0.0)))
    close(boosting.fit_hist_boost(target, "x", "t", "reg:squarederror", edges=edges, **OPTIONS).rows,
          sparseboost.fit_sparse_boost(target, "x", "t", "reg:squarederror", edges=edges, **OPTIONS).rows)


def test_stored_cells_are_those_outside_the_zero_bin(spark):
    rows = generate.gen_block_sparse(spark.range(3000), 40, 19, seed=4)
    edges = [[0.25, 0.5, 0.75]] * 40
    blocks = sparseboost.to_blocks(rows, "f", F.col("output").cast("double").alias("label"), F.lit(1.0).alias("weight"), edges).collect()
    stored = sum(len(b["bins"]) for b in blocks)
    assert stored == rows.select(F.explode("f").alias("v")).where("v >= 0.25").count()
    assert sum(len(b["label"]) for b in blocks) == 3000 * 8
    assert all(len(b["rows"]) == 2 * len(b["bins"]) for b in blocks)


def test_odd_rows(spark):
    rows = spark.range(60).select(F.array(F.col("id") % 3 * 1.0, F.lit(0.0)).alias("x"), (F.col("id") % 2).alias("y"), "id")
    options = {"edges": [[1.0, 2.0], []], "num_round": 1, "max_depth": 1, "min_child_weight": 1.0}
    with pytest.raises(ValueError, match="null or NaN labels"):
        sparseboost.fit_sparse_boost(rows.withColumn("y", F.when(F.col("id") != 3, F.col("y"))), "x", "y", **options)
    with pytest.raises(Exception, match="array of 2 values"):
        sparseboost.fit_sparse_boost(rows.withColumn("x", F.when(F.col("id") != 3, F.col("x"))), "x", "y", **options)
    assert sparseboost.fit_sparse_boost(rows.limit(0), "x", "y", **options).rows == []
    assert sparseboost.fit_sparse_boost(rows, "x", "y", edges=[[], []], num_round=1).rows == []
