"""Weighted quantile summaries: exact on few values, within their bound on many."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadloom.operators import boosting, quantiles


def plain_cuts(values, weights, parts):
    """Smallest value whose running weight reaches each part."""
    pairs = sorted((v, w) for v, w in zip(values, weights) if v is not None and not math.isnan(v) and w)
    total, out = sum(w for _, w in pairs), []
    for i in range(1, parts):
        run = 0.0
        for v, w in pairs:
            run += w
            if run >= i * total / parts * (1 - 1e-9):
                out.append(v)
                break
    return sorted({v for v in out if v > pairs[0][0]}) if pairs else []


def test_few_values_are_exact_with_gaps_and_weights(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(r.integers(0, 40)), None if i % 3 else float(r.integers(0, 5)), float("nan") if i % 2 else float(i % 7), None], float(r.integers(0, 4)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x array<double>, w double").repartition(7)
    found = quantiles.weighted_edges(df, "x", F.col("w"), 12)
    assert found == [plain_cuts([x[f] for _, x, _ in rows], [w for *_, w in rows], 12) for f in range(4)]
    assert found[3] == []
    assert quantiles.weighted_edges(df, "x", None, 12)[0] == plain_cuts([x[0] for _, x, _ in rows], [1.0] * 3000, 12)


def test_rank_error_stays_within_the_bound(spark, monkeypatch):
    points, n = 256, 60_000
    df = spark.range(0, n, 1, 8).select(F.array(F.sin("id") * 1000 + F.rand(1), F.exp(F.randn(2) * 3)).alias("x"), (F.rand(3) + F.col("id") % 5).alias("w")).cache()
    found = quantiles.weighted_edges(df, "x", F.col("w"), 64, points)
    rows = df.collect()
    w = np.array([r.w for r in rows])
    # levels of blocks in a task, then of the tasks, and one last merge of each
    levels = 2 + math.ceil(math.log(n / 8 / quantiles.BLOCK_ROWS + 1, quantiles.FAN)) + 2 + math.ceil(math.log(8, quantiles.FAN))
    for f, edges in enumerate(found):
        x = np.array([r.x[f] for r in rows])
        assert len(edges) == 63
        for i, e in enumerate(edges, 1):
            assert abs(w[x <= e].sum() / w.sum() - i / 64) <= levels / (2 * points) + 1 / points, (f, i)


def test_merging_in_any_order_keeps_the_total():
    r = np.random.default_rng(2)
    held = quantiles.Summaries(64)
    values, weights = r.normal(size=50_000), r.random(50_000)
    for a in range(0, 50_000, 500):
        held.add(values[a:a + 500], weights[a:a + 500])
    v, w = held.merged()
    assert len(v) <= 64 and w.sum() == pytest.approx(weights.sum())
    assert sum(len(level) for level in held.levels) <= quantiles.FAN * len(held.levels)


def test_wide_tables_need_no_setting_and_bad_rows_are_refused(spark):
    wide = spark.range(0, 600, 1, 4).select(F.transform(F.sequence(F.lit(0), F.lit(845)), lambda j: ((F.col("id") * 31 + j) % 101).cast("double")).alias("x"))
    found = quantiles.weighted_edges(wide, "x", None, 32)
    assert len(found) == 846 and all(0 < len(e) <= 31 for e in found)
    assert quantiles.weighted_edges(wide.limit(0), "x") == []
    with pytest.raises(Exception, match="negative weight"):
        quantiles.weighted_edges(wide, "x", F.lit(-1.0))
    uneven = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "x array<double>").coalesce(1)
    with pytest.raises(Exception, match="array of|arrays of"):
        quantiles.weighted_edges(uneven, "x")


def test_a_fit_takes_its_edges_from_the_hessian(spark):
    rows = [([float(i % 90)], int(i % 90 > 60)) for i in range(2000)]
    df = spark.createDataFrame(rows, "x array<double>, y int")
    model = boosting.fit_hist_boost(df, "x", "y", num_round=1, max_depth=1, min_child_weight=1.0, max_bins=200)
    assert model.rows[0][2:5] == (0, 60, 61.0)
