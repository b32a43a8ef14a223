import random

import pytest
from pyspark.sql import functions as F

from broadloom.operators import boosting

OPTIONS = {"num_round": 3, "max_depth": 3, "min_child_weight": 2.0, "gamma": 0.0, "eta": 0.4}


@pytest.fixture(scope="module")
def table(spark):
    """Label from two features, one of them with gaps; a constant; one value holds a third of all rows."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        a = 0.5 if rng.random() < 0.35 else rng.random()
        b = None if rng.random() < 0.2 else rng.random()
        y = int((a > 0.6) != (b is None or b > 0.7)) if rng.random() < 0.9 else rng.randrange(2)
        rows.append((i, [a, b, 1.0], y))
    return spark.createDataFrame(rows, "id long, x array<double>, y int").cache()


def brute_split(rows, lam, gamma, least):
    """rows: (feature, bin or None, g, h) of one node."""
    best = None
    for f in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == f]
        g, h = sum(r[2] for r in mine), sum(r[3] for r in mine)
        for b in sorted({r[1] for r in mine if r[1] is not None}):
            for miss in (False, True):
                left = [r for r in mine if (miss if r[1] is None else r[1] <= b)]
                gl, hl = sum(r[2] for r in left), sum(r[3] for r in left)
                if min(hl, h - hl) < least or min(hl, h - hl) <= 0:
                    continue
                gain = 0.5 * (gl ** 2 / (hl + lam) + (g - gl) ** 2 / (h - hl + lam) - g ** 2 / (h + lam)) - gamma
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, b, miss)
    return best


def test_best_split_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(n, f, None if b == 6 else b, rng.uniform(-5, 5), rng.uniform(0.1, 4))
            for n in range(6) for f in range(3) for b in range(7)]
    df = spark.createDataFrame(rows, "node int, feature int, bin int, g double, h double")
    got = {r.node: (r.gain, r.feature, r.bin, r.missing_left) for r in boosting.best_split(df, 1.0, 0.1, 3.0).collect()}
    for n in range(6):
        want = brute_split([r[1:] for r in rows if r[0] == n], 1.0, 0.1, 3.0)
        if want is None:
            assert n not in got
        else:
            assert got[n][1:] == want[1:] and got[n][0] == pytest.approx(want[0])


def test_equal_gains_go_to_the_lower_feature(spark):
    rows = [(1, f, b, (-3.0 if b == 0 else 3.0), 2.0) for f in (4, 2, 3) for b in (0, 1)]
    df = spark.createDataFrame(rows, "node int, feature int, bin int, g double, h double")
    assert boosting.best_split(df).first().feature == 2


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:4] == y[:4] and x[5] == y[5]
        for i in (4, 6, 7, 8):
            assert (x[i] is None) == (y[i] is None) and (x[i] is None or x[i] == pytest.approx(y[i], rel=1e-6))


def test_fit_learns_and_ignores_layout_and_refresh(spark, table):
    edges = [[i / 20 for i in range(1, 20)]] * 2 + [[]]
    one = boosting.fit_hist_boost(table, "x", "y", edges=edges, **OPTIONS)
    close(one.rows, boosting.fit_hist_boost(table.repartition(11), "x", "y", edges=edges, **OPTIONS).rows)
    close(one.rows, boosting.fit_hist_boost(table.coalesce(1), "x", "y", edges=edges, refresh=1, **OPTIONS).rows)
    scored = boosting.score_hist_boost(table, one, "x")
    assert scored.where(F.col("prediction") != F.col("y")).count() / 1500 < 0.12
    assert {r[2] for r in one.rows if r[2] is not None} == {0, 1}


def test_levels_in_several_jobs_give_the_same_trees(spark, table, monkeypatch):
    edges = [[i / 20 for i in range(1, 20)]] * 2 + [[]]
    options = {**OPTIONS, "num_round": 1}
    whole = boosting.fit_hist_boost(table, "x", "y", edges=edges, **options)
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 1)
    close(whole.rows, boosting.fit_hist_boost(table, "x", "y", edges=edges, **options).rows)
    close(whole.rows, boosting.fit_hist_boost(table, "x", "y", edges=edges, subtract=True, **options).rows)


def test_training_margin_equals_scoring_margin(spark, table):
    """Bins during training and raw values during scoring send every row to the same leaf."""
    edges = boosting.quantile_edges(table.select("x"), "x", 32)
    model = boosting.fit_hist_boost(table, "x", "y", edges=edges, **OPTIONS)
    both = table.select("x", boosting.binned("x", edges).alias("b"), F.lit(0.0).alias("m"))
    both = both.withColumn("by_bin", boosting._add_trees("b", "m", model.trees()))
    both = boosting.score_hist_boost(both, model, "x")
    assert both.where(F.abs(F.col("by_bin") - F.col("margin")) > 1e-12).count() == 0


def test_save_and_load(spark, table, tmp_path):
    model = boosting.fit_hist_boost(table, "x", "y", **OPTIONS)
    model.save(spark, str(tmp_path / "m"))
    back = boosting.BoostModel.load(spark, str(tmp_path / "m"))
    assert back == model
    counts = {r.feature: r.splits for r in boosting.boost_split_counts(back.node_table(spark)).collect()}
    assert sum(counts.values()) == sum(r[2] is not None for r in model.rows)
    shares = boosting.boost_importances(back.node_table(spark)).collect()
    assert sum(r.importance for r in shares) == pytest.approx(1.0)


def test_nothing_to_split(spark):
    df = spark.range(50).select(F.array(F.lit(1.0)).alias("x"), (F.col("id") % 2).alias("y"))
    model = boosting.fit_hist_boost(df, "x", "y", edges=[[]], **OPTIONS)
    assert model.rows == []
    assert boosting.score_hist_boost(df, model, "x").where("margin != 0").count() == 0


def test_one_class_only(spark):
    df = spark.range(200).select(F.array(F.col("id").cast("double")).alias("x"), F.lit(1).alias("y"))
    model = boosting.fit_hist_boost(df, "x", "y", edges=[[50.0, 100.0]], **{**OPTIONS, "num_round": 1})
    assert boosting.score_hist_boost(df, model, "x").where("prediction != 1").count() == 0


def test_regression_lowers_the_error(spark, table):
    df = table.select("x", (F.get("x", F.lit(0)) * 10).alias("t"))
    model = boosting.fit_hist_boost(df, "x", "t", objective="reg:squarederror", **OPTIONS)
    gap = boosting.score_hist_boost(df, model, "x").agg(
        F.avg(F.pow(F.col("prediction") - F.col("t"), 2)).alias("after"), F.avg(F.col("t") * F.col("t")).alias("before"))
    assert gap.first().after < gap.first().before / 5


def test_bad_rows_are_refused(spark):
    rows = spark.range(50).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"), (F.col("id") % 2).alias("y"), "id")
    options = {"edges": [[10.0, 20.0], [0.5]], "num_round": 1, "max_depth": 1, "min_child_weight": 1.0}
    with pytest.raises(ValueError, match="null or NaN labels"):
        boosting.fit_hist_boost(rows.withColumn("y", F.when(F.col("id") != 3, F.col("y"))), "x", "y", **options)
    for bad in (F.when(F.col("id") != 3, F.col("x")), F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))):
        with pytest.raises(Exception, match="array of 2 values"):
            boosting.fit_hist_boost(rows.withColumn("x", bad), "x", "y", **options)
    model = boosting.fit_hist_boost(rows, "x", "y", **options)
    assert boosting.score_hist_boost(rows.limit(0), model, "x").count() == 0
    nan = spark.createDataFrame([(1, 0, 0, float("nan"), 1.0), (1, 0, 1, 1.0, 1.0)], "node int, feature int, bin int, g double, h double")
    assert boosting.best_split(nan).count() == 0


def test_same_trees_on_any_number_of_partitions(spark):
    rows = spark.range(4000).select(F.array(F.col("id") % 37 * 1.0, F.col("id") % 11 * 1.0).alias("x"), (F.col("id") % 37 > 20).cast("int").alias("y"))
    options = {"edges": [[float(i) for i in range(36)], [float(i) for i in range(10)]], "num_round": 3, "max_depth": 3}
    one = boosting.fit_hist_boost(rows, "x", "y", partitions=2, **options).rows
    two = boosting.fit_hist_boost(rows, "x", "y", partitions=200, **options).rows
    assert [r[:6] for r in one] == [r[:6] for r in two]
