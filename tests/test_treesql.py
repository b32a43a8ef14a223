"""Ensembles as SQL text: equal to the model on every row, in Spark and in DuckDB."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from broadloom.operators import boosting, trees, treesql


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        x = [float(v) if r.random() > 0.15 else (None if r.random() < 0.5 else float("nan")) for v in r.normal(size=4)]
        rows.append((i, x, int((x[0] or 0.0) > 0.3) ^ int(x[1] is None), "kept"))
    return spark.createDataFrame(rows, "id long, x array<double>, y int, f0 string").cache()


@pytest.mark.parametrize("objective", ["binary:logistic", "reg:squarederror"])
def test_hist_model_in_spark_and_duckdb(spark, table, objective):
    model = boosting.fit_hist_boost(table, "x", "y", objective, num_round=4, max_depth=3, min_child_weight=2.0, gamma=0.0, base_margin=0.25)
    ensemble = treesql.of_hist(model)
    want = {r.id: r.margin for r in boosting.score_hist_boost(table, model, "x").collect()}
    scored = treesql.score_sql(table, ensemble, "x")
    assert {r.id: r.margin for r in scored.collect()} == want and scored.where("f0 = 'kept'").count() == 1200
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    rows = [(r.id, *[None if v is None or np.isnan(v) else v for v in r.x]) for r in table.collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, c0 DOUBLE, c1 DOUBLE, c2 DOUBLE, c3 DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    found = dict(con.sql(f"SELECT id, {treesql.margin_sql(ensemble, ['c0', 'c1', 'c2', 'c3'])} FROM t").fetchall())
    assert found == want


@pytest.mark.parametrize("task", ["classify", "regress"])
def test_gbt_equals_its_transform(spark, table, task):
    whole = table.select("id", F.transform("x", lambda v: F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))).alias("x"), "y")
    df = whole.withColumn("v", array_to_vector("x"))
    model = trees.fit_gbt(df, "v", "y", task, rounds=4, depth=3)
    scored = treesql.score_sql(df, treesql.of_gbt(spark, model), "x")
    both = model.transform(treesql.with_classes(scored, 2.0).withColumnsRenamed({"probability": "p", "prediction": "said"}) if task == "classify" else scored)
    if task == "classify":
        wrong = both.where((F.abs(vector_to_array("probability")[1] - F.col("p")) > 1e-12) | (F.col("prediction") != F.col("said")))
    else:
        wrong = both.where(F.abs(F.col("prediction") - F.col("margin")) > 1e-12)
    assert both.count() == 1200 and wrong.isEmpty()


def test_missing_features_empty_models_and_clashes(spark):
    leaf = treesql.Ensemble((({1: treesql.Node(0.5)}, 1),), (1.0,), 1.0)
    df = spark.createDataFrame([(1, None, 9.0, "a"), (2, [], 9.0, "b"), (3, [1.0, float("nan")], 9.0, "c")], "id int, x array<double>, margin double, _margin string")
    assert [r.margin for r in treesql.score_sql(df, leaf, "x").collect()] == [1.5, 1.5, 1.5]
    none = treesql.Ensemble((), ())
    assert [r.margin for r in treesql.score_sql(df, none, "x").collect()] == [0.0, 0.0, 0.0]
    split = treesql.Ensemble((({1: treesql.Node(0.0, 1, 5.0, True, 2, 3), 2: treesql.Node(-1.0), 3: treesql.Node(1.0)}, 1),), (1.0,))
    scored = treesql.score_sql(df, split, "x")
    assert [(r.margin, r._margin) for r in scored.orderBy("id").collect()] == [(-1.0, "a"), (-1.0, "b"), (-1.0, "c")]
    assert treesql.score_sql(df.limit(0), split, "x").count() == 0
    assert treesql.number(float("inf")).endswith("e308")
