import pytest
from pyspark.sql import functions as F

from broadloom.operators import features, report, search, trees
from broadloom.plans import jobs

SPACE = {"n_estimators": search.Grid([50, 100, 200]), "max_depth": search.Choice([2, 4, 6])}


def test_trials(spark):
    rows = search.expand_trials(spark, SPACE, n_sampling=2, seed=2).orderBy("trial").collect()
    assert [r.trial for r in rows] == list(range(6))
    assert [r.n_estimators for r in rows] == [50, 100, 200] * 2
    assert all(r.max_depth in (2, 4, 6) for r in rows)
    assert rows == search.expand_trials(spark, SPACE, 2, 2).orderBy("trial").collect()
    two = {"a": search.Grid([1, 2]), "b": search.Grid([0.1, 0.2, 0.3])}
    pairs = {(r.a, r.b) for r in search.expand_trials(spark, two).collect()}
    assert len(pairs) == 6


def test_best_by_mode_with_ties(spark):
    df = spark.createDataFrame([(0, 0.3), (1, 0.1), (2, 0.1), (3, 0.9), (4, None)], "trial long, m double")
    assert search.best_trial(df, "m").first().trial == 1
    assert search.best_trial(df, "m", "max").first().trial == 3


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(800).select("id", (F.col("id") % 40).cast("double").alias("a"),
                                 (F.col("id") % 7).cast("double").alias("b"),
                                 (F.col("id") % 40 > 25).cast("int").alias("y"))
    return features.assemble(df, ["a", "b"]).cache()


def test_search_finds_a_model_and_reports_it(spark, table):
    space = {"n_estimators": search.Grid([1, 2]), "max_depth": search.Choice([2])}
    results, best, model = jobs.search_job(table, table, "features", "y", space, n_sampling=1)
    assert results.count() == 2 and best.first().error == 0.0 and best.first().trial == 0
    counts = {r.feature: r.splits for r in trees.feature_split_counts(spark, model).collect()}
    shares = {r.feature: r.importance for r in trees.feature_importances(spark, model).collect()}
    assert counts[0] >= 1 and shares[0] == pytest.approx(1.0)
    assert sum(counts.values()) == sum((t.numNodes - 1) // 2 for t in model.trees)


def test_search_over_histogram_trees(spark, table):
    from pyspark.ml.functions import vector_to_array
    df = table.select("y", vector_to_array("features").alias("x"))
    space = {"n_estimators": search.Grid([1]), "max_depth": search.Choice([2])}
    results, best, model = jobs.search_job(df, df, "x", "y", space, n_sampling=1, learner="hist", min_child_weight=1.0)
    assert best.first().error == 0.0 and model.rows[0][2] == 0


def test_boosted_job_round_trip(spark, table, tmp_path):
    out = jobs.boosted_job(table.select("id", "a", "b", F.col("y").alias("output")), "output", ["a", "b"], ["id"],
                           str(tmp_path / "m"), rounds=2, depth=2)
    assert "features" not in out.columns and {"label", "rawPrediction", "probability", "prediction"} <= set(out.columns)
    assert out.where("prediction != label").count() == 0


@pytest.mark.parametrize("fit_on", ["train", "all"])
def test_moments_come_from_the_chosen_rows(spark, table, fit_on):
    from pyspark.ml.functions import vector_to_array
    train, test = jobs.prepared(table.select("id", "a", "b", "y"), "y", [], ["a"], ["id"], fit_on=fit_on)
    rows = train if fit_on == "train" else train.union(test)
    mean = rows.agg(F.avg(F.get(vector_to_array("scaled_features"), F.lit(0)))).first()[0]
    assert abs(mean) < 1e-9


def test_log_appends_and_thins(spark, tmp_path):
    path = str(tmp_path / "log")
    for epoch in range(2):
        rows = [("r", epoch, s, "loss", float(s)) for s in range(10)]
        report.append_log(spark.createDataFrame(rows, "run string, epoch int, step long, metric string, value double"), path)
    assert report.read_log(spark, path).count() == 20
    assert sorted({r.step for r in report.read_log(spark, path, every=4).collect()}) == [0, 4, 8]


def test_search_takes_any_parameter_and_saves_the_best(spark, table, tmp_path):
    from pyspark.ml.functions import vector_to_array

    from broadloom.operators import boosting
    df = table.select(F.col("y").cast("double").alias("y"), vector_to_array("features").alias("x"))
    space = {"n_estimators": search.Grid([1]), "max_depth": search.Grid([2]), "eta": search.Grid([0.1, 0.9])}
    path = str(tmp_path / "best")
    results, best, model = jobs.search_job(df, df, "x", "y", space, 1, "regress", "hist", metric="mae", path=path, min_child_weight=1.0)
    errors = {r.eta: r.mae for r in results.collect()}
    assert errors[0.1] > errors[0.9] and best.first().eta == 0.9
    assert boosting.BoostModel.load(spark, path).rows == model.rows
    worst = jobs.search_job(df, df, "x", "y", space, 1, "regress", "hist", metric="mae", mode="max", min_child_weight=1.0)[1]
    assert worst.first().eta == 0.1
    with pytest.raises(TypeError):
        jobs.search_job(df, df, "x", "y", {"n_estimators": search.Grid([1]), "no_such": search.Grid([1])}, 1, learner="hist")
