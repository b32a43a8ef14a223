"""Models fitted together equal models fitted one by one."""

import numpy as np
import pytest

from broadloom.operators import boosting, manyboost, search


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        x = [float(v) if r.random() > 0.1 else None for v in r.normal(size=3)]
        rows.append((i, x, int(((x[0] or 0.0) > 0.3) ^ ((x[1] or 0.0) > 0.2) ^ (r.random() < 0.1))))
    return spark.createDataFrame(rows, "id long, x array<double>, y int").cache()


SETTINGS = [{"num_round": 1, "max_depth": 2}, {"num_round": 4, "max_depth": 2}, {"num_round": 3, "max_depth": 3, "eta": 0.5, "pos_weight": 2.0},
            {"num_round": 2, "max_depth": 1, "reg_lambda": 5.0, "min_child_weight": 200.0}, {"num_round": 2, "max_depth": 3, "gamma": 1e6},
            {"num_round": 3, "max_depth": 3, "eta": 0.5, "pos_weight": 2.0}]


@pytest.mark.parametrize("objective", ["binary:logistic", "reg:squarederror"])
def test_equal_to_single_fits(spark, table, objective, monkeypatch):
    edges = manyboost.weighted_edges(table, "x", None, 32)
    asked = [s | {"min_child_weight": s.get("min_child_weight", 2.0), "gamma": s.get("gamma", 0.0)} for s in SETTINGS]
    together = manyboost.fit_many(table, "x", "y", asked, objective, edges=edges, refresh=2)
    for given, model in zip(asked, together):
        alone = boosting.fit_hist_boost(table, "x", "y", objective, edges=edges, **(manyboost.SETTINGS | given))
        assert [r[:4] for r in model.rows] == [r[:4] for r in alone.rows]
        assert np.allclose([r[8] or 0.0 for r in model.rows], [r[8] or 0.0 for r in alone.rows], atol=1e-12)
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 16 * 3 * 40 * 2)  # two nodes a scan
    split = manyboost.fit_many(table, "x", "y", asked[:3], objective, edges=edges)
    assert [[r[:4] for r in m.rows] for m in split] == [[r[:4] for r in m.rows] for m in together[:3]]


def test_jobs_do_not_grow_with_the_trials(spark, table):
    edges = manyboost.weighted_edges(table, "x", None, 16)

    def jobs(settings):
        spark.sparkContext.setJobGroup(f"many-{len(settings)}", "")
        manyboost.fit_many(table, "x", "y", settings, edges=edges)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"many-{len(settings)}"))

    few = jobs([{"num_round": 2, "max_depth": 2, "min_child_weight": 1.0}])
    many = jobs([{"num_round": 2, "max_depth": 2, "min_child_weight": 1.0, "eta": 0.1 * k} for k in range(1, 8)])
    assert many <= few + 2


def test_search_picks_the_best_and_saves_it(spark, table, tmp_path):
    train, valid = table.where("id % 4 <> 0"), table.where("id % 4 = 0")
    space = {"n_estimators": search.Grid([1, 4]), "max_depth": search.Choice([1, 3]), "eta": search.Choice([0.2, 0.6])}
    trials = search.expand_trials(spark, space, n_sampling=3, seed=5)
    results, best, model = manyboost.search_many(train, valid, "x", "y", trials, min_child_weight=2.0, gamma=0.0, path=str(tmp_path / "best"))
    rows = results.collect()
    assert len(rows) == 6 and {r.trial for r in rows} == set(range(6))
    first = best.first()
    assert (first.error, first.trial) == min((r.error, r.trial) for r in rows)
    loaded = boosting.BoostModel.load(spark, str(tmp_path / "best"))
    scored = boosting.score_hist_boost(valid, loaded, "x")
    assert scored.where("prediction <> y").count() / valid.count() == pytest.approx(first.error)
    assert loaded.rows == model.rows


def test_settings_are_checked(spark, table):
    with pytest.raises(ValueError, match="unknown"):
        manyboost.fit_many(table, "x", "y", [{"depth": 3}])
    with pytest.raises(ValueError, match="no settings"):
        manyboost.fit_many(table, "x", "y", [])
    with pytest.raises(ValueError, match="null or NaN"):
        manyboost.fit_many(table.selectExpr("x", "nullif(y, 1) AS y"), "x", "y", [{"num_round": 1}])
    fits, which = manyboost.grouped([{"num_round": 5}, {"num_round": 9}, {"eta": 0.3}])
    assert which == [0, 0, 1] and fits[0]["num_round"] == 9
