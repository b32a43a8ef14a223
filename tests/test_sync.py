"""Synchronous training: the layout does not matter, metrics count every row, stopped fits go on."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dense import every_kind

from broadloom.functions import metrics
from broadloom.operators import dense, network as net, sync
from broadloom.session import versions


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(0, 1530, 1, 16).select(
        (i * 7 % 1530).alias("id"), (i % 5).cast("double").alias("c"), F.array(*[F.sin(i * (k + 1)) for k in range(4)]).alias("x"),
        (F.sin(i) + F.cos(i * 2) > 0).cast("int").alias("y"), (i % 3).cast("int").alias("k")).cache()


def close(a, b, tolerance=1e-9):
    return all(np.allclose(v, b.params[n], rtol=tolerance, atol=tolerance) for n, v in a.params.items())


def test_every_layer_kind_trains_alike_on_any_number_of_tasks(spark, table):
    """Embedding, normalisation, dropout, two heads and more; the last batch is smaller."""
    spec = every_kind("bce", "sigmoid")
    one, log = sync.fit_sync(table, spec, "id", 600, 1, rate=1e-2, tasks=1, seed=3)
    for tasks, partitions in ((4, 16), (7, 1)):
        other, log2 = sync.fit_sync(table.repartition(partitions), spec, "id", 600, 1, rate=1e-2, tasks=tasks, seed=3)
        assert close(one, other)
        a, b = ({(r.step, r.metric): r.value for r in x.collect()} for x in (log, log2))
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-12) for k in a)
    start = net.initial(spec, 3)
    assert all(np.abs(one.params[n] - start[n]).max() > 0 for n in one.params)


def test_one_step_at_a_time_is_plain_minibatch_training(spark, table):
    spec = net.classifier_spec("x", 4, "y", [5])
    model, _ = sync.fit_sync(table, spec, "id", 510, 2, rate=1e-2, tasks=4, seed=2)
    rows = table.orderBy("id").collect()
    x, y = np.array([r.x for r in rows]), np.array([[float(r.y)] for r in rows])
    p = net.initial(spec, 2)
    m, v = ({n: np.zeros_like(a) for n, a in p.items()} for _ in range(2))
    for step in range(6):
        part = slice(step % 3 * 510, step % 3 * 510 + 510)
        _, grads, _ = net.backward(spec, p, {"x": x[part]}, {"y": y[part]}, None)
        net.adam(p, grads, m, v, step + 1, 1e-2)
    assert close(dense.DenseModel(spec, p), model)


def test_a_partial_batch_weighs_as_many_rows_as_it_has(spark, table):
    spec = net.regressor_spec("x", 4, "y", [3])
    whole, _ = sync.fit_sync(table.where("id < 64"), spec, "id", 64, 1, rate=0.1, tasks=2)
    more, _ = sync.fit_sync(table.where("id < 65"), spec, "id", 64, 1, rate=0.1, tasks=2)
    repeated, _ = sync.fit_sync(table.where("id < 128"), spec, "id", 64, 1, rate=0.1, tasks=2)

    def moved(a):
        return np.mean([np.abs(v - whole.params[n]).mean() for n, v in a.params.items()])

    assert moved(more) < 0.075 and moved(more) != moved(repeated)


@pytest.mark.parametrize("every", [5, 100])
def test_local_steps_learn_and_every_row_counts(spark, table, every):
    spec = every_kind("bce", "sigmoid")
    train, held = table.where("id % 5 <> 0"), table.where("id % 5 = 0")
    model, log = sync.fit_sync(train, spec, "id", 128, 4, rate=3e-2, tasks=4, sync_every=every, validation=held)
    told = {(r.epoch, r.metric): r.value for r in log.collect()}
    assert all(told[e, "rows"] == 1224 for e in range(4))
    assert told[3, "val_o_bce"] < told[0, "val_o_bce"] and told[3, "val_o_auc"] > 0.8
    assert all(np.isfinite(a).all() for a in model.params.values())


def test_metrics_of_a_fit_equal_those_of_its_scores(spark, table):
    """At rate 0 the net stays as it is, so the counters of the epoch are those of the scored table."""
    spec = net.classifier_spec("x", 4, "y", [5])
    model = dense.DenseModel(spec, net.initial(spec, 5))
    _, log = sync.fit_sync(table, spec, "id", 100, 1, rate=0.0, init=model, tasks=4, sync_every=16, log_every=5, validation=table)
    told = {(r.step, r.metric): r.value for r in log.collect()}
    assert sorted({s for s, _ in told}) == [5, 10, 15, 16]
    scored = dense.score_dense(table, model)
    for step, part in ((5, scored.where("id < 500")), (10, scored.where("id < 1000")), (16, scored)):
        want = metrics.confusion_counts(part, "y", "prediction").first()
        assert [told[step, f"output_{k}"] for k in ("tp", "tn", "fp", "fn")] == [want[k] for k in ("tp", "tn", "fp", "fn")]
        n = part.count()
        assert told[step, "output_accuracy"] == pytest.approx((want.tp + want.tn) / n)
        assert told[step, "output_bce"] == pytest.approx(metrics.metric_bce(part, "y", "prediction").first()[0], rel=1e-9)
    assert told[16, "output_auc"] == pytest.approx(metrics.metric_auc(scored, "y", "prediction").first()[0], abs=0.01)
    assert {k[4:]: v for (_, k), v in told.items() if k.startswith("val_")} == pytest.approx(
        {k: v for (s, k), v in told.items() if s == 16 and not k.startswith("val_") and k != "rows"})


def test_counters_of_parts_add_up():
    r = np.random.default_rng(0)
    for kind, out, y in (("binary", r.random((70, 1)), r.integers(0, 2, (70, 1))), ("values", r.normal(size=(70, 3)), r.normal(size=(70, 3))),
                         ("classes", r.random((70, 4)), r.integers(0, 4, (70, 1)))):
        whole = sync.head_counts(kind, out, y, 0.5)
        parts = sum(sync.head_counts(kind, out[a:b], y[a:b], 0.5) for a, b in ((0, 13), (13, 14), (14, 70)))
        assert np.allclose(whole, parts)
    assert sync.head_metrics("binary", sync.head_counts("binary", np.array([[0.9], [0.2]]), np.array([[1], [0]]), 0.0))["auc"] == 1.0


def test_moments_merge_to_those_of_all_rows():
    r = np.random.default_rng(1)
    v = r.normal(size=(50, 3)) * 5 + 1000
    parts = [v[:7], v[7:7], v[7:]]

    class Fake(sync.Across):
        def gathered(self, told):
            def of(x):
                mean = x.mean(axis=0) if len(x) else np.zeros(3)
                return np.concatenate([[len(x)], mean, ((x - mean) ** 2).sum(axis=0)])
            return [of(x) for x in parts]

    mean, var = Fake(None, 3).moments(parts[0])
    assert np.allclose(mean, v.mean(axis=0)) and np.allclose(var, v.var(axis=0))


def test_only_touched_rows_of_a_table_are_sent():
    r = np.random.default_rng(2)
    grads = []
    for k in range(3):
        g = np.zeros((1000, 4))
        g[r.choice(1000, 5 - k, replace=False)] = r.normal(size=(5 - k, 4))
        grads.append(g)
    sent = []

    class Fake(sync.Across):
        def gathered(self, told):
            sent.append(told)
            return self.parts

    fakes = []
    for g in grads:
        across = Fake(None, 3)
        across.parts = []
        across.table_sum(g, 8)
        fakes.append(sent[-1])
    across = Fake(None, 3)
    across.parts = fakes
    assert (across.table_sum(grads[0], 8) == grads[0] + grads[1] + grads[2]).all()
    assert all(len(x) == 8 * 5 for x in sent)


def test_running_variance_holds_the_spread_between_tasks():
    tasks = [{"n/mean": np.array([1.0]), "n/variance": np.array([2.0])}, {"n/mean": np.array([5.0]), "n/variance": np.array([4.0])}]
    sent = [net.squared_spread(t) for t in tasks]
    merged = net.spread({n: (sent[0][n] + sent[1][n]) / 2 for n in sent[0]})
    assert merged["n/mean"] == [3.0] and merged["n/variance"] == [3.0 + 4.0]


def test_a_stopped_fit_goes_on_as_if_it_had_not(spark, table, tmp_path):
    spec = net.classifier_spec("x", 4, "y", [4])
    straight, _ = sync.fit_sync(table, spec, "id", 800, 3, rate=1e-2, tasks=3)
    path = str(tmp_path / "fit")
    sync.fit_sync(table, spec, "id", 800, 2, rate=1e-2, tasks=3, path=path)
    resumed, log = sync.fit_sync(table, spec, "id", 800, 3, rate=1e-2, tasks=3, path=path)
    assert close(straight, resumed, 1e-12) and {r.epoch for r in log.collect()} == {2}
    assert versions(spark, path) == [1, 2]
    with pytest.raises(ValueError, match="another shape"):
        sync.fit_sync(table, net.classifier_spec("x", 4, "y", [5]), "id", 800, 3, path=path)


def test_a_failed_save_leaves_the_old_model(spark, tmp_path):
    spec = net.regressor_spec("x", 2, "y", [3])
    first = dense.DenseModel(spec, net.initial(spec, 1))
    path = str(tmp_path / "model")
    dense.save_params(spark, first, path)
    half = tmp_path / "model" / "version-1"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"cut short")
    loaded = dense.load_params(spark, path)
    assert all((loaded.params[n] == a).all() for n, a in first.params.items())
    second = dense.DenseModel(spec, net.initial(spec, 2))
    dense.save_params(spark, second, path)
    assert all((dense.load_params(spark, path).params[n] == a).all() for n, a in second.params.items())
    with pytest.raises(FileNotFoundError):
        dense.load_params(spark, str(tmp_path / "none"))


def test_odd_tables(spark, table):
    spec = net.classifier_spec("x", 4, "y", [3])
    with pytest.raises(ValueError, match="no rows"):
        sync.fit_sync(table.where("id < 0"), spec, "id")
    with pytest.raises(Exception, match="not finite"):
        sync.fit_sync(table.withColumn("y", F.when(F.col("id") != 5, F.col("y"))), net.regressor_spec("x", 4, "y", [3]), "id", 800, tasks=2)
    few, log = sync.fit_sync(table.where("id < 3"), spec, "id", 100, 2, tasks=8)
    assert {r.value for r in log.where("metric = 'rows'").collect()} == {3.0}


@pytest.mark.parametrize("size, tasks, every, log_every, held", [(128, 4, 5, None, 10 ** 5), (100, 3, 4, 7, 150)])
def test_jobs_of_some_steps_give_what_gathers_give(spark, table, monkeypatch, size, tasks, every, log_every, held):
    """To the last bit of the net, with one partition a task and with several."""
    spec = every_kind("bce", "sigmoid")
    monkeypatch.setattr(sync, "ROUND_ROWS", held)
    found = []
    for most in (sync.ROUND_BYTES, 0):
        monkeypatch.setattr(sync, "ROUND_BYTES", most)
        model, log = sync.fit_sync(table, spec, "id", size, 2, rate=1e-2, tasks=tasks, seed=3, sync_every=every, log_every=log_every)
        found.append((model.params, {(r.step, r.metric): r.value for r in log.collect()}))
    (a, la), (b, lb) = found
    assert all((a[n] == b[n]).all() for n in b)
    assert la.keys() == lb.keys() and all(la[k] == pytest.approx(lb[k], rel=1e-9, abs=1e-12) for k in la)


def test_averages_do_not_wait_a_second_each(spark, table):
    spec = net.classifier_spec("x", 4, "y", [5])
    start = time.monotonic()
    sync.fit_sync(table, spec, "id", 30, 2, rate=1e-2, tasks=2, sync_every=2)  # 52 averages
    assert time.monotonic() - start < 40


def test_partitions_of_jobs_do_not_grow_with_the_table(spark, table):
    sizes = []
    for rows in (400, 1530):
        laid = sync.laid_out(table.where(F.col("id") < rows), ["x", "y"], "id", 40, 2, 5, -(-rows // 200))
        cuts = sync._stored_cuts(laid, {"x": 4})
        sizes.append(cuts.glom().map(lambda part: sum(len(c["_row"]) for _, c in part)).collect())
    assert max(sizes[0]) == max(sizes[1]) == 100 and [sum(s) for s in sizes] == [400, 1530]
