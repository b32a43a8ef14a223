import numpy as np
import pytest
from pyspark.sql import functions as F

from broadloom.operators import dense, network as net
from broadloom.plans import jobs


def every_kind(loss="mse", activation="linear"):
    layers = (
        net.Layer("e", "embed", ("c",), 3, vocab=5),
        net.Layer("h", "dense", ("x",), 4, "sigmoid"),
        net.Layer("j", "concat", ("e", "h")),
        net.Layer("n", "norm", ("j",)),
        net.Layer("d", "drop", ("n",), rate=0.3),
        net.Layer("r", "dense", ("d",), 6, "relu"),
        net.Layer("o", "dense", ("r",), 1, activation),
        net.Layer("k", "dense", ("r",), 3, "softmax"),
        net.Layer("w", "dense", ("h",), 4, "linear"),
    )
    return net.DenseSpec({"c": 0, "x": 4}, layers, (net.Head("o", "y", loss), net.Head("k", "k", "sparse_ce"),
                                                    net.Head("w", "x", "mse")))


@pytest.mark.parametrize("loss,activation", [("mse", "linear"), ("mae", "linear"), ("bce", "sigmoid"),
                                             ("focal", "sigmoid")])
def test_gradients_against_finite_differences(loss, activation):
    spec, rng = every_kind(loss, activation), np.random.default_rng(0)
    x = {"c": rng.integers(0, 5, (12, 1)).astype(float), "x": rng.normal(size=(12, 4))}
    y = {"y": rng.integers(0, 2, (12, 1)).astype(float), "k": rng.integers(0, 3, (12, 1)).astype(float), "x": x["x"]}
    p = {n: a + rng.normal(size=a.shape) * 0.1 if net.trainable(n) else a for n, a in net.initial(spec, 1).items()}

    def total(q):
        return sum(net.backward(spec, q, x, y, np.random.default_rng(7))[0])

    _, grads, _ = net.backward(spec, p, x, y, np.random.default_rng(7))
    assert set(grads) == {n for n in p if net.trainable(n)}
    for n, g in grads.items():
        for at in [tuple(rng.integers(0, s) for s in g.shape) for _ in range(4)]:
            up, down = ({**p, n: p[n].copy()} for _ in range(2))
            up[n][at] += 1e-6
            down[n][at] -= 1e-6
            assert g[at] == pytest.approx((total(up) - total(down)) / 2e-6, abs=1e-5), (n, at)


def test_spec_survives_json():
    spec = net.multitask_spec(8, 8)
    assert net.DenseSpec.from_json(spec.to_json()) == spec
    assert spec.widths()["concatenate"] == 16 + 16 + 128
    assert sum(a.size for a in net.initial(net.multitask_spec(846, 846)).values()) > 10 ** 6


@pytest.fixture(scope="module")
def line(spark):
    return spark.range(4000).select(
        "id", F.array((F.col("id") % 17) / 17.0, (F.col("id") % 23) / 23.0).alias("x"),
        ((F.col("id") % 17) / 17.0 * 2 - (F.col("id") % 23) / 23.0 + 1).alias("y")).cache()


def test_fit_is_repeatable_ignores_layout_and_learns(spark, line):
    spec = net.regressor_spec("x", 2, "y", [8])
    one, log = dense.fit_dense(line, spec, "id", 64, 4, rate=1e-2, partitions=4, seed=1)
    two, _ = dense.fit_dense(line.repartition(3), spec, "id", 64, 4, rate=1e-2, partitions=4, seed=1)
    for n, a in one.params.items():
        assert np.allclose(a, two.params[n], rtol=1e-6, atol=1e-8), n
    rows = log.where("metric <> 'rows'").orderBy("epoch").collect()
    losses = [r.value for r in rows]
    assert losses[-1] < losses[0] / 10 and losses[-1] < 0.05
    assert [r.step for r in rows] == [63, 126, 189, 252]
    assert {r.value for r in log.where("metric = 'rows'").collect()} == {4000.0}


def test_one_partition_is_plain_minibatch_training(spark, line):
    """With one partition the job is sequential Adam over the rows in key order."""
    spec = net.regressor_spec("x", 2, "y", [3])
    model, _ = dense.fit_dense(line, spec, "id", 100, 1, rate=1e-2, partitions=1, seed=2)
    rows = line.orderBy("id").collect()
    x, y = np.array([r.x for r in rows]), np.array([[r.y] for r in rows])
    p = net.initial(spec, 2)
    m, v = ({n: np.zeros_like(a) for n, a in p.items()} for _ in range(2))
    for i in range(40):
        part = slice(i * 100, i * 100 + 100)
        _, grads, _ = net.backward(spec, p, {"x": x[part]}, {"y": y[part]}, np.random.default_rng(0))
        net.adam(p, grads, m, v, i + 1, 1e-2)
    for n, a in p.items():
        assert np.allclose(a, model.params[n]), n


def test_too_few_rows_are_refused(spark, line):
    with pytest.raises(ValueError, match="fewer than one batch"):
        dense.fit_dense(line.limit(31), net.regressor_spec("x", 2, "y", [3]), "id", 32, drop_last=True)
    _, log = dense.fit_dense(line.limit(31), net.regressor_spec("x", 2, "y", [3]), "id", 32)
    assert log.where("metric = 'rows'").first().value == 31


def test_every_row_is_trained_and_no_array_runs_on(spark, line):
    spec = net.regressor_spec("x", 2, "y", [3])
    for partitions in (1, 7, 64):
        _, log = dense.fit_dense(line.limit(1003), spec, "id", 32, 2, partitions=partitions)
        assert {r.value for r in log.where("metric = 'rows'").collect()} == {1003.0}
        _, log = dense.fit_dense(line.limit(1003), spec, "id", 32, partitions=partitions, drop_last=True)
        assert log.where("metric = 'rows'").first().value == 992
    for bad in (F.when(F.col("id") != 3, F.col("x")), F.when(F.col("id") != 3, F.col("x")).otherwise(F.array(F.lit(1.0)))):
        with pytest.raises(Exception, match="array of 2 values"):
            dense.fit_dense(line.withColumn("x", bad), spec, "id", 32)
        with pytest.raises(Exception, match="array of 2 values"):
            dense.score_dense(line.withColumn("x", bad), dense.DenseModel(spec, net.initial(spec))).collect()


def test_bad_rows_are_refused(spark, line):
    holes = line.withColumn("y", F.when(F.col("id") != 5, F.col("y")))
    with pytest.raises(Exception, match="not finite"):
        dense.fit_dense(holes, net.regressor_spec("x", 2, "y", [3]), "id", 32, partitions=2)
    spec = net.DenseSpec({"c": 0}, (net.Layer("e", "embed", ("c",), 2, vocab=3), net.Layer("o", "dense", ("e",), 1)), ())
    for bad in (-1.0, 3.0):
        with pytest.raises(ValueError, match="0..2"):
            net.forward(spec, net.initial(spec), {"c": np.array([[bad]])})


def test_full_batch_steps_ignore_layout(spark, line):
    spec = net.regressor_spec("x", 2, "y", [4])
    a = dense.fit_full_batch(line, spec, 5, 0.05)
    b = dense.fit_full_batch(line.repartition(7), spec, 5, 0.05)
    assert all(np.allclose(v, b.params[n], rtol=1e-9) for n, v in a.params.items())
    losses = [dense.validation_metrics(line, m)["val_output_mse"]
              for m in (dense.DenseModel(spec, net.initial(spec)), a)]
    assert losses[1] < losses[0]


def test_small_tables_and_uneven_partitions(spark, line):
    """64 rows on 64 partitions asked for: some are empty."""
    model, log = dense.fit_dense(line.where("id < 64"), net.regressor_spec("x", 2, "y", [3]), "id", 64, 1,
                                 partitions=64)
    assert log.count() == 2
    assert all(np.isfinite(a).all() for a in model.params.values())


def test_save_load_and_warm_start(spark, line, tmp_path):
    spec = net.regressor_spec("x", 2, "y", [8])
    train, valid = line.where("id % 5 != 0"), line.where("id % 5 = 0")
    first, log = dense.fit_dense(train, spec, "id", 64, 2, rate=1e-2, partitions=2)
    dense.save_params(spark, first, str(tmp_path / "template"))
    model, log = jobs.train_job(train, valid, "id", str(tmp_path) + "/", "/next", str(tmp_path / "template"), 64, 2,
                                partitions=2)
    rows = {(r.epoch, r.metric): r.value for r in log.collect()}
    assert set(m for _, m in rows) == {"output_mse", "val_output_mse", "rows"}
    again = jobs.inference_job(valid, str(tmp_path), "next")
    mse = again.agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert mse == pytest.approx(rows[1, "val_output_mse"], rel=1e-6)
    loaded = dense.load_params(spark, str(tmp_path / "next"))
    assert loaded.spec == model.spec and all((loaded.params[n] == a).all() for n, a in model.params.items())


def test_multitask_and_transfer(spark):
    from broadloom.sources.generate import gen_classification, gen_regression
    classes = gen_classification(spark.range(600), 12).select("id", "input_1", "input_2", F.col("f").alias("input_3"),
                                                              F.col("d").alias("decoder_4"), "output")
    target = gen_regression(spark.range(600), 12).select("id", "input_1", "input_2", F.col("f").alias("input_3"), "output")
    spec = net.multitask_spec(12, 12, encoder=(16, 8), top=(8,))
    parent, log = jobs.multitask_job(classes, spec, "id", 60, partitions=3)
    assert {r.metric for r in log.collect()} == {"decoder_3_mse", "output_sparse_ce", "rows"}
    scored = dense.score_dense(classes, parent).first().prediction
    assert len(scored.decoder_3) == 12 and sum(scored.output) == pytest.approx(1.0)
    before = {n: a.copy() for n, a in parent.params.items()}
    head, _ = jobs.transfer_job(target, parent, "id", "output", 60, epochs=3, units=(16, 8), partitions=3)
    assert all((before[n] == a).all() for n, a in parent.params.items())
    out = jobs.score_transfer(target, parent, head)
    assert "frozen" not in out.columns and out.where("prediction IS NULL").count() == 0


def test_pretrain_save_and_transfer(spark, tmp_path):
    from broadloom.sources.generate import gen_classification, gen_regression
    shape = [F.col("f").alias("input_3"), "input_1", "input_2", "output", "id"]
    classes = gen_classification(spark.range(320), 6).select(*shape, F.col("d").alias("decoder_4"))
    target = gen_regression(spark.range(320), 6).select(*shape)
    parent, head = jobs.pretrain_and_transfer(spark, classes, target, "id", 6, str(tmp_path / "p"), encoder=(8, 4), top=(4,))
    out = jobs.save_predictions(jobs.score_transfer(target, parent, head), str(tmp_path / "scores"))
    assert out.count() == 320 and "prediction" in out.columns
    assert {r.layer for r in parent.param_table(spark).collect()} >= {"embed_1", "encoder_2", "norm", "output"}


def test_full_batches_only(spark, line):
    model = dense.DenseModel(net.regressor_spec("x", 2, "y", [3]), net.initial(net.regressor_spec("x", 2, "y", [3])))
    assert jobs.score_full_batches(line, model, "id", 300).count() == 3900
