import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadloom.operators import sequences

LENGTH = 6


@pytest.fixture(scope="module")
def rows():
    """Forty users; one of them holds half of all rows; times tie."""
    rng = random.Random(1)
    out = []
    for i in range(1200):
        user = 7 if rng.random() < 0.5 else rng.randrange(40)
        out.append((i, user, rng.randrange(30), float(rng.randrange(100))))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user int, ts int, value double").repartition(6).cache()


def history(rows):
    users = {}
    for e, u, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        users.setdefault(u, []).append(v)
    return {u: v[-LENGTH:] for u, v in users.items()}


@pytest.mark.parametrize("salts", [1, 16])
def test_pad_against_brute_force(df, rows, salts):
    out = sequences.sequence_pad(df, "user", ["ts", "event_id"], ["value"], LENGTH, pad=-1.0, salts=salts)
    got = {r.user: (r.n_steps, r.value) for r in out.collect()}
    want = {u: (len(v), [-1.0] * (LENGTH - len(v)) + v) for u, v in history(rows).items()}
    assert got == want


def test_pooling_plain_and_masked(df, rows):
    pad = sequences.sequence_pad(df.where("user < 7 OR event_id < 40"), "user", ["ts", "event_id"], ["value"], 50)
    plain = {r.user: r.pooled for r in sequences.sequence_pool(pad, ["value"], ["user"]).collect()}
    masked = {r.user: r.pooled for r in sequences.sequence_pool(pad, ["value"], ["user"], n_steps="n_steps").collect()}
    for r in pad.collect():
        real = r.value[50 - r.n_steps:]
        assert plain[r.user] == pytest.approx([max(r.value), sum(r.value) / 50])
        assert masked[r.user] == pytest.approx([max(real), sum(real) / len(real)])


def test_masked_maximum_leaves_padding_out(spark):
    pad = spark.createDataFrame([(1, 2, [0.0, 0.0, -3.0, -5.0])], "user int, n_steps int, v array<double>")
    got = sequences.sequence_pool(pad, ["v"], ["user"], n_steps="n_steps").first().pooled
    assert got == [-3.0, -4.0]


def test_step_embedding_and_pool(spark, df):
    pad = sequences.sequence_pad(df.withColumn("c", F.col("value") % 5), "user", ["ts", "event_id"], ["value", "c"],
                                 LENGTH)
    table = spark.range(5).select("id", F.array(F.col("id") * 2.0, -F.col("id") * 1.0).alias("vector"))
    steps = sequences.sequence_embed(pad, "user", {"c": table}, ["value"])
    assert steps.count() == pad.count() * LENGTH
    pooled = {r.user: r.pooled for r in sequences.pool_steps(steps, "user").collect()}
    for r in pad.collect():
        m = [[c * 2.0, -c, v] for c, v in zip(r.c, r.value)]
        want = [max(x) for x in zip(*m)] + [sum(x) / LENGTH for x in zip(*m)]
        assert pooled[r.user] == pytest.approx(want)


def test_packed_steps_pool_to_the_same(spark, df):
    """Wide vectors go as bytes; batches cut users, two users' rows lie apart, a null key is a key."""
    pad = sequences.sequence_pad(df.withColumn("c", F.col("value") % 5).withColumn("user", F.nullif("user", F.lit(3))), "user", ["ts", "event_id"],
                                 ["value", "c"], LENGTH)
    table = spark.range(5).select("id", F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(40)]).alias("vector"))
    plain, packed = (sequences.sequence_embed(pad, "user", {"c": table}, ["value"], packed=p).repartition(3, "step") for p in (False, True))
    want = {r.user: r.s for r in plain.groupBy("user").agg(F.collect_list("step_vector").alias("s")).collect()}
    for steps in (plain, packed):
        found = {r.user: r.pooled for r in sequences.pool_steps(steps, "user").collect()}
        assert found.keys() == want.keys() and None in want
        for user, rows in want.items():
            assert found[user] == pytest.approx([max(x) for x in zip(*rows)] + [sum(x) / LENGTH for x in zip(*rows)], abs=1e-12)


def test_pooled_steps_are_few_where_they_are_aggregated(spark, df):
    """The aggregate gets what runs of steps give, not every step."""
    pad = sequences.sequence_pad(df, "user", ["ts", "event_id"], ["value"], 50).withColumn("c", F.col("value"))
    table = spark.range(100).select("id", F.array(F.col("id") * 1.0).alias("vector"))
    steps = sequences.sequence_embed(pad, "user", {"c": table}, ["value"], packed=True)
    runs = steps.select(F.col("user").alias("_key"), "step_vector").mapInArrow(
        sequences._pooled_runs, "_key int, most array<double>, mean array<double>, n long").collect()
    assert sum(r.n for r in runs) == pad.count() * 50 and len(runs) < 3 * pad.count()


@pytest.mark.parametrize("packed", [False, True])
def test_an_id_without_a_vector_is_an_error(spark, packed):
    rows = spark.createDataFrame([(1, [0.0, 9.0], [1.0, 2.0])], "user int, c array<double>, v array<double>")
    table = spark.range(5).select("id", F.array(F.col("id") * 1.0).alias("vector"))
    with pytest.raises(Exception, match="step vector"):
        sequences.pool_steps(sequences.sequence_embed(rows, "user", {"c": table}, ["v"], packed=packed), "user").collect()


def test_long_runs_are_pooled_like_short_ones():
    x = np.random.default_rng(0).normal(size=(300, 70))
    x[5, 3], x[:100, 4] = np.nan, np.nan
    starts = np.array([0, 100, 101])
    for pool in (np.fmax, np.add):
        assert np.allclose(sequences._reduced(pool, x, starts), pool.reduceat(x, starts), equal_nan=True)
        assert np.allclose(sequences._reduced(pool, x[:, :2], starts), pool.reduceat(x[:, :2], starts), equal_nan=True)
