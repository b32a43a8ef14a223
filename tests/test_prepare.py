import pytest
from pyspark.sql import functions as F

from broadloom.functions.mixing import PRIME, mix, mix_int
from broadloom.operators import features, prepare
from broadloom.session import materialize
from broadloom.sources import files, generate


def test_mix_agrees_with_driver_twin_and_never_collides(spark):
    df = spark.range(20000).select("id", mix("id", seed=5).alias("h"))
    rows = df.collect()
    assert all(r.h == mix_int(r.id, 5) for r in rows[:500])
    assert len({r.h for r in rows}) == len(rows)
    assert min(r.h for r in rows) >= 0 and max(r.h for r in rows) < PRIME


def test_mix_takes_negative_and_large_keys(spark):
    df = spark.createDataFrame([(-(2 ** 63),), (-1,), (2 ** 63 - 1,)], "k long")
    assert all(0 <= r.h < PRIME for r in df.select(mix("k", "k", seed=9).alias("h")).collect())


def test_split_is_a_partition_and_ignores_layout(spark):
    df = spark.range(6000)
    one = {r.id: r.split for r in prepare.with_split(df, ["id"], [0.8, 0.2]).collect()}
    two = {r.id: r.split for r in prepare.with_split(df.repartition(7), ["id"], [0.8, 0.2]).collect()}
    assert one == two
    a, b = prepare.hash_split(df, ["id"], [0.8, 0.2])
    ids = [r.id for r in a.collect()] + [r.id for r in b.collect()]
    assert sorted(ids) == list(range(6000))
    assert abs(a.count() / 6000 - 0.8) < 0.03


@pytest.mark.parametrize("rows,size", [(1000, 7), (1000, 1000), (5, 7), (0, 3)])
def test_batch_plan_drops_the_remainder(spark, rows, size):
    df = spark.range(rows).select((F.col("id") * 3 - 50).alias("k")).repartition(5)
    got = sorted((r.k, r.row_index, r.batch) for r in prepare.batch_plan(df, "k", size, buckets=16).collect())
    assert got == [(i * 3 - 50, i, i // size) for i in range(rows - rows % size)]


def test_running_totals_do_not_depend_on_buckets(spark):
    df = spark.range(500).select((F.pow(F.lit(1.1), F.col("id") % 97) * 1000 + F.col("id")).alias("o"),
                                 (F.col("id") % 11).alias("v"))
    rows = sorted((r.o, r.v) for r in df.collect())
    want, total = [], 0
    for o, v in rows:
        total += v
        want.append((o, total))
    for buckets in (2, 9, 300):
        out = prepare.with_running_totals(df, "o", {"t": F.col("v")}, buckets)
        assert sorted((r.o, r.t) for r in out.collect()) == want
        assert {r.t_all for r in out.collect()} == {total}


def test_steps_need_a_full_batch():
    assert prepare.steps_per_epoch(8000, 160) == 50
    with pytest.raises(ValueError):
        prepare.steps_per_epoch(31, 32)


def test_null_rows_and_all_null_row(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (None, 2.0, "a"), (1, None, "a"), (None, None, None)],
                               "a int, b double, c string")
    assert prepare.drop_null_rows(df).count() == 1
    assert prepare.drop_null_rows(df, ["b"]).count() == 2


def test_csv_sink_refuses_to_overwrite_unless_told(spark, tmp_path):
    df = generate.gen_dense_int(spark.range(50), 4)
    wide = generate.widen(df, {"f": ("f", 4)}, ["id", "label"]).drop("id")
    path = str(tmp_path / "csv")
    files.write_csv(wide, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_csv(wide, path)
    back = files.read_csv_schema(spark, path, files.wide_int_schema(4))
    assert back.columns == ["f-0", "f-1", "f-2", "f-3", "label"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))
    files.write_csv(wide, path, header=True, overwrite=True)
    assert sorted(map(tuple, files.read_csv_inferred(spark, path).collect())) == sorted(map(tuple, wide.collect()))


def test_fixed_schema_rejects_a_bad_field(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([("1", "x")], "a string, b string").write.csv(path)
    with pytest.raises(Exception):
        files.read_csv_schema(spark, path, "a int, b int").collect()


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.array(F.col("id").cast("double")).alias("x"))
    back = materialize(df, "t")
    assert back.schema == df.schema or back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert "LogicalRDD" not in back._jdf.queryExecution().logical().toString()


# --- generators ---------------------------------------------------------------------------------


def test_generators_stay_in_range_and_ignore_layout(spark):
    ids = spark.range(400)
    rows = generate.gen_classification(ids, 5, seed=3).orderBy("id").collect()
    assert rows == generate.gen_classification(ids.repartition(7), 5, seed=3).orderBy("id").collect()
    assert all(0 <= v < 1 for r in rows for v in [*r.f, *r.d])
    assert {r.output for r in rows} == {0, 1} and {r.input_1 for r in rows} == set(range(5))
    ints = generate.gen_multitask_int(ids, 5).collect()
    assert {v for r in ints for v in r.f} <= set(range(101)) and max(v for r in ints for v in r.f) > 90
    assert all(100 <= r.output < 200 for r in generate.gen_regression(ids, 3).collect())
    assert rows != generate.gen_classification(ids, 5, seed=4).orderBy("id").collect()


def test_columns_of_a_row_are_not_copies(spark):
    row = generate.gen_sequence_flat(spark.range(1), 128).first()
    assert len(set(row.f)) > 120


def test_block_sparse_zeros(spark):
    drawn = set(generate.sparse_columns(20, 9, seed=1))
    assert len(drawn) == 9
    for r in generate.gen_block_sparse(spark.range(60), 20, 9, seed=1).collect():
        for j, v in enumerate(r.f):
            if j in drawn and r.id % 3:
                assert v == 0.0
        assert r.id % 3 or sum(v == 0.0 for v in r.f) < 3


def test_sequence_vectors_shape(spark):
    row = generate.gen_sequence_vectors(spark.range(3), 200).first()
    assert len(row) == 13 and all(len(row[c]) == 200 for c in generate.SEQUENCE_COLUMNS)
    assert row.label_per_client in (0.0, 1.0)


# --- features -----------------------------------------------------------------------------------


def test_scale_gives_zero_mean_unit_deviation_and_zero_for_a_constant(spark):
    df = features.assemble(spark.range(100).select(F.col("id").cast("double").alias("a"), F.lit(4.0).alias("b")),
                           ["a", "b"])
    rows = [r.scaled_features for r in features.standard_scale(df).collect()]
    a = [v[0] for v in rows]
    assert abs(sum(a)) < 1e-9 and abs(sum(x * x for x in a) / 99 - 1) < 1e-9
    assert all(v[1] == 0.0 for v in rows)


def test_assembler_modes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert features.assemble(df, ["a", "b"], invalid="skip").count() == 1
    kept = [r.features[0] for r in features.assemble(df, ["a", "b"], invalid="keep").collect()]
    assert any(x != x for x in kept)
    with pytest.raises(Exception):
        features.assemble(df, ["a", "b"]).collect()


def test_index_order_and_unseen_category(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "s string")
    got = {r.s: r.i for r in features.string_index(df, ["s"], ["i"]).collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0}
    with pytest.raises(Exception):
        features.string_index(df, ["s"], ["i"], fit_on=df.where("s = 'b'")).collect()


@pytest.mark.parametrize("limit", [20000, 3])
def test_index_by_join_agrees_with_the_indexer(spark, monkeypatch, limit):
    """Ties, a value that holds half of all rows, a null, and both kinds of join."""
    monkeypatch.setattr(features, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(features.bounded, "__defaults__", (limit, *features.bounded.__defaults__[1:]))
    df = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 83).cast("string"))).alias("s"))
    want = sorted((r.s, r.i) for r in features.string_index(df, ["s"], ["i"]).collect())
    got = features.string_index_join(df.repartition(5), "s", "i")
    assert sorted((r.s, r.i) for r in got.collect()) == want
    extra = df.union(spark.createDataFrame([(None,), ("new",)], "s string"))
    out = features.string_index_join(extra, "s", "i", fit_on=df)
    assert out.count() == 602 and out.where("i IS NULL").count() == 2


def test_lookup_by_broadcast_and_by_shuffle_agree_on_a_hot_id(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("c"))
    table = spark.range(40).select("id", F.array(F.col("id") * 1.5).alias("vector"))
    a = sorted(map(str, features.lookup(df, "c", table, "e", small=True).collect()))
    b = sorted(map(str, features.lookup(df, "c", table, "e", small=False).collect()))
    assert a == b and len(a) == 900
    assert features.lookup(df, "c", table, "e").where("e IS NULL AND c < 40").count() == 0
    assert features.lookup(df, "c", table, "e").where("e IS NOT NULL AND c >= 40").count() == 0
    assert features.bounded(table, 40) and not features.bounded(table, 39)
    wide = spark.range(40).select("id", F.array_repeat(F.lit(0.5), 1000).alias("vector"))
    assert features.bounded(wide, vector="vector") and not features.bounded(wide, vector="vector", most=40 * 8000)


def test_null_keys_are_kept(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), "id")
    pieces = prepare.hash_split(df, ["k"], [0.75, 0.25])
    assert sum(p.count() for p in pieces) == 1000
    plan = prepare.batch_plan(df, "k", 100, buckets=8).collect()
    assert sorted(r.row_index for r in plan) == list(range(1000))
    assert {r.row_index for r in plan if r.k is None} == set(range(900, 1000))


def test_split_join_spreads_a_key_that_holds_half_of_the_rows(spark):
    table = spark.range(30000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    rows = spark.range(0, 40000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 77).otherwise(F.col("id") % 50000).alias("k"))
    assert features.frequent_hashes(rows, ["k"]) == [rows.where("k = 77").select(F.xxhash64("k")).first()[0]]
    found = features.split_join(rows, table, ["k"])
    assert found.columns == ["id", "k", "v"]
    assert found.count() == 40000 and found.where("k < 30000 AND v <> 3 * k OR k >= 30000 AND v IS NOT NULL").isEmpty()
    loads = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().where("count > 0").collect()]
    assert max(loads) <= 2 * sorted(loads)[len(loads) // 2]


@pytest.mark.parametrize("small", [True, False])
def test_split_join_of_null_keys(spark, small):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "i int, k string")
    table = spark.createDataFrame([(None, 10), ("a", 20)], "k string, v int")
    safe = features.split_join(rows, table, ["k"], null_safe=True, small=small)
    assert sorted((r.i, r.v) for r in safe.collect()) == [(1, 10), (2, 20), (3, 10), (4, None)]
    plain = features.split_join(rows, table, ["k"], small=small)
    assert sorted((r.i, r.v) for r in plain.where("v IS NOT NULL").collect()) == [(2, 20)]
    assert features.split_join(rows.limit(0), table, ["k"], "inner", small=small).count() == 0


def test_prepared_by_join_equals_prepared_by_list(spark):
    from broadloom.plans import jobs

    rows = [(i, ["a", "b", "c"][i * i % 3], float(i % 11), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, v double, y int")
    listed, joined = (jobs.prepared(df, "y", ["c"], ["v"], ["id"], join_index=j) for j in (False, True))
    for a, b in zip(listed, joined):
        assert sorted(map(str, a.select("id", "scaled_features").collect())) == sorted(map(str, b.select("id", "scaled_features").collect()))
    unseen = df.withColumn("c", F.when(F.col("id") % 100 == 7, F.concat(F.lit("new"), "id")).otherwise(F.col("c")))
    with pytest.raises(Exception):
        [d.collect() for d in jobs.prepared(unseen, "y", ["c"], ["v"], ["id"], join_index=True)]


def test_spread_follows_the_rows_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(prepare, "SPREAD_ROWS", 100)
    table = spark.range(0, 5050, 1, 1)
    moved = prepare.spread(table)
    assert moved.rdd.getNumPartitions() == max(51, spark.sparkContext.defaultParallelism)
    assert max(len(p) for p in moved.rdd.glom().collect()) <= 200
    assert sorted(r.id for r in moved.collect()) == list(range(5050))
    assert prepare.spread(moved.limit(50).repartition(64)).rdd.getNumPartitions() == 64


def test_cells_are_made_in_batches_and_follow_the_formula(spark, monkeypatch):
    from broadloom.functions.mixing import CELL_STEP, PRIME, mix_int

    monkeypatch.setattr(generate, "BATCH_CELLS", 50)
    rows = generate.gen_sequence_vectors(spark.range(0, 30, 1, 1), 4, seed=3).orderBy("id").collect()
    assert len(rows) == 30
    for r in rows:
        for i, c in enumerate(generate.SEQUENCE_COLUMNS):
            cells = [((mix_int(r.id, 3) + j * CELL_STEP) % PRIME) ** 2 % PRIME for j in range(i * 4, i * 4 + 4)]
            assert r[c] == [v % 1000000 / 1e6 for v in cells]


def test_sequence_query_sums_all_two_hundred_steps(spark, tmp_path):
    from broadloom.functions.mixing import CELL_STEP, PRIME, mix_int
    from broadloom.plans.queries import QUERIES

    spark.range(0, 40, 1, 2).select((F.col("id") * 7 - 50).alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    rows = QUERIES["gen_sequence_vectors"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows) == [i * 7 - 50 for i in range(40)]
    for r in rows:
        base = mix_int(r.id, 13)
        cells = [((base + j * CELL_STEP) % PRIME) ** 2 % PRIME for j in range(200 * len(generate.SEQUENCE_COLUMNS) + 1)]
        for i, c in enumerate(generate.SEQUENCE_COLUMNS):
            own = [v % 1000000 / 1e6 for v in cells[200 * i:200 * i + 200]]
            assert (r[f"{c}_sum"], r[f"{c}_first"], r[f"{c}_last"]) == (round(sum(own), 6), own[0], own[-1])
        assert r.label_per_client == cells[-1] % 2
