"""Registered queries: one per operator, each over whole tables. (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.functions import arrays, metrics
from broadloom.functions.schedule import piecewise_lr
from broadloom.operators import boosting, dense, features, prepare, report, search, sequences, sparseboost, sync, trees, treesql
from broadloom.operators import manyboost, quantiles
from broadloom.operators import network as net
from broadloom.plans import fixed, jobs
from broadloom.session import load_table, scratch_path
from broadloom.sources import files, generate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def returned() -> Column:
    return (F.col("l_returnflag") == "R").cast("int").alias("y")


def r6(c: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def r9(c: Column) -> Column:
    return F.round(c, 9) + F.lit(0.0)


def items(column: str, n: int, prefix: str = "v", fn: Callable[[Column], Column] = lambda c: c) -> list[Column]:
    return [fn(F.get(F.col(column), F.lit(i))).alias(f"{prefix}{i}") for i in range(n)]


def one_row(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) for c in df.columns])


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "lineitem")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "orders")


def ids(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.spread(orders(spark, sf).select(F.col("o_orderkey").alias("id")))


def with_gaps(df: DataFrame) -> DataFrame:
    return df.withColumn("l_discount", F.nullif(F.col("l_discount"), F.lit(0.0)))


# --- sources, sinks, generators -----------------------------------------------------------------


@query
def csv_inferred_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
                    path, header=True, overwrite=True)
    back = files.read_csv_inferred(spark, path)
    return back.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query
def csv_schema_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(lines(spark, sf).select(*LINE_KEYS[:2], *NUMERIC, returned()), path)
    return files.read_csv_schema(
        spark, path, "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, label int")


@query
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    files.write_parquet(load_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path)
    return files.read_saved(spark, path)


@query
def gen_classification(spark, sf):
    df = generate.gen_classification(ids(spark, sf), 8, seed=7)
    return generate.widen(df, {"f": ("f", 8), "d": ("d", 8)}, ["id", "output", "input_1", "input_2"])


@query
def gen_multitask_int(spark, sf):
    df = generate.gen_multitask_int(ids(spark, sf), 8, seed=8)
    return generate.widen(df, {"f": ("f", 8), "d": ("d", 8)}, ["id", "output", "input_1", "input_2"])


@query
def gen_dense_int(spark, sf):
    return generate.widen(generate.gen_dense_int(ids(spark, sf), 8, seed=9), {"f": ("f", 8)}, ["id", "label"])


@query
def gen_block_sparse(spark, sf):
    df = generate.gen_block_sparse(ids(spark, sf), 8, 4, seed=10)
    return generate.widen(df, {"f": ("f", 8)}, ["id", "output"])


@query
def gen_regression(spark, sf):
    df = generate.gen_regression(ids(spark, sf), 8, seed=11)
    df = df.withColumn("output", r6("output"))
    return generate.widen(df, {"f": ("f", 8)}, ["id", "output", "input_1", "input_2"])


@query
def gen_sequence_flat(spark, sf):
    df = generate.gen_sequence_flat(ids(spark, sf), 16, seed=12)
    return generate.widen(df, {"f": ("f", 16)}, ["id", "output"])


@query
def gen_sequence_vectors(spark, sf):
    """Every sequence of every row, as its sum and its two ends."""
    steps = 200
    df = generate.gen_sequence_vectors(ids(spark, sf), steps, seed=13)
    out = [F.col("id"), F.col("label_per_client")]
    for c in generate.SEQUENCE_COLUMNS:
        total = F.aggregate(F.col(c), F.lit(0.0), lambda s, v: s + v)
        out += [r6(total).alias(f"{c}_sum"), F.get(F.col(c), F.lit(0)).alias(f"{c}_first"),
                F.get(F.col(c), F.lit(steps - 1)).alias(f"{c}_last")]
    return df.select(*out)


# --- projection, cleaning, layout ---------------------------------------------------------------


@query
def project_columns(spark, sf):
    return lines(spark, sf).select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")


@query
def positional_slice(spark, sf):
    df = lines(spark, sf)
    return df.select(*prepare.positional(df, 4, 8))


@query
def drop_column(spark, sf):
    return orders(spark, sf).drop("o_orderdate")


@query
def rename_label(spark, sf):
    return orders(spark, sf).select("o_orderkey", "o_totalprice").withColumnRenamed("o_totalprice", "label")


@query
def drop_null_rows(spark, sf):
    return prepare.drop_null_rows(with_gaps(lines(spark, sf).select("l_orderkey", *NUMERIC, "l_linestatus")))


@query
def repartition_counts(spark, sf):
    """Ten partitions, no row lost, sizes within one row per input task of each other."""
    per = lines(spark, sf).select("l_orderkey").repartition(10).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"))
    return per.agg(F.count("*").alias("partitions"), F.sum("n").alias("n_rows"),
                   (F.max("n") - F.min("n") <= F.sum("n") * 0.1).alias("even"))


@query
def row_count(spark, sf):
    return lines(spark, sf).agg(F.count("*").alias("n_rows"))


@query
def preview_rows(spark, sf):
    return prepare.preview(orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority"), ["o_orderkey"])


@query
def random_split_partition(spark, sf):
    """Pieces are disjoint, cover the table and come near the weights."""
    train, test = orders(spark, sf).select("o_orderkey").randomSplit([0.8, 0.2], 24)
    both = train.withColumn("train", F.lit(1)).union(test.withColumn("train", F.lit(0)))
    per = both.groupBy("o_orderkey").agg(F.count("*").alias("copies"), F.sum("train").alias("train"))
    return per.agg(F.count("*").alias("n_rows"), F.max("copies").alias("max_copies"),
                   (F.abs(F.avg("train") - 0.8) < 0.03).alias("near_weight"))


@query
def hash_split(spark, sf):
    df = orders(spark, sf).select("o_orderkey", "o_custkey")
    return prepare.with_split(df, ["o_orderkey", "o_custkey"], [0.7, 0.2, 0.1], seed=24, out="piece")


@query
def hash_split_nulls(spark, sf):
    """One key in fifty is null; its rows have a piece like any other."""
    df = orders(spark, sf).select("o_orderkey", F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("k"))
    return prepare.with_split(df, ["o_orderkey", "k"], [0.7, 0.2, 0.1], seed=24, out="piece")


# --- features -----------------------------------------------------------------------------------


@query
def string_index(spark, sf):
    df = orders(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return features.string_index(df, ["o_orderpriority", "o_orderstatus"], ["priority_index", "status_index"])


@query
def string_index_join(spark, sf):
    """Part numbers as categories: many values, many equal frequencies."""
    df = lines(spark, sf).select("l_orderkey", F.col("l_partkey").cast("string").alias("part"))
    return features.string_index_join(df, "part", "part_index")


@query
def assemble_vector(spark, sf):
    df = features.assemble(lines(spark, sf), NUMERIC)
    return df.select("l_orderkey", vector_to_array("features").alias("a")).select("l_orderkey", *items("a", 4))


@query
def assemble_keep_nan(spark, sf):
    df = features.assemble(with_gaps(lines(spark, sf)), NUMERIC, invalid="keep")
    return df.select("l_orderkey", vector_to_array("features").alias("a")).select(
        "l_orderkey", *items("a", 4, fn=lambda c: F.nullif(c, F.lit(float("nan")))))


@query
def standard_scale(spark, sf):
    """Moments from the training rows, applied to every row."""
    df = features.assemble(lines(spark, sf).select("l_orderkey", *NUMERIC), NUMERIC)
    train, _ = prepare.hash_split(df, ["l_orderkey"], [0.8, 0.2], seed=24)
    df = features.standard_scale(df, fit_on=train)
    return df.select("l_orderkey", vector_to_array("scaled_features").alias("a")).select(
        "l_orderkey", *items("a", 4, fn=r6))


@query
def densify_vector(spark, sf):
    zeros = [F.lit(0.0).alias(f"z{i}") for i in range(6)]  # mostly zeros, so that rows come out sparse
    names = ["l_discount", "l_tax", *[f"z{i}" for i in range(6)]]
    df = features.assemble(lines(spark, sf).select("l_orderkey", "l_discount", "l_tax", *zeros), names)
    df = df.withColumn("features", features.densify("features"))
    kind = F.get_json_object(F.to_json(F.struct(F.col("features").cast("string").alias("t"))), "$.t")
    return df.select("l_orderkey", vector_to_array("features").alias("a"),
                     (~kind.startswith("(")).alias("is_dense")).select("l_orderkey", "is_dense", *items("a", 8))


def nation_table(spark, sf, d: int = 4) -> DataFrame:
    """Embedding table with one row per nation."""
    vector = [((F.col("n_nationkey") * 5 + 3 * i) % 7 - 3) / F.lit(4.0) for i in range(d)]
    return load_table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.array(*vector).alias("vector"))


@query
def embedding_lookup(spark, sf):
    df = load_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return features.lookup(df, "c_nationkey", nation_table(spark, sf), "e").select("c_custkey", *items("e", 4))


@query
def concat_features(spark, sf):
    df = load_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    df = features.lookup(df, "c_nationkey", nation_table(spark, sf), "e")
    df = df.select("c_custkey", features.concat_features("e", F.array("c_acctbal"), "e").alias("a"))
    return df.select("c_custkey", *items("a", 9))


def event_types() -> Column:
    """1-based number of the event type; 0 is left for padding."""
    return F.array_position(F.lit(fixed.EVENT_TYPES), F.col("event_type"))


def histories(spark, sf) -> DataFrame:
    df = load_table(spark, sf, "events").select(
        "user_id", "ts", "event_id", "value", event_types().alias("kind"), (F.hour("ts") + 1).alias("hour"))
    return sequences.sequence_pad(df, "user_id", ["ts", "event_id"], ["value", "kind", "hour"], fixed.HISTORY)


@query
def sequence_pad(spark, sf):
    return histories(spark, sf).select(
        "user_id", "n_steps", F.posexplode(F.arrays_zip("value", "kind")).alias("step", "s")).select(
        "user_id", "n_steps", "step", "s.value", "s.kind")


@query
def sequence_pool(spark, sf):
    df = histories(spark, sf)
    df = sequences.sequence_pool(df, ["value", "kind"], ["user_id", "value", "n_steps"], "p")
    df = sequences.sequence_pool(df, ["value"], ["user_id", "p"], "m", n_steps="n_steps")
    return df.select("user_id", *items("p", 4, "pooled", r9), *items("m", 2, "masked", r9))


def step_rows(spark, sf) -> DataFrame:
    def table(rows: int, d: int) -> DataFrame:
        return spark.range(rows).select("id", F.array(
            *[((F.col("id") * 5 + 3 * i) % 7 - 3) / F.lit(4.0) for i in range(d)]).alias("vector"))

    return sequences.sequence_embed(histories(spark, sf), "user_id", {"kind": table(6, 3), "hour": table(25, 4)},
                                    ["value"])


@query
def sequence_embed(spark, sf):
    return step_rows(spark, sf).select("user_id", "step", *items("step_vector", 8))


@query
def sequence_embed_pool(spark, sf):
    return sequences.pool_steps(step_rows(spark, sf), "user_id").select("user_id", *items("pooled", 16, fn=r9))


@query
def sequence_embed_wide(spark, sf):
    """Six categorical sequences of 200 steps, embedded up to 600 wide and pooled; one row per user and place of the vector."""
    events = load_table(spark, sf, "events").select(
        "user_id", "ts", "event_id", "value", event_types().alias("kind"), (F.hour("ts") + 1).alias("hour"), F.dayofweek("ts").alias("weekday"),
        F.dayofmonth("ts").alias("day"), (F.minute("ts") + 1).alias("minute"), (F.col("event_id") % 499 + 1).alias("slot"))
    steps = sequences.sequence_pad(events, "user_id", ["ts", "event_id"], ["value", *fixed.WIDE_EMBEDDINGS], fixed.WIDE_HISTORY)
    tables = {c: spark.range(rows).select("id", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: ((F.col("id") * 5 + i * 3) % 7 - 3) / F.lit(4.0))
                                          .alias("vector")) for c, (rows, width) in fixed.WIDE_EMBEDDINGS.items()}
    pooled = sequences.pool_steps(sequences.sequence_embed(steps, "user_id", tables, ["value"], packed=True), "user_id")
    width = sum(w for _, w in fixed.WIDE_EMBEDDINGS.values()) + 1
    halves = F.arrays_zip(F.slice("pooled", 1, width).alias("most"), F.slice("pooled", width + 1, width).alias("mean"))
    return pooled.select("user_id", F.posexplode(halves).alias("position", "_p")).select(
        "user_id", "position", r9("_p.most").alias("most"), r9("_p.mean").alias("mean"))


# --- learners: tables and steps -----------------------------------------------------------------


def boost_rows(spark, sf) -> DataFrame:
    return prepare.spread(lines(spark, sf)).select(
        "l_orderkey", (F.col("l_extendedprice") / 1e3).alias("price"), *fixed.BOOST_FEATURES, returned(),
        features.pack(fixed.BOOST_FEATURES).alias("x"))


def boost_model(spark, sf, label: str, options: dict) -> boosting.BoostModel:
    return boosting.fit_hist_boost(boost_rows(spark, sf), "x", label, edges=fixed.BOOST_EDGES, refresh=2, **options)


def node_rows(spark, model) -> DataFrame:
    return model.node_table(spark).select("tree", "node", "feature", "bin",
                                          (F.round("gain", 4) + F.lit(0.0)).alias("gain"), r6("leaf").alias("leaf"))


@query
def boost_stump_rounds(spark, sf):
    return node_rows(spark, boost_model(spark, sf, "y", fixed.CLASSIFY))


@query
def boost_reg_rounds(spark, sf):
    return node_rows(spark, boost_model(spark, sf, "price", fixed.REGRESS))


@query
def boost_score(spark, sf):
    scored = boosting.score_hist_boost(boost_rows(spark, sf), boost_model(spark, sf, "y", fixed.CLASSIFY), "x")
    return scored.select("l_orderkey", "l_quantity", r6("margin").alias("margin"),
                         r6("probability").alias("probability"), "prediction")


@query
def weighted_quantiles(spark, sf):
    """Cut points of three features into 16 parts of equal weight, rows with label 1 counting twice."""
    found = quantiles.weighted_edges(boost_rows(spark, sf), "x", boosting.class_weight("y"), 16)
    rows = [(f, i, e) for f, edges in enumerate(found) for i, e in enumerate(edges)]  # at most 15 a feature
    return spark.createDataFrame(rows, "feature int, position int, edge double").withColumn("edge", r6("edge"))


@query
def boost_sketch_rounds(spark, sf):
    """Boosting whose cut points come from the weighted summaries: every distinct value of these features but the least."""
    model = boosting.fit_hist_boost(boost_rows(spark, sf), "x", "y", **fixed.CLASSIFY)
    return model.node_table(spark).select("tree", "node", "feature", r6("threshold").alias("threshold"), F.round("gain", 4).alias("gain"), r6("leaf").alias("leaf"))


@query
def boost_sparse_rounds(spark, sf):
    """Two of three features are zero in two thirds of the rows; stored and summed are the other cells only."""
    on = F.col("l_orderkey") % 3 == 0
    rows = boost_rows(spark, sf).withColumn("x", F.transform("x", lambda v, i: F.when(on | (i == 0), v).otherwise(F.lit(0.0))))
    return node_rows(spark, sparseboost.fit_sparse_boost(rows, "x", "y", edges=fixed.BOOST_EDGES, refresh=2, **fixed.CLASSIFY))


@query
def boost_score_sql(spark, sf):
    """The model as one SQL expression: no Python in the scoring tasks."""
    model = treesql.of_hist(boost_model(spark, sf, "y", fixed.CLASSIFY))
    scored = treesql.with_classes(treesql.score_sql(boost_rows(spark, sf), model, "x"))
    return scored.select("l_orderkey", "l_quantity", r6("margin").alias("margin"), r6("probability").alias("probability"), "prediction")


@query
def feature_importance(spark, sf):
    found = boosting.boost_importances(boost_model(spark, sf, "y", fixed.CLASSIFY).node_table(spark))
    return found.select("feature", r6("gain").alias("gain"), r6("importance").alias("importance"))


@query
def boost_split_counts(spark, sf):
    return boosting.boost_split_counts(boost_model(spark, sf, "y", fixed.CLASSIFY).node_table(spark))


@query
def best_split(spark, sf):
    """Two nodes (by line status), three features, gradients at margin 0."""
    y = returned()
    g, h = boosting.gradient(y, F.lit(0.0), boosting.class_weight(y), "binary:logistic")
    df = lines(spark, sf).select(
        (F.col("l_linestatus") == "O").cast("int").alias("node"), g.alias("g"), h.alias("h"),
        F.expr("stack(3, 0, l_quantity, 1, round(l_discount * 100), 2, round(l_tax * 100)) AS (feature, bin)"))
    hist = df.groupBy("node", "feature", F.col("bin").cast("int").alias("bin")).agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"))
    found = boosting.best_split(hist, 1.0, 0.1, 30.0)
    return found.select("node", "feature", "bin", *[r6(c).alias(c) for c in ("gain", "gl", "hl", "g", "h")])


@query
def class_weight(spark, sf):
    return lines(spark, sf).select("l_orderkey", returned()).withColumn("weight", boosting.class_weight("y", 2.0))


@query
def batch_plan(spark, sf):
    return prepare.batch_plan(orders(spark, sf).select("o_orderkey", "o_totalprice"), "o_orderkey", 160)


@query
def batch_plan_nulls(spark, sf):
    """Orders without a key come last: batches and the rows they hold."""
    df = orders(spark, sf).select(F.when(F.col("o_custkey") % 50 != 0, F.col("o_orderkey")).alias("k"))
    plan = prepare.batch_plan(df, "k", 160)
    return plan.groupBy("batch").agg(F.count("*").alias("n_rows"), F.count("k").alias("n_keys"), F.min("row_index").alias("first"))


def stepped_rates(spark, sf) -> DataFrame:
    plan = prepare.batch_plan(orders(spark, sf).select("o_orderkey"), "o_orderkey", 160)
    return plan.select("o_orderkey", "batch", piecewise_lr("batch", [20, 40, 60], [1e-3, 1e-2, 1e-4, 1e-3]).alias("rate"))


QUERIES["piecewise_lr"] = stepped_rates


def small_net() -> net.DenseSpec:
    return net.classifier_spec("x", 3, "y", [2])


def small_rows(spark, sf) -> DataFrame:
    x = F.array(F.log(F.col("l_quantity") + 1) / 4.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0)
    return lines(spark, sf).select(*LINE_KEYS, x.alias("x"), returned())


@query
def gradient_step(spark, sf):
    """Mean gradient of every parameter of a fixed two-layer net over all rows."""
    found = dense.batch_gradient(small_rows(spark, sf), fixed.fixed_model(small_net()))
    return found.select("name", F.col("position").cast("bigint").alias("position"), F.round("value", 7).alias("value"))


@query
def adam_steps(spark, sf):
    """Parameters after two synchronous Adam steps from fixed weights, over all rows."""
    model = dense.fit_full_batch(small_rows(spark, sf), small_net(), epochs=2, rate=0.01,
                                 init=fixed.fixed_model(small_net()))
    return model.param_table(spark).select(
        F.concat_ws("/", "layer", "name").alias("name"), F.posexplode("values").alias("position", "value")).select(
        "name", F.col("position").cast("bigint").alias("position"), F.round("value", 7).alias("value"))


@query
def batch_norm_apply(spark, sf):
    """Normalise by fixed statistics, by an array expression over the vectors."""
    d = 64
    stats = [[(i % 7 - 3) / 10 for i in range(d)], [0.5 + i % 5 for i in range(d)], [1 + i % 3 for i in range(d)],
             [i % 4 - 1 for i in range(d)]]
    df = load_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    df = df.select("vec_id", arrays.batch_norm_apply(F.col("x"), *stats).alias("a"))
    return df.select("vec_id", F.posexplode("a").alias("pos", "v")).select("vec_id", "pos", r6("v").alias("v"))


# --- metrics ------------------------------------------------------------------------------------


def predictions(spark, sf) -> DataFrame:
    z = F.col("l_discount") * 10.0 - F.col("l_tax") * 5.0 - F.col("l_quantity") / 50.0
    return lines(spark, sf).select(returned(), "l_extendedprice", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("p"),
                                   (F.col("l_quantity") * 1500.0).alias("estimate"), "l_returnflag",
                                   F.array(F.col("l_discount") * 10.0 + 1.0, F.col("l_tax") * 10.0 + 1.0,
                                           F.col("l_quantity") / 50.0 + 1.0).alias("w"))


@query
def metric_bce(spark, sf):
    return one_row(metrics.metric_bce(predictions(spark, sf), "y", "p"))


@query
def metric_regression(spark, sf):
    found = metrics.metric_regression(predictions(spark, sf), "l_extendedprice", "estimate")
    return found.select(F.round("mse", 2).alias("mse"), r6("mae").alias("mae"), r6("rmse").alias("rmse"))


@query
def metric_classification(spark, sf):
    return one_row(metrics.metric_classification(predictions(spark, sf), "y", "p"))


@query
def metric_sparse_ce(spark, sf):
    total = F.aggregate(F.col("w"), F.lit(0.0), lambda s, v: s + v)
    df = predictions(spark, sf).select(
        (F.array_position(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("l_returnflag")) - 1).alias("label"),
        F.transform("w", lambda v: v / total).alias("probabilities"))
    return one_row(metrics.metric_sparse_ce(df, "label", "probabilities"))


@query
def metric_focal(spark, sf):
    return one_row(metrics.metric_focal(predictions(spark, sf), "y", "p"))


@query
def confusion_counts(spark, sf):
    return metrics.confusion_counts(predictions(spark, sf), "y", "p")


@query
def precision_recall(spark, sf):
    return one_row(metrics.precision_recall(predictions(spark, sf), "y", "p"))


@query
def metric_auc(spark, sf):
    """One score with mostly distinct values, one with many ties."""
    df = predictions(spark, sf)
    found = [metrics.metric_auc(df, "y", c).select(F.lit(c).alias("score"), r6("auc").alias("auc"))
             for c in ("l_extendedprice", "estimate")]
    return found[0].union(found[1])


def reconstructed(spark, sf) -> DataFrame:
    df = load_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return df.withColumn("out", F.transform("x", lambda v: v * 0.5 + 0.1))


@query
def reconstruction_error(spark, sf):
    return one_row(metrics.reconstruction_error(reconstructed(spark, sf), "x", "out"))


@query
def reconstruction_rows(spark, sf):
    df = metrics.reconstruction_rows(reconstructed(spark, sf), "x", "out")
    return df.select("vec_id", r6("reconstruction_error").alias("reconstruction_error"))


# --- scoring with fixed weights -----------------------------------------------------------------


def forward_net() -> net.DenseSpec:
    return net.regressor_spec("embedding", 64, "label", [4])


def embeddings(spark, sf) -> DataFrame:
    return load_table(spark, sf, "embeddings")


@query
def dense_forward(spark, sf):
    """A small net as array expressions, inside the JVM."""
    x = F.col("embedding").cast("array<double>")
    for units, given, activation in ((4, 64, "relu"), (2, 4, "linear")):
        x = arrays.dense_layer(x, [[fixed.weight(i, j) for i in range(given)] for j in range(units)],
                               [fixed.bias(j) for j in range(units)], activation)
    return embeddings(spark, sf).select("vec_id", x.alias("a")).select("vec_id", *items("a", 2, "y", r6))


@query
def score_append(spark, sf):
    """A net of the same shape scored in Arrow batches."""
    scored = dense.score_dense(embeddings(spark, sf), fixed.fixed_model(forward_net()))
    return scored.select("vec_id", "label", r6("prediction").alias("prediction"))


def two_heads(width: int = 64) -> net.DenseSpec:
    return net.multitask_spec(width, width, classes=2, vocab=(5, 3), embed=4, encoder=(8, 6), top=(5,),
                              ids=("input_1", "input_2"), vector="embedding", labels=("embedding", "output"))


def two_head_rows(spark, sf) -> DataFrame:
    return embeddings(spark, sf).select("vec_id", "embedding", (F.col("label") % 2).alias("output"),
                                        (F.col("vec_id") % 5).cast("int").alias("input_1"),
                                        (F.col("vec_id") % 3).cast("int").alias("input_2"))


@query
def score_multi_output(spark, sf):
    scored = dense.score_dense(two_head_rows(spark, sf), fixed.fixed_model(two_heads()))
    df = scored.select("vec_id", F.col("prediction.output").alias("c"), F.col("prediction.decoder_3").alias("r"))
    total = F.aggregate("r", F.lit(0.0), lambda s, v: s + v)
    return df.select("vec_id", *items("c", 2, "class", r6), *items("r", 64, "rebuilt", r6), r6(total).alias("rebuilt_sum"))


@query
def score_full_batches(spark, sf):
    scored = jobs.score_full_batches(embeddings(spark, sf), fixed.fixed_model(forward_net()), "vec_id", 160)
    return scored.select("vec_id", "batch", r6("prediction").alias("prediction"))


@query
def score_roundtrip(spark, sf):
    scored = dense.score_dense(embeddings(spark, sf), fixed.fixed_model(forward_net())).select("vec_id", "prediction")
    back = jobs.save_predictions(scored, scratch_path(spark, "predictions"))
    return back.select("vec_id", r6("prediction").alias("prediction"))


@query
def validation_metrics(spark, sf):
    """Loss of a fixed net on the validation piece of a keyed split."""
    _, valid = prepare.hash_split(small_rows(spark, sf), ["l_orderkey", "l_partkey"], [0.8, 0.2], seed=24)
    model = fixed.fixed_model(small_net())
    scored = dense.score_dense(valid, model)
    (loss,) = dense.head_losses(scored, model.spec)
    return scored.agg(F.count("*").alias("n_rows"), r6(F.avg(loss)).alias("val_output_bce"))


# --- fitted models ------------------------------------------------------------------------------


def assembled(spark, sf) -> DataFrame:
    return features.assemble(prepare.spread(lines(spark, sf).select(*LINE_KEYS, *NUMERIC, returned())), NUMERIC)


def confusion_by(scored: DataFrame, label: str) -> DataFrame:
    return scored.groupBy(label, "prediction").agg(F.count("*").alias("n_rows"))


@query
def mlp_classify(spark, sf):
    """Flagship: select, drop nulls, split, index, assemble, scale, fit, score, judge."""
    df = with_gaps(lines(spark, sf)).withColumn("label", returned())
    scored = jobs.classify_job(df, "label", ["l_linestatus"], NUMERIC, LINE_KEYS, rounds=20)
    return metrics.confusion_counts(scored, "label", "prediction").withColumn("n_rows", F.expr("tp + tn + fp + fn"))


@query
def gbt_classify(spark, sf):
    scored = jobs.boosted_job(lines(spark, sf).select(*LINE_KEYS, *NUMERIC, returned().alias("output")), "output",
                              NUMERIC, LINE_KEYS, scratch_path(spark, "gbt"), pos_weight=2.0)
    return confusion_by(scored, "label")


@query
def gbt_regress(spark, sf):
    df = lines(spark, sf).select(*LINE_KEYS, *NUMERIC, F.col("l_extendedprice").alias("output"))
    scored = jobs.boosted_job(df, "output", ["l_quantity", "l_discount", "l_tax"], LINE_KEYS,
                              scratch_path(spark, "gbt"), task="regress", rounds=3, depth=3, eta=0.5)
    return metrics.metric_regression(scored, "label", "prediction")


@query
def gbt_score(spark, sf):
    df = assembled(spark, sf)
    scored = trees.score_gbt(df, trees.fit_gbt(df, "features", "y", rounds=2, depth=3), "features")
    return scored.select("l_orderkey", vector_to_array("rawPrediction").alias("rawPrediction"),
                         vector_to_array("probability").alias("probability"), "prediction")


@query
def gbt_score_sql(spark, sf):
    """Spark ML trees as one SQL expression, compared with the model's own scores on every row."""
    df = assembled(spark, sf).withColumn("x", vector_to_array("features"))
    model = trees.fit_gbt(df, "features", "y", rounds=2, depth=3)
    scored = treesql.with_classes(treesql.score_sql(df, treesql.of_gbt(spark, model), "x"), 2.0)
    both = trees.score_gbt(scored.withColumnsRenamed({"probability": "p", "prediction": "said"}), model, "features")
    same = (F.abs(vector_to_array("probability")[1] - F.col("p")) < 1e-12) & (F.col("prediction") == F.col("said"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~same).alias("n_different"))


@query
def model_roundtrip(spark, sf):
    """A saved and loaded tree model gives equal scores on every row."""
    df = assembled(spark, sf)
    path = scratch_path(spark, "gbt")
    model = trees.fit_gbt(df, "features", "y", rounds=2, depth=3)
    trees.save_model(model, path)
    both = trees.score_gbt(df, model, "features").select("features", vector_to_array("probability").alias("p0"))
    both = trees.score_gbt(both, trees.load_gbt(path), "features")
    return both.agg(F.count("*").alias("n_rows"),
                    F.count_if(F.col("p0") != vector_to_array("probability")).alias("n_different"))


@query
def regressor_roundtrip(spark, sf):
    """A saved and loaded regression model gives equal predictions on every row."""
    df = assembled(spark, sf)
    path = scratch_path(spark, "gbt")
    model = trees.fit_gbt(df.withColumn("price", F.col("l_extendedprice") / 1e3), "features", "price", "regress", rounds=2, depth=3)
    trees.save_model(model, path)
    both = trees.score_gbt(df, model, "features").select("features", F.col("prediction").alias("p0"))
    both = trees.score_gbt(both, trees.load_gbt(path, "regress"), "features")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("p0") != F.col("prediction")).alias("n_different"))


@query
def feature_split_counts(spark, sf):
    df = assembled(spark, sf)
    return trees.feature_split_counts(spark, trees.fit_gbt(df, "features", "y", rounds=2, depth=3))


@query
def gbt_importance(spark, sf):
    df = assembled(spark, sf)
    return trees.feature_importances(spark, trees.fit_gbt(df, "features", "y"))


def order_rows(spark, sf) -> DataFrame:
    """Orders with three scaled inputs and a scaled target; ``o_orderkey`` is unique."""
    x = F.array((F.col("o_custkey") % 100) / 100.0, F.month("o_orderdate") / 12.0,
                F.substring("o_orderpriority", 1, 1).cast("int") / 5.0)
    return orders(spark, sf).select("o_orderkey", x.alias("x"), (F.col("o_totalprice") / 1e5).alias("target"))


@query
def dense_regress(spark, sf):
    spec = net.regressor_spec("x", 3, "target", [16, 8])
    _, log = dense.fit_dense(order_rows(spark, sf), spec, "o_orderkey", batch_size=256, epochs=2, rate=1e-2)
    return log


def status_rows(spark, sf) -> DataFrame:
    """Orders with three inputs and whether they are finished."""
    return order_rows(spark, sf).drop("target").join(
        orders(spark, sf).select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y")), "o_orderkey")


def status_fit(spark, sf, log_every: int = 1):
    """One epoch of three synchronous Adam steps of a relu net from fixed weights; the last batch may be smaller."""
    rows, spec = status_rows(spark, sf), net.classifier_spec("x", 3, "y", [2])
    return sync.fit_sync(rows, spec, "o_orderkey", max(1, -(-rows.count() // 3)), rate=0.05, init=fixed.fixed_model(spec), tasks=2, log_every=log_every)


@query
def sync_steps(spark, sf):
    """Parameters after three synchronous mini-batch steps."""
    return status_fit(spark, sf)[0].param_table(spark).select(
        F.concat_ws("/", "layer", "name").alias("name"), F.posexplode("values").alias("position", "value")).select(
        "name", F.col("position").cast("bigint").alias("position"), F.round("value", 7).alias("value"))


@query
def fit_log(spark, sf):
    """Loss, confusion counts, area under the curve (by score bins) after each step of a fit, since the epoch began."""
    return status_fit(spark, sf)[1].withColumn("value", r6("value"))


@query
def relu_classify(spark, sf):
    """Relu net with Adam as a job: drop nulls, split, index, assemble, scale, fit in synchronous rounds, score, judge."""
    df = with_gaps(lines(spark, sf)).withColumn("label", returned())
    number = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_id")
    scored, _ = jobs.relu_job(df, "label", ["l_linestatus"], NUMERIC, LINE_KEYS, number, batch_size=16000, rate=1e-2, tasks=4, sync_every=50)
    return metrics.confusion_counts(scored, "label", "prediction").withColumn("n_rows", F.expr("tp + tn + fp + fn"))


@query
def trained_rows(spark, sf):
    """Rows that each epoch of a fit has trained: all of them, and with ``drop_last`` whole batches."""
    rows, spec = order_rows(spark, sf), net.regressor_spec("x", 3, "target", [4])
    logs = [dense.fit_dense(rows, spec, "o_orderkey", batch_size=256, epochs=2, partitions=8, run=name, drop_last=drop)[1]
            for name, drop in (("all", False), ("whole", True))]
    both = logs[0].unionByName(logs[1]).where("metric = 'rows'")
    return both.select("run", "epoch", F.col("value").cast("bigint").alias("n_rows"))


@query
def multitask_fit(spark, sf):
    model, log = jobs.multitask_job(two_head_rows(spark, sf), two_heads(), "vec_id", batch_size=40, epochs=2)
    return log


@query
def transfer_fit(spark, sf):
    """Pre-train on the vectors, save, freeze, fit a head on another target, score every row."""
    rows = two_head_rows(spark, sf)
    parent, _ = jobs.multitask_job(rows, two_heads(), "vec_id", batch_size=40)
    path = scratch_path(spark, "parent")
    dense.save_params(spark, parent, path)
    parent = dense.load_params(spark, path)
    target = rows.withColumn("output", F.get("embedding", F.lit(0)) * 100.0 + 150.0)
    head, _ = jobs.transfer_job(target, parent, "vec_id", "output", batch_size=40, units=(16, 8))
    return jobs.score_transfer(target, parent, head).select("vec_id", "output", "prediction")


@query
def warm_start_fit(spark, sf):
    """Train from a saved template with validation, save, load, score."""
    rows = order_rows(spark, sf)
    train, valid = prepare.hash_split(rows, ["o_orderkey"], [0.8, 0.2])
    folder = scratch_path(spark, "models")
    start, _ = dense.fit_dense(train, net.regressor_spec("x", 3, "target", [8]), "o_orderkey", 256)
    dense.save_params(spark, start, f"{folder}/template")
    jobs.train_job(train, valid, "o_orderkey", folder, "model", f"{folder}/template", batch_size=256)
    return jobs.inference_job(valid, folder, "model").select("o_orderkey", "target", "prediction")


@query
def sequence_fit(spark, sf):
    """Histories -> pooled features -> net with focal loss; one score per user."""
    df = sequences.sequence_pool(histories(spark, sf), ["value", "kind", "hour"], ["user_id"])
    df = df.select("user_id", F.transform("pooled", lambda v: v / 100.0).alias("pooled"),
                   (F.get("pooled", F.lit(3)) > 10.0).cast("int").alias("label"))
    spec = net.classifier_spec("pooled", 6, "label", [8], loss="focal")
    model, _ = dense.fit_dense(df, spec, "user_id", batch_size=8, epochs=2, rate=0.000988)
    return dense.score_dense(df, model).select("user_id", "label", "prediction")


@query
def sequence_regress(spark, sf):
    """Flat sequences of 128 steps -> max and average -> net with absolute loss; one score per row."""
    df = generate.gen_sequence_flat(ids(spark, sf), 128, seed=14).withColumnRenamed("output", "target")
    df = sequences.sequence_pool(df, ["f"], ["id", "target"])
    # as many parts as cores: a step of more parts takes more than a batch
    model, _ = dense.fit_dense(df, net.regressor_spec("pooled", 2, "target", [8], loss="mae"), "id", batch_size=32,
                               partitions=spark.sparkContext.defaultParallelism)
    return dense.score_dense(df, model).select("id", "target", "prediction")


@query
def params_roundtrip(spark, sf):
    """A saved and loaded dense model gives equal scores on every row."""
    rows = order_rows(spark, sf)
    model, _ = dense.fit_dense(rows, net.regressor_spec("x", 3, "target", [8]), "o_orderkey", 256)
    path = scratch_path(spark, "params")
    dense.save_params(spark, model, path)
    both = dense.score_dense(dense.score_dense(rows, model, "p0"), dense.load_params(spark, path), "p1")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("p0") != F.col("p1")).alias("n_different"))


# --- search and reports -------------------------------------------------------------------------


SPACE = {"n_estimators": search.Grid(fixed.TRIAL_ROUNDS), "max_depth": search.Choice(fixed.TRIAL_DEPTHS), "eta": search.Choice(fixed.TRIAL_RATES)}


def judged_trials(spark, sf) -> tuple[DataFrame, DataFrame, boosting.BoostModel]:
    """Rounds x depth x rate, sampled twice: all trials are fitted together, one job a level, and judged in one pass."""
    train, valid = prepare.hash_split(boost_rows(spark, sf), ["l_orderkey"], [0.8, 0.2])
    return manyboost.search_many(train, valid, "x", "y", search.expand_trials(spark, SPACE, n_sampling=2, seed=2), edges=fixed.BOOST_EDGES, **fixed.TRIALS)


@query
def search_trials(spark, sf):
    return judged_trials(spark, sf)[0].withColumn("error", r6("error"))


@query
def search_best(spark, sf):
    return judged_trials(spark, sf)[1].withColumn("error", r6("error"))


@query
def search_saved(spark, sf):
    """The best model of a search, saved and loaded, scores every row as before."""
    model = judged_trials(spark, sf)[2]
    path = scratch_path(spark, "best")
    model.save(spark, path)
    both = boosting.score_hist_boost(boost_rows(spark, sf), model, "x").withColumnRenamed("margin", "m0")
    both = boosting.score_hist_boost(both, boosting.BoostModel.load(spark, path), "x")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("m0") != F.col("margin")).alias("n_different"))


@query
def search_run(spark, sf):
    train, valid = prepare.hash_split(assembled(spark, sf), LINE_KEYS, [0.8, 0.2])
    space = {"n_estimators": search.Grid([2, 3]), "max_depth": search.Choice([2, 3])}
    results, _, _ = jobs.search_job(train, valid, "features", "y", space, n_sampling=1)
    return results


@query
def search_hist(spark, sf):
    """Search over histogram trees with a regression target."""
    df = boost_rows(spark, sf)
    train, valid = prepare.hash_split(df, ["l_orderkey"], [0.8, 0.2])
    space = {"n_estimators": search.Grid([1, 2]), "max_depth": search.Choice([1, 2])}
    results, _, _ = jobs.search_job(train, valid, "x", "price", space, n_sampling=1, task="regress", learner="hist",
                                    edges=fixed.BOOST_EDGES, **fixed.SEARCH)
    return results.withColumn("rmse", r6("rmse"))


@query
def training_log(spark, sf):
    """Mean value per batch, appended to a log table, read back at every tenth step."""
    df = load_table(spark, sf, "events").select("event_id", "value")
    plan = prepare.batch_plan(df, "event_id", 100)
    path = scratch_path(spark, "log")
    report.append_log(report.batch_log(plan, "run", 0, "batch", {"loss": "value"}), path)
    return report.read_log(spark, path, every=10).withColumn("value", r6("value"))
