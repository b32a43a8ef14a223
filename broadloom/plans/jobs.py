"""End-to-end jobs over the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.functions import metrics
from broadloom.functions.schedule import DECAY_VALUES, decay_boundaries, lr_at
from broadloom.operators import boosting, dense, features, prepare, search, sync, trees
from broadloom.operators.dense import DenseModel
from broadloom.operators.network import DenseSpec, classifier_spec, multitask_spec
from broadloom.session import materialize
from broadloom.sources.files import read_saved, write_parquet


def fit_mlp(df: DataFrame, column: str, label: str, layers: Sequence[int], rounds: int = 100,
            block: int = 1024, seed: int = 24) -> MultilayerPerceptronClassificationModel:
    """Spark ML's dense classifier: sigmoid hidden layers, L-BFGS. Same task as a relu net trained with
    Adam (``dense.fit_dense``), not the same curve. ``block`` rows are multiplied as one matrix."""
    return MultilayerPerceptronClassifier(featuresCol=column, labelCol=label, layers=list(layers), maxIter=rounds,
                                          blockSize=block, seed=seed).fit(df)


def prepared(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str],
             partitions: int | None = None, fit_on: str = "train", seed: int = 24,
             join_index: bool = False, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Select, drop null rows, split, index, assemble, scale. The index and the moments come from the
    training rows (``fit_on="all"``: from every row). Returns train and test with ``scaled_features``. ``join_index`` numbers
    categories by a join, for columns of more values than the driver should hold; either way an unseen category is an error.
    ``stored`` keeps the cleaned rows as a scratch table: each pass would else read and deal the whole table anew."""
    wanted = list(dict.fromkeys([*keys, label, *categorical, *numeric]))
    df = prepare.drop_null_rows(prepare.spread(df.select(*wanted), partitions))
    if stored:
        df = materialize(df, "prepared")
    df = prepare.with_split(df, keys, [0.8, 0.2], seed, "_split")
    fitted = (lambda d: d) if fit_on == "all" else (lambda d: d.where(F.col("_split") == 0))
    indexed = [f"{c}_index" for c in categorical]
    if categorical and join_index:
        for c, out in zip(categorical, indexed):
            df = features.string_index_join(df, c, out, fit_on=fitted(df))
    elif categorical:
        df = features.string_index(df, categorical, indexed, fit_on=fitted(df))
    df = features.assemble(df, [*indexed, *numeric])
    df = features.standard_scale(df, fit_on=fitted(df)).drop("features")
    return tuple(df.where(F.col("_split") == i).drop("_split") for i in (0, 1))


def classify_job(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str],
                 hidden: Sequence[int] = (15, 15), rounds: int = 60) -> DataFrame:
    """Table -> dense binary classifier -> scored test rows with ``probability`` (of class 1)."""
    train, test = prepared(df, label, categorical, numeric, keys)
    train = train.persist()
    try:
        width = len(categorical) + len(numeric)
        model = fit_mlp(train, "scaled_features", label, [width, *hidden, 2], rounds)
    finally:
        train.unpersist(blocking=True)
    scored = model.transform(test)
    return scored.select(*keys, label, F.get(vector_to_array("probability"), F.lit(1)).alias("probability"),
                         F.col("prediction"))


def relu_job(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], keys: Sequence[str], row_id: Column,
             hidden: Sequence[int] = (15, 15), batch_size: int = 32, epochs: int = 10, rate: float = 1e-3,
             **options) -> tuple[DataFrame, DataFrame]:
    """Table -> relu net with one sigmoid unit, trained with Adam on cross-entropy in synchronous steps -> scored test rows with
    ``probability`` and ``prediction``, and the log of losses and metrics, those of the test rows among them. ``row_id``: a
    unique number of each row, made of ``keys``; it fixes the batches."""
    train, test = (d.select(*keys, label, row_id.alias("_id"), vector_to_array("scaled_features").alias("x"))
                   for d in prepared(df, label, categorical, numeric, keys, stored=True))
    spec = classifier_spec("x", len(categorical) + len(numeric), label, list(hidden))
    train = train.select("_id", label, "x").persist()  # its layout reads it four times
    try:
        model, log = sync.fit_sync(train, spec, "_id", batch_size, epochs, rate, validation=test, **options)
    finally:
        train.unpersist(blocking=True)
    scored = dense.score_dense(test, model, "probability").withColumn("prediction", (F.col("probability") > 0.5).cast("double"))
    return scored.select(*keys, label, "probability", "prediction"), log


def boosted_job(df: DataFrame, label: str, numeric: Sequence[str], keys: Sequence[str], path: str,
                task: str = "classify", **params) -> DataFrame:
    """Table -> boosted trees -> saved and loaded model -> scored test rows."""
    df = features.assemble(prepare.spread(df), numeric, invalid="keep").withColumn("features", features.densify("features"))
    df = df.withColumnRenamed(label, "label")
    train, test = prepare.hash_split(df, keys, [0.8, 0.2], 24)
    train = train.persist()
    try:
        trees.save_model(trees.fit_gbt(train, "features", "label", task, **params), path)
    finally:
        train.unpersist(blocking=True)
    return trees.score_gbt(test, trees.load_gbt(path, task), "features").drop("features")


def search_job(train: DataFrame, valid: DataFrame, column: str, label: str, space: dict, n_sampling: int = 2,
               task: str = "classify", learner: str = "gbt", seed: int = 2, metric: str | None = None, mode: str = "min",
               path: str | None = None, **fixed):
    """Search over any parameters of the learner; returns results, best row and best model.

    ``learner``: ``gbt`` (Spark ML, ``column`` a vector) or ``hist`` (second-order histogram trees,
    ``column`` an array). The space may name any parameter of its fit; ``n_estimators`` and ``max_depth`` are taken by
    both. A name that the fit does not know is an error. ``metric``: a column of the task's metrics, by default
    error or rmse; ``mode``: min or max. The best model is saved at ``path`` if given. ``fixed`` goes to every fit.
    """
    trials = search.expand_trials(train.sparkSession, space, n_sampling, seed)
    if learner == "hist" and "edges" not in fixed:
        fixed["edges"] = boosting.quantile_edges(train, column)  # one pass for all trials

    names = {"n_estimators": "num_round"} if learner == "hist" else {"n_estimators": "rounds", "max_depth": "depth"}

    def fit(data: DataFrame, p: dict):
        given = {names.get(k, k): v for k, v in p.items() if k != "trial"} | fixed
        if learner == "hist":
            goal = "binary:logistic" if task == "classify" else "reg:squarederror"
            return boosting.fit_hist_boost(data, column, label, goal, **given)
        return trees.fit_gbt(data, column, label, task, **given)

    def judge(data: DataFrame, model) -> DataFrame:
        score = boosting.score_hist_boost if learner == "hist" else trees.score_gbt
        measure = metrics.metric_classification if task == "classify" else metrics.metric_regression
        return measure(score(data, model, column), label, "prediction")

    metric = metric or ("error" if task == "classify" else "rmse")
    results, models = search.run_trials(train, valid, trials, fit, judge, metric)
    best = search.best_trial(results, metric, mode)
    model = models[best.first().trial]
    if path is not None:
        if learner == "hist":
            model.save(train.sparkSession, path)
        else:
            trees.save_model(model, path)
    return results, best, model


def multitask_job(df: DataFrame, spec: DenseSpec, key: str, batch_size: int, epochs: int = 1,
                  **options) -> tuple[DenseModel, DataFrame]:
    """Multi-task net with the stepwise learning rate."""
    steps = -(-df.count() // batch_size)
    boundaries = decay_boundaries(steps)
    return dense.fit_dense(df, spec, key, batch_size, epochs,
                           rate=lambda step: lr_at(step, boundaries, DECAY_VALUES), **options)


def transfer_job(train: DataFrame, parent: DenseModel, key: str, label: str, batch_size: int, epochs: int = 1,
                 units: Sequence[int] = (512, 256, 128, 64), layer: str = "concatenate",
                 **options) -> tuple[DenseModel, DataFrame]:
    """Frozen parent, cut at ``layer``, with a new regression head fitted on its features at the stepwise rate."""
    frozen = dense.frozen_features(train, parent, layer).select(key, label, "frozen")
    spec = dense.transfer_spec(parent.spec.widths()[layer], label, units)
    boundaries = decay_boundaries(-(-train.count() // batch_size))
    options = {"rate": lambda step: lr_at(step, boundaries, DECAY_VALUES)} | options
    return dense.fit_dense(frozen, spec, key, batch_size, epochs, **options)


def score_transfer(df: DataFrame, parent: DenseModel, head: DenseModel, layer: str = "concatenate") -> DataFrame:
    return dense.score_dense(dense.frozen_features(df, parent, layer), head).drop("frozen")


def score_full_batches(df: DataFrame, model: DenseModel, key: str, batch_size: int) -> DataFrame:
    """Score rows // batch_size whole batches, in key order."""
    return dense.score_dense(prepare.batch_plan(df, key, batch_size), model)


def save_predictions(scored: DataFrame, path: str) -> DataFrame:
    """Write the prediction table and read it back."""
    write_parquet(scored, path)
    return read_saved(scored.sparkSession, path)


def _joined(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name.lstrip('/')}"


def train_job(train: DataFrame, validation: DataFrame, key: str, folder: str, name: str, template: str,
              batch_size: int = 32, epochs: int = 1, **options) -> tuple[DenseModel, DataFrame]:
    """Warm start from the model saved at ``template``, fit with validation, save as folder/name."""
    spark = train.sparkSession
    start = dense.load_params(spark, template)
    model, log = dense.fit_dense(train, start.spec, key, batch_size, epochs, validation=validation, init=start,
                                 **options)
    dense.save_params(spark, model, _joined(folder, name))
    return model, log


def inference_job(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Score with the model saved as folder/name."""
    return dense.score_dense(df, dense.load_params(df.sparkSession, _joined(folder, name)))


def pretrain_and_transfer(spark: SparkSession, classes: DataFrame, target: DataFrame, key: str, width: int,
                          path: str, batch_size: int = 160, spec: Callable[..., DenseSpec] = multitask_spec,
                          **sizes) -> tuple[DenseModel, DenseModel]:
    """Pre-train on ``classes``, save, load frozen, fit a new head on ``target``; returns both models."""
    parent, _ = multitask_job(classes, spec(width, width, **sizes), key, batch_size)
    dense.save_params(spark, parent, path)
    head, _ = transfer_job(target, dense.load_params(spark, path), key, "output", batch_size)
    return parent, head
