"""Spark ML boosted trees and the reports drawn from a fitted model."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.operators.boosting import class_weight
from broadloom.session import scratch_base, scratch_path


def fit_gbt(df: DataFrame, features: str, label: str, task: str = "classify", rounds: int = 200, depth: int = 6,
            eta: float = 0.1, pos_weight: float = 1.0, min_info_gain: float = 0.0, min_instances: int = 1,
            max_bins: int = 256, seed: int = 24):
    """GBTClassifier or GBTRegressor. ``min_info_gain`` and ``min_instances`` are impurity gain and row
    count; for second-order gamma and child weight see ``boosting.fit_hist_boost``. Rows find their node from the root at each
    level: a table of node ids kept up to date gives the same trees and costs more than the few steps down."""
    scratch_base(df.sparkSession)  # predictions are checkpointed there
    kind = {"classify": GBTClassifier, "regress": GBTRegressor}[task]
    learner = kind(featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=eta,
                   minInfoGain=min_info_gain, minInstancesPerNode=min_instances, maxBins=max_bins, seed=seed)
    if pos_weight != 1.0:
        df = df.withColumn("_weight", class_weight(label, pos_weight))
        learner = learner.setWeightCol("_weight")
    return learner.fit(df)


def score_gbt(df: DataFrame, model, features: str) -> DataFrame:
    return model.setFeaturesCol(features).transform(df)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_gbt(path: str, task: str = "classify", class_num: int = 2):
    if task == "classify":
        if class_num != 2:
            raise ValueError("boosted trees here classify two classes")
        return GBTClassificationModel.load(path)
    return GBTRegressionModel.load(path)


def feature_split_counts(spark: SparkSession, model) -> DataFrame:
    """Splits per feature, counted over the node rows of the saved model."""
    path = scratch_path(spark, "gbt")
    save_model(model, path)
    node = spark.read.parquet(f"{path}/data").select("nodeData.*")
    inner = node.where(F.col("leftChild") >= 0)
    return inner.groupBy(F.col("split.featureIndex").alias("feature")).agg(F.count("*").alias("splits"))


def feature_importances(spark: SparkSession, model) -> DataFrame:
    """Normalised importances, one row per feature."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "feature int, importance double")
