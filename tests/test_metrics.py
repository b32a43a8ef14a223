import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from broadloom.functions import metrics
from broadloom.functions.schedule import DECAY_VALUES, decay_boundaries, lr_at, piecewise_lr


def scored(spark, n=600, hot=True, seed=3):
    rng = random.Random(seed)
    rows = [(rng.randrange(2), 0.5 if hot and rng.random() < 0.4 else rng.randrange(50) / 50) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "y int, p double")


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [2, 64])
def test_auc_against_brute_force_with_a_hot_score(spark, buckets):
    rows, df = scored(spark)
    assert metrics.metric_auc(df, "y", "p", buckets).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert metrics.metric_auc(df, "y", "p").first().auc == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert metrics.metric_auc(df, "y", "p").first().auc is None


def test_metrics_do_not_depend_on_layout(spark):
    _, df = scored(spark)
    for fn in (metrics.metric_bce, metrics.metric_focal, metrics.metric_regression, metrics.metric_classification,
               metrics.confusion_counts, metrics.precision_recall, metrics.metric_auc):
        assert list(fn(df, "y", "p").first()) == pytest.approx(list(fn(df.repartition(9), "y", "p").first()))


def test_precision_recall_without_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    assert tuple(metrics.precision_recall(df, "y", "p").first()) == (0.0, 0.0)


def test_certain_predictions_stay_finite(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0)], "y int, p double")
    assert metrics.metric_bce(df, "y", "p").first().bce == pytest.approx(16.118, abs=1e-2)
    df = df.withColumn("q", F.array(F.col("p"), 1 - F.col("p")))
    assert metrics.metric_sparse_ce(df, "y", "q").first().sparse_ce < 17


def test_rate_is_constant_until_a_hundred_epochs(spark):
    cuts = decay_boundaries(50)
    steps = spark.createDataFrame([(0,), (1,), (4999,), (5000,), (5001,), (10 ** 6,)], "s long")
    got = [r.r for r in steps.select("s", piecewise_lr("s", cuts, DECAY_VALUES).alias("r")).orderBy("s").collect()]
    assert got == [1e-3, 1e-3, 1e-3, 1e-3, 1e-4, 1e-4]
    assert got == [lr_at(s, cuts, DECAY_VALUES) for s in (0, 1, 4999, 5000, 5001, 10 ** 6)]
    assert [lr_at(s, [2, 4], [1, 2, 3]) for s in range(6)] == [1, 1, 1, 2, 2, 3]


def test_nulls_are_refused(spark):
    rows = spark.createDataFrame([(1, 0.5), (0, None), (1, 0.7)], "y int, p double")
    for metric in (metrics.metric_auc, metrics.metric_bce, metrics.metric_regression, metrics.metric_classification, metrics.confusion_counts):
        with pytest.raises(Exception, match="null"):
            metric(rows, "y", "p").collect()
