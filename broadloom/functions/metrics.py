"""Losses and metrics: each takes a prediction table and gives a one-row DataFrame.

All but AUC are one partial aggregate, so only one row per partition is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.prepare import with_running_totals

CLIP = 1e-7


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_probability(p: Column | str) -> Column:
    return F.least(F.greatest(_c(p), F.lit(CLIP)), F.lit(1 - CLIP))


def bce(label: Column | str, p: Column | str) -> Column:
    """Binary cross-entropy of a row."""
    y, q = _c(label), clip_probability(p)
    return -(y * F.log(q) + (F.lit(1) - y) * F.log(F.lit(1.0) - q))


def focal(label: Column | str, p: Column | str, gamma: float = 2.0) -> Column:
    """Binary focal cross-entropy of a row, without class balance."""
    q = clip_probability(p)
    pt = F.when(_c(label) == 1, q).otherwise(F.lit(1.0) - q)
    return -F.pow(F.lit(1.0) - pt, F.lit(gamma)) * F.log(pt)


def sparse_ce(label: Column | str, probabilities: Column | str) -> Column:
    """Cross-entropy of a row whose label is a class number and whose prediction is an array."""
    return -F.log(clip_probability(F.element_at(_c(probabilities), _c(label).cast("int") + 1)))


def squared(label: Column | str, p: Column | str) -> Column:
    return F.pow(_c(p) - _c(label), F.lit(2.0))


def absolute(label: Column | str, p: Column | str) -> Column:
    return F.abs(_c(p) - _c(label))


def squared_array(target: Column | str, output: Column | str) -> Column:
    """Mean squared difference of two arrays of equal length."""
    diffs = F.zip_with(_c(target), _c(output), lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda s, d: s + d) / F.size(_c(target))


def metric_bce(df: DataFrame, label: str, p: str) -> DataFrame:
    return all_known(df, label, p).agg(F.avg(bce(label, p)).alias("bce"))


def metric_focal(df: DataFrame, label: str, p: str, gamma: float = 2.0) -> DataFrame:
    return all_known(df, label, p).agg(F.avg(focal(label, p, gamma)).alias("focal"))


def metric_sparse_ce(df: DataFrame, label: str, probabilities: str) -> DataFrame:
    return all_known(df, label, probabilities).agg(F.avg(sparse_ce(label, probabilities)).alias("sparse_ce"))


def metric_regression(df: DataFrame, label: str, p: str) -> DataFrame:
    return all_known(df, label, p).agg(
        F.avg(squared(label, p)).alias("mse"),
        F.avg(absolute(label, p)).alias("mae"),
        F.sqrt(F.avg(squared(label, p))).alias("rmse"),
    )


def metric_classification(df: DataFrame, label: str, p: str, threshold: float = 0.5) -> DataFrame:
    wrong = ((_c(p) > F.lit(threshold)).cast("int") != _c(label)).cast("double")
    return all_known(df, label, p).agg(F.avg(wrong).alias("error"), (F.lit(1.0) - F.avg(wrong)).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, p: str, threshold: float = 0.5) -> DataFrame:
    yes, true = _c(p) > F.lit(threshold), _c(label) == 1
    return all_known(df, label, p).agg(
        F.count_if(yes & true).alias("tp"), F.count_if(~yes & ~true).alias("tn"),
        F.count_if(yes & ~true).alias("fp"), F.count_if(~yes & true).alias("fn"),
    )


def precision_recall(df: DataFrame, label: str, p: str, threshold: float = 0.5) -> DataFrame:
    """Both are 0 when their denominator is 0."""
    def share(other: str) -> Column:
        bottom = F.col("tp") + F.col(other)
        return F.when(bottom == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("tp"), bottom))

    return confusion_counts(df, label, p, threshold).select(
        share("fp").alias("precision"), share("fn").alias("recall"))


def all_known(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The same rows; a null in one of the columns is an error when the rows are read, so that no metric leaves a row out."""
    missing = reduce(lambda a, b: a | b, [_c(c).isNull() for c in columns])
    return df.where(F.when(missing, F.raise_error(F.lit("a label or score is null")).cast("boolean")).otherwise(F.lit(True)))


def metric_auc(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """Exact ROC AUC; equal scores count half. Null when a class is missing.

    Rows collapse to one per distinct score (partial aggregate), so a score held by a third of all
    rows is one row from there on. The running count of negatives is range-partitioned.
    """
    true = (_c(label) == 1).cast("bigint")
    rows = all_known(df, label, score).select(_c(score).cast("double").alias("s"), true.alias("pos"), (F.lit(1) - true).alias("neg"))
    by_score = rows.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranked = with_running_totals(
        by_score, "s", {"negatives": F.col("neg"), "positives": F.col("pos")}, buckets, finer=rows)
    below = F.col("negatives") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    pairs = F.max("positives_all").cast("double") * F.max("negatives_all")
    return ranked.agg(F.when(pairs > 0, F.try_divide(wins, pairs)).alias("auc"))


def reconstruction_rows(df: DataFrame, target: str, output: str, out: str = "reconstruction_error") -> DataFrame:
    return df.withColumn(out, squared_array(target, output))


def reconstruction_error(df: DataFrame, target: str, output: str) -> DataFrame:
    return df.agg(F.avg(squared_array(target, output)).alias("reconstruction_error"))
