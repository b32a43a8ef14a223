"""Tree ensembles as SQL: a fitted model becomes one expression, which Spark and any other SQL engine can score with.

No Python runs in the tasks. The text grows with rounds x 2^depth and Spark compiles it once a query: made for ensembles of some
hundred nodes. With 200 trees of depth 6 planning and compiling take half a minute, and the Arrow functions in ``boosting`` are faster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.operators.boosting import BoostModel
from broadloom.operators.trees import save_model
from broadloom.session import remove_scratch, scratch_path


@dataclass(frozen=True)
class Node:
    """A split (``feature`` goes left under ``cut``, a missing value as told), or a leaf (``feature`` None)."""

    value: float = 0.0
    feature: int | None = None
    cut: float = 0.0
    missing_left: bool = False
    left: int = 0
    right: int = 0


@dataclass(frozen=True)
class Ensemble:
    """``trees``: nodes by number, and the number of the root. ``strict``: a value equal to the cut goes right."""

    trees: tuple[tuple[dict[int, Node], int], ...]
    weights: tuple[float, ...]
    base: float = 0.0
    strict: bool = True

    def used(self) -> list[int]:
        return sorted({n.feature for nodes, _ in self.trees for n in nodes.values() if n.feature is not None})


def number(x: float) -> str:
    """Double literal of any SQL."""
    if x in (float("inf"), float("-inf")):
        return "1.7976931348623157e308" if x > 0 else "-1.7976931348623157e308"
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def of_hist(model: BoostModel) -> Ensemble:
    trees: dict[int, dict[int, Node]] = {}
    for tree, node, feature, _, cut, missing_left, _, _, leaf in model.rows:
        nodes = trees.setdefault(tree, {})
        nodes[node] = Node(value=leaf or 0.0) if feature is None else Node(0.0, feature, cut, bool(missing_left), 2 * node, 2 * node + 1)
    return Ensemble(tuple((trees[t], 1) for t in sorted(trees)), (1.0,) * len(trees), model.base_margin)


def of_gbt(spark: SparkSession, model) -> Ensemble:
    """From the node rows of a saved Spark ML model of numeric features: one row per node."""
    path = scratch_path(spark, "gbt")
    save_model(model, path)
    trees: dict[int, dict[int, Node]] = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        inner = r.leftChild >= 0
        if inner and r.split.numCategories != -1:
            raise ValueError("splits on categories are not expressed")
        trees.setdefault(r.treeID, {})[r.id] = Node(r.prediction) if not inner else Node(
            0.0, r.split.featureIndex, r.split.leftCategoriesOrThreshold[0], False, r.leftChild, r.rightChild)
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    remove_scratch(spark, path)
    return Ensemble(tuple((trees[t], 0) for t in sorted(trees)), tuple(weights[t] for t in sorted(trees)), 0.0, False)


def margin_sql(model: Ensemble, columns: Sequence[str]) -> str:
    """The summed margin as SQL text; ``columns[i]`` names feature i. Null is missing; a caller's NaN must be null by then.
    Trees are added in order, so that sums equal those of the model to the last bit."""
    def text(nodes: dict[int, Node], at: int) -> str:
        n = nodes[at]
        if n.feature is None:
            return number(n.value)
        test = f"{columns[n.feature]} {'<' if model.strict else '<='} {number(n.cut)}"
        return (f"CASE WHEN coalesce({test}, {str(n.missing_left).lower()}) THEN {text(nodes, n.left)} ELSE {text(nodes, n.right)} END")

    parts = [text(*t) if w == 1.0 else f"{number(w)} * {text(*t)}" for t, w in zip(model.trees, model.weights)]
    return " + ".join([number(model.base), *parts])


def score_sql(df: DataFrame, model: Ensemble, features: str, out: str = "margin") -> DataFrame:
    """Append ``out``: the margin of a row whose ``features`` is array<double>; a null or NaN element, or one that the array
    does not have, is missing. A null array misses every feature. Other columns, whatever their names, are kept."""
    used = model.used()
    mark = "_" + max(df.columns, key=len)  # a name that no column has
    scalars = F.struct(*[F.nanvl(F.get(F.col(features), F.lit(f)), F.lit(None)).alias(f"f{f}") for f in used]) if used else F.lit(None)
    width = (used[-1] + 1) if used else 0
    text = margin_sql(model, [f"`{mark}`.f{i}" for i in range(width)])
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.withColumn(mark, scalars).select(*kept, F.expr(text).alias(out))


def with_classes(scored: DataFrame, steepness: float = 1.0, margin: str = "margin") -> DataFrame:
    """``probability`` and ``prediction`` of a binary classifier; Spark ML's trees have steepness 2."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-steepness) * F.col(margin)))
    return scored.withColumn("probability", p).withColumn("prediction", (F.col(margin) > 0).cast("double"))
