"""Second-order histogram boosting as Spark jobs.

Features are binned once into one byte each and kept as a Parquet table in the shared folder. Each
tree level is one job: tasks sum gradients per (node, feature, bin) over their rows, Spark adds the
partial sums per (node, feature), and a top-1 aggregate picks the split of every node. The driver sees
one row per node, never data.

Rows are not exploded to rows x features. A task streams its rows, so its memory is one histogram
block (nodes x features x bins, at most BLOCK_BYTES); a task sends at most one block a level, so input splits of
a good size bound the shuffle. Split gain follows Chen & Guestrin (2016):
0.5 * [GL^2/(HL+lambda) + GR^2/(HR+lambda) - G^2/(H+lambda)] - gamma.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadloom.operators.columns import floats
from broadloom.operators.quantiles import weighted_edges
from broadloom.session import materialize, remove_scratch, scratch_path

MISSING = 255  # bin byte of a missing value; real bins are 0..254
BLOCK_BYTES = 2 ** 28  # gradient sums a task holds; a level with more nodes than fit takes several passes
NODE_SCHEMA = ("tree int, node int, feature int, bin int, threshold double, missing_left boolean, "
               "gain double, cover double, leaf double")


def class_weight(label: Column | str, positive: float = 2.0) -> Column:
    """Row weight: ``positive`` where the label is 1, else 1."""
    y = F.col(label) if isinstance(label, str) else label
    return F.when(y == 1, F.lit(float(positive))).otherwise(F.lit(1.0))


def gradient(label: Column, margin: Column, weight: Column, objective: str) -> tuple[Column, Column]:
    """First and second derivative of the loss, as columns."""
    if objective == "binary:logistic":
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        return weight * (p - label), weight * p * (F.lit(1.0) - p)
    if objective == "reg:squarederror":
        return weight * (margin - label), weight
    raise ValueError(f"unknown objective {objective}")


def best_split(hist: DataFrame, reg_lambda: float = 1.0, gamma: float = 0.0,
               min_child_weight: float = 1.0) -> DataFrame:
    """Best split per node from a histogram table (node, feature, bin, g, h), one row per bin.

    A row goes left if its bin is at most ``bin``. A null bin holds missing values; they go to the
    side with the higher gain. Equal gains (in single precision) go to the lower feature, then bin.
    Nodes without a split of positive gain give no row.
    """
    run = "(PARTITION BY node, feature ORDER BY bin ASC NULLS LAST ROWS UNBOUNDED PRECEDING)"
    of = "(PARTITION BY node, feature)"
    return pick_split(hist.selectExpr(
        "node", "feature", "bin", f"sum(g) OVER {of} AS g", f"sum(h) OVER {of} AS h",
        f"sum(g) OVER {run} AS run_g", f"sum(h) OVER {run} AS run_h",
        f"coalesce(sum(CASE WHEN bin IS NULL THEN g END) OVER {of}, 0D) AS lost_g",
        f"coalesce(sum(CASE WHEN bin IS NULL THEN h END) OVER {of}, 0D) AS lost_h",
    ).where("bin IS NOT NULL"), reg_lambda, gamma, min_child_weight)


def pick_split(sums: DataFrame, reg_lambda: float | str, gamma: float | str, min_child_weight: float | str) -> DataFrame:
    """Best split per node from running sums: (node, feature, bin, g, h, run_g, run_h, lost_g, lost_h), where
    g and h are totals of (node, feature), and lost_* those of its missing values. A parameter may be an SQL expression of the node."""
    lam, loss, least = (x if isinstance(x, str) else f"{float(x)!r}D" for x in (reg_lambda, gamma, min_child_weight))
    sided = sums.selectExpr(
        "*", "explode(CASE WHEN lost_h = 0 THEN array(false) ELSE array(false, true) END) AS missing_left"
    ).selectExpr("node", "feature", "bin", "missing_left", "g", "h",
                 "run_g + CASE WHEN missing_left THEN lost_g ELSE 0D END AS gl",
                 "run_h + CASE WHEN missing_left THEN lost_h ELSE 0D END AS hl")
    gained = sided.where(f"hl > 0 AND h - hl > 0 AND hl >= {least} AND h - hl >= {least}").selectExpr(
        "*", f"0.5D * (gl * gl / (hl + {lam}) + (g - gl) * (g - gl) / (h - hl + {lam}) - g * g / (h + {lam}))"
             f" - {loss} AS gain")
    best = F.expr("max_by(struct(feature, bin, missing_left, gain, gl, hl, g, h),"
                  " struct(CAST(gain AS FLOAT), -feature, -bin, NOT missing_left))")
    return gained.where("gain > 1e-9D AND NOT isnan(gain)").groupBy("node").agg(best.alias("_s")).select("node", "_s.*")


# --- arrays inside tasks -----------------------------------------------------------------------


def to_binary(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    data = np.ascontiguousarray(matrix, dtype=np.uint8)
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def from_binary(column: pa.Array) -> np.ndarray:
    n, skip = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int32)[skip:skip + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(n, -1)


def quantile_edges(df: DataFrame, features: str, max_bins: int = MISSING) -> list[list[float]]:
    """Cut points per feature, at most ``max_bins - 1``, from mergeable quantile summaries.

    Values are exploded only into the partial aggregate of the same stage: what is shuffled is one summary
    per feature and task. Above 128 features raise
    spark.sql.objectHashAggregate.sortBased.fallbackThreshold past their number, or Spark sorts instead.
    """
    probabilities = [i / max_bins for i in range(max_bins)]
    values = df.select(F.posexplode(features).alias("i", "v")).groupBy("i").agg(
        F.percentile_approx(F.nanvl("v", F.lit(None)), probabilities, 4 * max_bins).alias("q"))
    found = {r.i: sorted(set(r.q or []))[1:] for r in values.collect()}  # one row per feature
    return [found[i] for i in sorted(found)]  # ``quantiles.weighted_edges`` needs no exploding and takes weights


def binned(features: str, edges: Sequence[Sequence[float]]) -> Column:
    """array<double> -> one byte per feature: how many cut points are at most the value."""
    cuts = [np.asarray(e, dtype=np.float64) for e in edges]
    if max((len(c) for c in cuts), default=0) >= MISSING:
        raise ValueError(f"at most {MISSING - 1} cut points per feature")

    @F.arrow_udf("binary")
    def to_bins(column: pa.Array) -> pa.Array:
        x = floats(column, len(cuts), features)
        out = np.empty(x.shape, dtype=np.uint8)
        for i, c in enumerate(cuts):
            out[:, i] = np.searchsorted(c, x[:, i], side="right")
        out[np.isnan(x)] = MISSING
        return to_binary(out)

    return to_bins(F.col(features))


def new_tree(depth: int) -> dict[str, np.ndarray]:
    """Splits and leaves by heap number: root 1, children 2n and 2n + 1. Plain arrays, for broadcast."""
    size = 2 ** (depth + 1)
    return {"feature": np.full(size, -1, np.int32), "bin": np.zeros(size, np.int32), "threshold": np.zeros(size),
            "missing_left": np.zeros(size, bool), "leaf": np.zeros(size)}


def tree_nodes(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Node each row comes to; ``x`` is bins (uint8) or raw values (float)."""
    at, rows = np.ones(len(x), np.int32), np.arange(len(x))
    for _ in range(len(tree["feature"]).bit_length() - 2):
        f = tree["feature"][at]
        v = x[rows, np.maximum(f, 0)]
        if x.dtype == np.uint8:
            left, lost = v <= tree["bin"][at], v == MISSING
        else:
            left, lost = v < tree["threshold"][at], np.isnan(v)
        left = np.where(lost, tree["missing_left"][at], left)
        at = np.where(f >= 0, 2 * at + np.where(left, 0, 1), at).astype(np.int32)
    return at


def tree_values(trees: Sequence[dict], x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``start`` plus the leaf values of the trees."""
    total = np.array(start, dtype=np.float64)
    for t in trees:
        total += t["leaf"][tree_nodes(t, x)]
    return total


@dataclass
class BoostModel:
    """Rows of the node table plus what scoring needs. Size: rounds x 2^depth, not data."""

    rows: list[tuple]
    objective: str
    base_margin: float
    max_depth: int

    def trees(self) -> list[dict[str, np.ndarray]]:
        out: dict[int, dict] = {}
        for tree, node, feature, b, threshold, missing_left, _, _, leaf in self.rows:
            t = out.setdefault(tree, new_tree(self.max_depth))
            t["feature"][node] = -1 if feature is None else feature
            t["bin"][node], t["threshold"][node] = b or 0, threshold or 0.0
            t["missing_left"][node], t["leaf"][node] = bool(missing_left), leaf or 0.0
        return [out[k] for k in sorted(out)]

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        meta = [(self.objective, float(self.base_margin), int(self.max_depth))]
        spark.createDataFrame(meta, "objective string, base_margin double, max_depth int") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return BoostModel([tuple(r) for r in rows], meta.objective, meta.base_margin, meta.max_depth)


def _add_trees(bins: str, margin: str, trees: list[dict]) -> Column:
    @F.arrow_udf("double")
    def added(column: pa.Array, start: pa.Array) -> pa.Array:
        return pa.array(tree_values(trees, from_binary(column), start.to_numpy(zero_copy_only=False)))

    return added(F.col(bins), F.col(margin))


def _histograms(data: DataFrame, trees: list[dict], current: dict, active: Sequence[int], dim: int, bins: int,
                objective: str) -> DataFrame:
    """(node, feature, s) for the given nodes: s holds running sums of g over the bins, the sum of g over
    missing values, then the same of h. Running sums add up across tasks as plain sums do, so tasks make
    them and no window is needed."""
    slots = np.full(len(current["feature"]), -1, np.int64)
    slots[list(active)] = np.arange(len(active))
    width = bins + 1  # the last place holds missing values
    shared = data.sparkSession.sparkContext.broadcast((trees, current))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = shared.value
        total = np.zeros((2, dim, len(active) * width))
        for batch in batches:
            x = from_binary(batch.column(0))
            y, w, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            margin = tree_values(done, x, margin)
            if objective == "binary:logistic":
                p = 1.0 / (1.0 + np.exp(-margin))
                g, h = w * (p - y), w * p * (1.0 - p)
            else:
                g, h = w * (margin - y), w
            slot = slots[tree_nodes(now, x)]
            keep = slot >= 0
            g, h, base = g[keep], h[keep], slot[keep] * width
            columns = np.ascontiguousarray(np.minimum(x[keep], bins).T)
            for f in range(dim):
                at = base + columns[f]
                total[0, f] += np.bincount(at, weights=g, minlength=total.shape[2])
                total[1, f] += np.bincount(at, weights=h, minlength=total.shape[2])
        for k, node in enumerate(active):
            part = total[:, :, k * width:(k + 1) * width]
            if part[1].any():
                part[:, :, :bins] = np.cumsum(part[:, :, :bins], axis=2)
                both = np.concatenate([part[0], part[1]], axis=1)
                offsets = np.arange(dim + 1, dtype=np.int32) * (2 * width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(dim, node, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(both.ravel()))],
                    names=["node", "feature", "sums"])

    partial = data.select("bins", "label", "weight", "margin").mapInArrow(
        sums, "node int, feature int, sums array<double>")
    return partial.groupBy("node", "feature").agg(
        vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("sums"))["sum"]).alias("s"))


def _with_siblings(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Histograms of the given children and, as parent minus child, of their siblings."""
    known = children.selectExpr("node AS child", "node div 2 AS node", "feature", "s AS part")
    rest = parents.join(known, ["node", "feature"]).selectExpr(
        "child ^ 1 AS node", "feature", "zip_with(s, part, (a, b) -> a - b) AS s")
    return children.unionByName(rest)


def _running_sums(histograms: DataFrame, bins: int) -> DataFrame:
    """One row per bin, as ``pick_split`` takes them."""
    width = bins + 1
    return histograms.selectExpr(
        "node", "feature", f"s[{bins - 1}] + s[{bins}] AS g", f"s[{width + bins - 1}] + s[{width + bins}] AS h",
        f"s[{bins}] AS lost_g", f"s[{width + bins}] AS lost_h",
        f"slice(s, 1, {bins}) AS run_g", f"slice(s, {width + 1}, {bins}) AS run_h",
    ).selectExpr(
        "node", "feature", "g", "h", "lost_g", "lost_h", "posexplode(arrays_zip(run_g, run_h)) AS (bin, _p)",
    ).selectExpr("node", "feature", "bin", "g", "h", "_p.run_g", "_p.run_h", "lost_g", "lost_h")


def fit_hist_boost(df: DataFrame, features: str, label: str, objective: str = "binary:logistic", eta: float = 0.1,
                   gamma: float = 0.1, reg_lambda: float = 1.0, min_child_weight: float = 30.0,
                   pos_weight: float = 1.0, max_depth: int = 6, num_round: int = 200, base_margin: float = 0.0,
                   edges: Sequence[Sequence[float]] | None = None, max_bins: int = MISSING,
                   refresh: int = 25, subtract: bool = True, partitions: int | None = None) -> BoostModel:
    """Fit on ``features`` (array<double>, NaN or null element = missing) and a numeric ``label``.

    Margins are written back every ``refresh`` trees; between, tasks add the trees since then, so
    neither lineage nor work per level grows with the number of rounds. With ``subtract`` tasks sum
    only the lighter child of each split, and the other comes as parent minus child: half the work and
    half the shuffle of a level, for one small join.

    Without ``edges``, features are cut where the second derivative of the loss at the start is split evenly
    (``quantiles.weighted_edges``). ``partitions`` lays the binned table out once; by default it keeps the partitions of the input, whatever cores
    there are. A null or NaN label is an error.
    """
    spark = df.sparkSession
    if edges is None:
        y = F.col(label).cast("double")
        hessian = gradient(y, F.lit(float(base_margin)), class_weight(y, pos_weight), objective)[1]
        edges = weighted_edges(df, features, hessian, max_bins)
    y = F.col(label).cast("double")
    rows_in = df if partitions is None else df.repartition(partitions)
    data = materialize(rows_in.select(
        binned(features, edges).alias("bins"), y.alias("label"), class_weight(y, pos_weight).alias("weight"),
        F.lit(float(base_margin)).alias("margin")), "bins")
    if not data.where("label IS NULL OR isnan(label)").isEmpty():
        raise ValueError(f"{label}: null or NaN labels")
    return grow_trees(data, _histograms, _with_margins, edges, objective, eta, gamma, reg_lambda, min_child_weight, max_depth,
                      num_round, base_margin, refresh, subtract)


def _with_margins(data: DataFrame, trees: list[dict]) -> DataFrame:
    return data.withColumn("margin", _add_trees("bins", "margin", trees))


def grow_trees(data: DataFrame, histograms: Callable[..., DataFrame], with_margins: Callable[..., DataFrame],
               edges: Sequence[Sequence[float]], objective: str, eta: float, gamma: float, reg_lambda: float,
               min_child_weight: float, max_depth: int, num_round: int, base_margin: float, refresh: int,
               subtract: bool) -> BoostModel:
    """Rounds of boosting over a stored table of binned rows, whatever its layout: ``histograms`` sums the gradients of some
    nodes over it (as ``_histograms`` does), ``with_margins`` adds finished trees to its margins."""
    spark = data.sparkSession
    dim, bins = len(edges), max(len(e) for e in edges) + 1
    per_task = max(1, BLOCK_BYTES // (16 * dim * (bins + 1)))
    rows: list[tuple] = []
    pending: list[dict] = []
    before: str | None = None
    for number in range(num_round):
        if len(pending) == refresh:
            path = scratch_path(spark, "margins")
            with_margins(data, pending).write.parquet(path)
            data = spark.read.schema(data.schema).parquet(path)
            if before is not None:
                remove_scratch(spark, before)  # one table of margins at a time
            before, pending = path, []
        tree, active, grown, parents = new_tree(max_depth), [1], {}, None
        for _ in range(max_depth):
            wanted = active if parents is None else lighter
            level = reduce(DataFrame.unionByName, [
                histograms(data, pending, tree, wanted[at:at + per_task], dim, bins, objective)
                for at in range(0, len(wanted), per_task)])
            if parents is not None:
                level = _with_siblings(parents, level)
            if subtract:
                level = level.persist(StorageLevel.MEMORY_AND_DISK)
            sums = _running_sums(level, bins)
            found = pick_split(sums, reg_lambda, gamma, min_child_weight).collect()  # one row per node
            if subtract:
                done, parents = parents, level
                if done is not None:
                    done.unpersist()
            active, lighter = [], []
            for s in sorted(found, key=lambda r: r.node):
                n = s.node
                tree["feature"][n], tree["bin"][n], tree["missing_left"][n] = s.feature, s.bin, s.missing_left
                cuts = edges[s.feature]
                tree["threshold"][n] = cuts[s.bin] if s.bin < len(cuts) else float("inf")
                grown[n] = (s.gain, s.h)
                for child, g, h in ((2 * n, s.gl, s.hl), (2 * n + 1, s.g - s.gl, s.h - s.hl)):
                    tree["leaf"][child] = -eta * g / (h + reg_lambda)
                    grown[child] = (None, h)
                    active.append(child)
                lighter.append(2 * n if 2 * s.hl <= s.h else 2 * n + 1)
            if not active:
                break
        if parents is not None:
            parents.unpersist()
        if not grown:  # the root stays a leaf
            whole = sums.where("feature = 0 AND bin = 0").first()
            if whole is None:
                break
            leaf = -eta * whole.g / (whole.h + reg_lambda)
            if abs(leaf) < 1e-12:  # a further round would see the same gradients
                break
            tree["leaf"][1], grown[1] = leaf, (None, whole.h)
        for n, (gain, cover) in sorted(grown.items()):
            if tree["feature"][n] >= 0:
                rows.append((number, n, int(tree["feature"][n]), int(tree["bin"][n]), float(tree["threshold"][n]),
                             bool(tree["missing_left"][n]), float(gain), float(cover), None))
            else:
                rows.append((number, n, None, None, None, None, None, float(cover), float(tree["leaf"][n])))
        pending.append(tree)
    if before is not None:
        remove_scratch(spark, before)
    return BoostModel(rows, objective, base_margin, max_depth)


def score_hist_boost(df: DataFrame, model: BoostModel, features: str) -> DataFrame:
    """Append ``margin`` and ``prediction``; the classifier also appends ``probability``."""
    shared = df.sparkSession.sparkContext.broadcast(model.trees())
    base = model.base_margin

    @F.arrow_udf("double")
    def margin(column: pa.Array) -> pa.Array:
        x = floats(column, name=features)
        return pa.array(tree_values(shared.value, x, np.full(len(x), base)))

    scored = df.withColumn("margin", margin(F.col(features)))
    if model.objective == "reg:squarederror":
        return scored.withColumn("prediction", F.col("margin"))
    scored = scored.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


def boost_split_counts(nodes: DataFrame) -> DataFrame:
    """How often each feature splits a node."""
    return nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.count("*").alias("splits"))


def boost_importances(nodes: DataFrame) -> DataFrame:
    """Share of each feature in the total split gain. The total is over one row a feature, in one task."""
    per = nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("gain").alias("gain"))
    return per.select("feature", "gain", (F.col("gain") / F.sum("gain").over(Window.partitionBy()))
                      .alias("importance"))
