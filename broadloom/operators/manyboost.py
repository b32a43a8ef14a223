"""Many boosted models over one binned table: a level of all of them is one scan and one job.

For a hyper-parameter search. Settings that differ in the number of rounds only are one fit, whose first rounds are the smaller
models. Tasks keep one margin per fit and sum gradients per (fit, node, feature, bin); jobs are rounds x levels, however many
models there are, and the table is read once for all. A task's block holds at most BLOCK_BYTES of sums: a level of more nodes
takes several scans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators import boosting
from broadloom.operators.boosting import BoostModel, from_binary, new_tree, tree_nodes, tree_values
from broadloom.operators.columns import floats
from broadloom.operators.quantiles import weighted_edges
from broadloom.session import materialize, remove_scratch, scratch_path

#: What a fit may be given, with the values it has otherwise.
SETTINGS = {"eta": 0.1, "gamma": 0.1, "reg_lambda": 1.0, "min_child_weight": 30.0, "pos_weight": 1.0, "max_depth": 6, "num_round": 200}


def grouped(settings: Sequence[dict]) -> tuple[list[dict], list[int]]:
    """Distinct fits, each with the most rounds that are asked of it, and the fit of every setting."""
    fits: list[dict] = []
    places, which = {}, []
    for given in settings:
        unknown = set(given) - set(SETTINGS)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        s = SETTINGS | given
        key = tuple(s[k] for k in SETTINGS if k != "num_round")
        if key not in places:
            places[key] = len(fits)
            fits.append(dict(s))
        at = places[key]
        fits[at]["num_round"] = max(fits[at]["num_round"], s["num_round"])
        which.append(at)
    return fits, which


def _margins(bins: str, margins: str, pending: list[list[dict]]) -> Column:
    @F.arrow_udf("array<double>")
    def added(column: pa.Array, start: pa.Array) -> pa.Array:
        x, m = from_binary(column), floats(start, len(pending))
        out = np.stack([tree_values(trees, x, m[:, i]) for i, trees in enumerate(pending)], axis=1) if len(x) else m
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pending)), pa.array(out.ravel()))

    return added(F.col(bins), F.col(margins))


def _level(data: DataFrame, fits: list[dict], pending: list[list[dict]], trees: list[dict], wanted: list[tuple[int, int]], dim: int, bins: int,
           objective: str) -> DataFrame:
    """(node, feature, s): running sums as in ``boosting``; ``node`` is a place in ``wanted``, the (fit, node) pairs of this scan."""
    width = bins + 1
    by_fit: dict[int, list[tuple[int, int]]] = {}
    for place, (fit, node) in enumerate(wanted):
        by_fit.setdefault(fit, []).append((place, node))
    shared = data.sparkSession.sparkContext.broadcast({f: (pending[f], trees[f], fits[f]["pos_weight"], nodes) for f, nodes in by_fit.items()})
    count = len(wanted)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, dim, count * width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = from_binary(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            margins = floats(batch.column(2))
            columns = np.ascontiguousarray(np.minimum(x, bins).T)
            for fit, (done, now, positive, nodes) in shared.value.items():
                margin, w = tree_values(done, x, margins[:, fit]), np.where(y == 1, positive, 1.0)
                if objective == "binary:logistic":
                    p = 1.0 / (1.0 + np.exp(-margin))
                    g, h = w * (p - y), w * p * (1.0 - p)
                else:
                    g, h = w * (margin - y), w
                slots = np.full(len(now["feature"]), -1, np.int64)
                for place, node in nodes:
                    slots[node] = place - nodes[0][0]
                slot = slots[tree_nodes(now, x)]
                keep = np.flatnonzero(slot >= 0)
                base, size, start = slot[keep] * width, len(nodes) * width, nodes[0][0] * width
                gk, hk = g[keep], h[keep]
                for f in range(dim):
                    at = base + columns[f, keep]
                    total[0, f, start:start + size] += np.bincount(at, weights=gk, minlength=size)
                    total[1, f, start:start + size] += np.bincount(at, weights=hk, minlength=size)
        for place in range(count):
            part = total[:, :, place * width:(place + 1) * width]
            if part[1].any():
                part[:, :, :bins] = np.cumsum(part[:, :, :bins], axis=2)
                both = np.concatenate([part[0], part[1]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(dim, place, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(dim + 1, dtype=np.int32) * (2 * width)), pa.array(both.ravel()))],
                    names=["node", "feature", "sums"])

    partial = data.select("bins", "label", "margins").mapInArrow(sums, "node int, feature int, sums array<double>")
    return partial.groupBy("node", "feature").agg(vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("sums"))["sum"]).alias("s"))


def fit_many(df: DataFrame, features: str, label: str, settings: Sequence[dict], objective: str = "binary:logistic", base_margin: float = 0.0,
             edges: Sequence[Sequence[float]] | None = None, max_bins: int = boosting.MISSING, refresh: int = 25) -> list[BoostModel]:
    """One model per setting (SETTINGS), equal to ``boosting.fit_hist_boost`` with the same parameters and edges.

    Cut points are shared: without ``edges`` they split the rows evenly. A null or NaN label, an unknown setting and an empty
    list of settings are errors.
    """
    if not settings:
        raise ValueError("no settings")
    spark = df.sparkSession
    fits, which = grouped(settings)
    edges = weighted_edges(df, features, None, max_bins) if edges is None else edges
    dim, bins = len(edges), max((len(e) for e in edges), default=0) + 1
    start = F.array_repeat(F.lit(float(base_margin)), len(fits))
    table = scratch_path(spark, "bins")
    df.select(boosting.binned(features, edges).alias("bins"), F.col(label).cast("double").alias("label"), start.alias("margins")).write.parquet(table)
    data = spark.read.parquet(table)
    if not data.where("label IS NULL OR isnan(label)").isEmpty():
        raise ValueError(f"{label}: null or NaN labels")
    per_scan = max(1, boosting.BLOCK_BYTES // (16 * dim * (bins + 1)))
    rows: list[list[tuple]] = [[] for _ in fits]
    pending: list[list[dict]] = [[] for _ in fits]
    live = list(range(len(fits)))
    for number in range(max(f["num_round"] for f in fits)):
        live = [f for f in live if fits[f]["num_round"] > number]
        if not live:
            break
        if max(len(p) for p in pending) == refresh:
            moved = scratch_path(spark, "bins")
            data.withColumn("margins", _margins("bins", "margins", pending)).write.parquet(moved)
            data, pending = spark.read.schema(data.schema).parquet(moved), [[] for _ in fits]
            remove_scratch(spark, table)
            table = moved
        trees = [new_tree(f["max_depth"]) for f in fits]
        active = {f: [1] for f in live}
        grown: list[dict] = [{} for _ in fits]
        for level in range(max(fits[f]["max_depth"] for f in live)):
            wanted = [(f, n) for f in live if fits[f]["max_depth"] > level for n in active[f]]
            if not wanted:
                break
            active = {f: [] for f in live}
            for a in range(0, len(wanted), per_scan):
                part = wanted[a:a + per_scan]
                told = [f"get(array({', '.join(f'{float(fits[f][k])!r}D' for f, _ in part)}), node)" for k in ("reg_lambda", "gamma", "min_child_weight")]
                sums = boosting._running_sums(_level(data, fits, pending, trees, part, dim, bins, objective), bins)
                if level == 0:
                    sums = sums.persist()
                found = {r.node: r for r in boosting.pick_split(sums, *told).collect()}  # one row per node
                if level == 0 and len(found) < len(part):  # a root without a split is a leaf
                    for r in sums.where("feature = 0 AND bin = 0").collect():
                        f = part[r.node][0]
                        if r.node not in found:
                            trees[f]["leaf"][1] = -fits[f]["eta"] * r.g / (r.h + fits[f]["reg_lambda"])
                            grown[f][1] = (None, r.h)
                if level == 0:
                    sums.unpersist()
                for place, s in sorted(found.items()):
                    f, n = part[place]
                    tree, cuts, lam = trees[f], edges[s.feature], fits[f]["reg_lambda"]
                    tree["feature"][n], tree["bin"][n], tree["missing_left"][n] = s.feature, s.bin, s.missing_left
                    tree["threshold"][n] = cuts[s.bin] if s.bin < len(cuts) else float("inf")
                    grown[f][n] = (s.gain, s.h)
                    for child, g, h in ((2 * n, s.gl, s.hl), (2 * n + 1, s.g - s.gl, s.h - s.hl)):
                        tree["leaf"][child] = -fits[f]["eta"] * g / (h + lam)
                        grown[f][child] = (None, h)
                        active[f].append(child)
        for f in list(live):
            tree = trees[f]
            if not grown[f] or tree["feature"][1] < 0 and abs(tree["leaf"][1]) < 1e-12:  # a further round would see the same gradients
                live.remove(f)
                continue
            for n, (gain, cover) in sorted(grown[f].items()):
                if tree["feature"][n] >= 0:
                    rows[f].append((number, n, int(tree["feature"][n]), int(tree["bin"][n]), float(tree["threshold"][n]),
                                    bool(tree["missing_left"][n]), float(gain), float(cover), None))
                else:
                    rows[f].append((number, n, None, None, None, None, None, float(cover), float(tree["leaf"][n])))
            pending[f].append(tree)
    remove_scratch(spark, table)
    out = []
    for given, f in zip(settings, which):
        rounds = (SETTINGS | given)["num_round"]
        out.append(BoostModel([r for r in rows[f] if r[0] < rounds], objective, base_margin, fits[f]["max_depth"]))
    return out


def margins_of(df: DataFrame, models: Sequence[BoostModel], features: str, out: str = "margins") -> DataFrame:
    """Append an array with the margin of every model: one pass over the rows for all of them."""
    shared = df.sparkSession.sparkContext.broadcast([(m.trees(), m.base_margin) for m in models])
    count = len(models)

    @F.arrow_udf("array<double>")
    def margins(column: pa.Array) -> pa.Array:
        x = floats(column, name=features)
        found = np.stack([tree_values(trees, x, np.full(len(x), base)) for trees, base in shared.value], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * count), pa.array(found.ravel()))

    return df.withColumn(out, margins(F.col(features)))


def judge_many(df: DataFrame, models: Sequence[BoostModel], features: str, label: str) -> DataFrame:
    """(trial, error) of classifiers or (trial, rmse) of regressors over a table, in one pass and one aggregate."""
    scored = margins_of(df, models, features, "_m").select(F.col(label).cast("double").alias("_y"), F.posexplode("_m").alias("_i", "_m"))
    if models[0].objective == "binary:logistic":
        wrong = ((F.col("_m") > 0) != (F.col("_y") == 1)).cast("double")
        judged = scored.groupBy("_i").agg(F.avg(wrong).alias("error"))
    else:
        judged = scored.groupBy("_i").agg(F.sqrt(F.avg(F.pow(F.col("_m") - F.col("_y"), 2))).alias("rmse"))
    return judged.select(F.col("_i").cast("bigint").alias("trial"), judged.columns[1])


def search_many(train: DataFrame, valid: DataFrame, features: str, label: str, trials: DataFrame, task: str = "classify", path: str | None = None,
                **fixed) -> tuple[DataFrame, DataFrame, BoostModel]:
    """Fit and judge all ``trials`` (``search.expand_trials``) together: results, the best row, the best model, which is saved at
    ``path`` if given. ``n_estimators`` stands for ``num_round``; ``fixed`` are settings of every trial, ``edges``, or other
    options of ``fit_many``. Equal metrics go to the lower trial."""
    from broadloom.operators.search import best_trial

    spark = train.sparkSession
    rows = [r.asDict() for r in trials.orderBy("trial").collect()]
    options = {k: v for k, v in fixed.items() if k not in SETTINGS}
    names = {"n_estimators": "num_round"}
    settings = [{names.get(k, k): v for k, v in r.items() if k != "trial"} | {k: v for k, v in fixed.items() if k in SETTINGS} for r in rows]
    goal, metric = ("binary:logistic", "error") if task == "classify" else ("reg:squarederror", "rmse")
    models = fit_many(train, features, label, settings, goal, **options)
    numbered = spark.createDataFrame([(i, r["trial"]) for i, r in enumerate(rows)], "_place long, trial long")
    judged = materialize(judge_many(valid, models, features, label), "judged").withColumnRenamed("trial", "_place")
    results = trials.join(numbered.join(judged, "_place").drop("_place"), "trial")
    best = best_trial(results, metric)
    model = models[[r["trial"] for r in rows].index(best.first().trial)]
    if path is not None:
        model.save(spark, path)
    return results, best, model
