"""Vantage-point search against all distances."""

import math

import numpy as np
import pytest

from broadloom.llm import neighbours
from broadloom.llm.queries import QUERIES
from broadloom.session import load_table

KIND = "vec_id bigint, embedding array<double>"


def plain_nearest(rows, every=100, k=10):
    """rows: (id, vector) -> sorted (query, rank, id, score)."""
    kept = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, v) in enumerate(kept):
        if i is not None and i % every == 0:
            far = sorted((float(np.sqrt(((v - w) * (v - w)).sum())), j is None, j or 0) for m, (j, w) in enumerate(kept) if m != n)
            out += [(i, r, None if none else j, d) for r, (d, none, j) in enumerate(far[:k], 1)]
    return sorted(out, key=str)


def told(df):
    return sorted([(r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()], key=str)


def recall(found, wanted):
    of = {}
    for q, _, i, _ in found:
        of.setdefault(q, set()).add(i)
    return np.mean([i in of.get(q, ()) for q, _, i, _ in wanted])


def test_query_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in load_table(spark, sf, "embeddings").collect()]
    wanted = plain_nearest(rows)
    found = told(QUERIES["op13_vantage_trees"](spark, sf))
    assert len(found) == len(wanted) and recall(found, wanted) >= 0.95
    exact = {(q, i): d for q, _, i, d in plain_nearest(rows, k=2000)}
    assert all(exact[q, i] == d for q, _, i, d in found)
    assert {q: [r for a, r, _, _ in sorted(found, key=lambda x: (x[0], x[1])) if a == q] for q in {x[0] for x in found}} == \
        {q: list(range(1, 11)) for q in {x[0] for x in wanted}}
    table = load_table(spark, sf, "embeddings")
    assert told(neighbours.nearest_rows(table, factor=1)) == wanted


@pytest.mark.parametrize("block,shard,sample", [(1 << 15, 1 << 16, 1 << 14), (7, 50, 40)])
def test_ties_copies_nulls_and_crowded_regions(spark, block, shard, sample):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=5).round(1).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(400)]  # a third of all rows are one vector
    rows += [(100, [1.0] * 5), (100, [1.0] * 5), (None, [0.5] * 5), (None, [1.0] * 5), (-200, [0.1, 0.0, 0.0, 0.0, -3.0])]
    rows += [(300, None), (400, []), (500, [0.0] * 5), (600, [1.0, None, 1.0, 1.0, 1.0]), (800, [float("nan")] * 5), (900, [float("inf")] * 5)]
    df = spark.createDataFrame(rows, KIND).repartition(6)
    found = told(neighbours.nearest_rows(df, factor=1, block=block, shard=shard, sample=sample))
    wanted = plain_nearest(rows)
    assert [x[:3] for x in found] == [x[:3] for x in wanted]
    assert np.allclose([x[3] for x in found], [x[3] for x in wanted], atol=0, rtol=1e-14)
    relaxed = neighbours.nearest_rows(df, factor=1.5, block=block, shard=shard, sample=sample)
    assert recall(told(relaxed), wanted) >= 0.9


def test_pruning_saves_work_on_clustered_rows_and_stays_exact():
    r = np.random.default_rng(0)
    centres = r.normal(size=(40, 8)) * 20
    x = (centres[r.integers(0, 40, 4000)] + r.normal(size=(4000, 8)))
    ids = np.arange(4000)
    tree = neighbours.Tree(x, ids, ids, leaf=32)
    q = np.arange(0, 4000, 50)
    best = neighbours.Best(x[q], q, np.full(len(q), np.inf), 10)
    seen = []
    plain = best.offer
    best.offer = lambda w, rows, *rest: (seen.append(len(w) * len(rows)), plain(w, rows, *rest))[1]
    tree.search(best, np.arange(len(q)), 1.0)
    for n, i in enumerate(q):
        d = neighbours.distances(x, x[i])
        d[i] = np.inf
        assert best.id[n].tolist() == np.lexsort((ids, d))[:10].tolist()
    assert sum(seen) < 0.2 * len(q) * len(x)


def test_few_rows_empty_clashing_columns_and_errors(spark):
    assert told(neighbours.nearest_rows(spark.createDataFrame([], KIND))) == []
    assert told(neighbours.nearest_rows(spark.createDataFrame([(100, None)], KIND))) == []
    assert told(neighbours.nearest_rows(spark.createDataFrame([(100, [1.0])], KIND))) == []
    assert told(neighbours.nearest_rows(spark.createDataFrame([(1, [1.0]), (2, [2.0])], KIND))) == []
    clash = spark.createDataFrame([(0, [1.0, 0.0], 5, "x", 1.5), (7, [1.0, 2.0], 6, "y", 2.5)], KIND + ", rank int, _region string, score double")
    assert told(neighbours.nearest_rows(clash)) == [(0, 1, 7, 2.0)]
    floats = clash.select("vec_id", clash.embedding.cast("array<float>").alias("embedding"))
    assert told(neighbours.nearest_rows(floats)) == [(0, 1, 7, 2.0)]
    with pytest.raises(ValueError, match="one length"):
        neighbours.nearest_rows(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], KIND))
    with pytest.raises(ValueError, match="factor"):
        neighbours.nearest_rows(clash, factor=0.5)
