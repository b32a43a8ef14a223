"""Vector codes against a plain version of the rounds."""

import hashlib
import math
from collections import defaultdict

import pytest

from broadloom.llm import codes
from broadloom.llm.queries import QUERIES
from broadloom.session import load_table


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label). Returns (id, code, error, label_error, digest)."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]) if r[0] is not None else (True, 0, r[1]))[:entries]
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def choose(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[defaultdict(int), defaultdict(lambda: [0] * w)] for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                x = v[p * w:(p + 1) * w]
                k = choose(x, p)[1]
                found[p][0][k] += 1
                found[p][1][k] = [a + b for a, b in zip(found[p][1][k], x)]
        for p in range(parts):
            for k, n in found[p][0].items():
                books[p][k] = [s // n for s in found[p][1][k]]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], defaultdict(int)
    for i, v, y in kept:
        best = [choose(v[p * w:(p + 1) * w], p) for p in range(parts)]
        total[y] += sum(d for d, _ in best)
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), y))
    return [(i, c, e, total[y], digest) for i, c, e, y in out]


def test_query_equals_the_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in load_table(spark, sf, "embeddings").collect()]
    found = [tuple(r) for r in QUERIES["op11_vector_codes"](spark, sf).collect()]
    assert sorted(found) == sorted(plain_codes(rows))


def coded(df, **options):
    rows, books = codes.lloyd_codes(df, parts=2, carry=["label"], **options)
    rows = codes.label_errors(rows)
    return [(r.vec_id, "".join(f"{e:02x}" for e in r.entries), r.error, r.label_error, codes.codebooks_digest(books)) for r in rows.collect()]


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("owned", [8192, 3])
@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_ties_repeats_nulls_and_odd_vectors(spark, owned, rounds):
    bad = [(90, None, 1), (91, [1.0, None, 0.0, 0.0], 1), (92, [1.0, float("nan"), 0.0, 0.0], 1), (93, [float("inf")] * 4, 2), (94, [], 2)]
    rows = [(5, [0.0, 0.0, 1.0, 1.0], None), (5, [0.0, 0.0, 1.0, 1.0], None), (5, [0.5, 0.25, -1.0, 2.0], 3), (None, [9.0, 9.0, -9.0, 9.0], None),
            (-7, [0.0, -0.001, 0.001, -2.0], 1), (None, [1.0, 2.0, 3.0, 4.0], 1)]
    rows += [(i, [math.sin(i), math.cos(3 * i), i % 3 - 1.0, (i % 7) / 7], i % 2 or None) for i in range(10, 80)]
    rows += [(1000 + i, [0.125, -0.5, 0.75, 0.0], 8) for i in range(60)]  # one vector for many rows
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, label int").repartition(5)
    found = coded(df, entries=8, rounds=rounds, owned=owned)
    assert sorted(found, key=key) == sorted(plain_codes(rows + bad, 2, 8, rounds), key=key)


def test_empty_clashing_columns_and_errors(spark):
    kind = "vec_id bigint, embedding array<float>, label int"
    assert coded(spark.createDataFrame([], kind)) == []
    assert coded(spark.createDataFrame([(1, None, 2)], kind)) == []
    clashing = "entry string, position int, member string, _row string, _whole string, error string, entries string"
    one = spark.createDataFrame([(1, [0.5, 1.0], 2, "x", 7, "y", "z", "a", "b", "c")], f"{kind}, {clashing}")
    rows, books = codes.lloyd_codes(one, parts=2, carry=["entry", "position"])
    assert rows.drop("_row").collect() == [(1, "x", 7, [0, 0], 0)]
    assert books.tolist() == [[[128]], [[256]]]
    for vectors in ([[1.0, 2.0], [1.0]], [[1.0, 2.0, 3.0]]):
        with pytest.raises(ValueError, match="one length"):
            coded(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], kind))
    with pytest.raises(Exception, match="beyond"):
        coded(spark.createDataFrame([(1, [1e9, 0.0], 0)], kind))


def test_tables_of_the_rounds_are_removed(spark):
    import os

    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    df = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(50)], "vec_id bigint, embedding array<float>, label int")
    coded(df, rounds=3)
    assert not [n for n in os.listdir(base) if n.startswith("residents")]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("residents")]
