"""SimHash near-duplicates against a brute-force version."""

import re

import numpy as np
import pytest
import xxhash

from broadloom.llm import common, simhash
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_print(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] if len(found) >= words else [" ".join(found)] * bool(found)
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def plain_components(ids, prints, distance=3):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            r = find(i)
            least[r] = min(ids[i], least.get(r, ids[i]))
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", None, " \t\x0b", "One", "a b", "A b C", "É é x y", "a a a a a a", "x" * 5000 + " y" * 9000])
def test_fingerprint(text):
    assert simhash.majority(simhash.shingle_hashes(text)) == plain_print(text)


def test_query_against_brute_force(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_print(r.text) for r in rows]
    want = {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(rows, prints, plain_components([r.doc_id for r in rows], prints), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("limit", [4096, 8, 2])
def test_dense_groups_need_no_cap(spark, limit):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = set(rng.integers(0, 1 << 63, 40, dtype=np.uint64).tolist())
    for c in centre:  # chains and clouds around a few centres
        for _ in range(60):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "_fp bigint")
    links = simhash.near_links(table, limit=limit)
    for r in links.collect():
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 3
    roots = {r.node % (1 << 64): r.root for r in common.components(links).collect()}
    want = plain_components(list(range(len(prints))), prints)
    groups = {}
    for p, w in zip(prints, want, strict=True):
        groups.setdefault(w, set()).add(roots.get(p, ("alone", p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_odd_rows(spark):
    rows = [(1, "the same text again and again", "x"), (1, "the same text again and again", "y"), (None, None, None), (7, "", "z"),
            (None, "the same text again and again", "q"), (9, "alone " * 2000, "w"), (3, None, "v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    got = sorted(((r._id is None, r._id or 0, r.component_id) for r in simhash.near_components(docs).collect()))
    assert got == [(False, 1, 1), (False, 1, 1), (False, 3, 3), (False, 7, 3), (False, 9, 9), (True, 0, 1), (True, 0, 3)]
    assert simhash.near_components(docs.limit(0)).count() == 0
