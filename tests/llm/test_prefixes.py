"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from broadloom.llm import prefixes
from broadloom.llm.queries import QUERIES
from broadloom.session import load_table

KIND = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    """rows: (conv_id, turn, role, text) -> node tuples."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = turns.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        built[c] = tuple(base[:h]) + tuple(own[h:])
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        own = (len(who) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    return sorted((min(who), len(n), min(members[n[:-1]]) if n else -1, len(who), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, who in members.items())


def told(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def test_query_equals_the_plain_trie(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in load_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert told(QUERIES["op12_prefix_trie"](spark, sf)) == plain_trie(rows)


def mixed(seed):
    """Few different turns, so that many prefixes are shared, copies, hot firsts, odd rows."""
    r, rows = random.Random(seed), []
    for c in range(-12, 90):
        n = r.choice([1, 2, 3, 9, 14]) if c % 7 else 3
        for t in range(n):
            text = "same opening" if t == 0 and c % 3 else r.choice(["a", "b", "é", "", None, "long " * 50])
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", None, "assistant"]), text))
    rows += [(200 + i, t, "user", f"copy {t}") for i in range(60) for t in range(4)]
    rows += [(400, t, "user", "again and again") for t in range(80)] + [(405, t, "user", "again and again") for t in range(70)]
    rows += [(None, 0, "user", "nobody's"), (7, 0, "user", "a"), (7, 0, "user", "a"), (10 ** 15, 2, "user", "x" * 100_000)]
    return rows


@pytest.mark.parametrize("limit", [prefixes.SKETCH_BYTES, 1 << 16])
def test_shared_tied_long_and_odd_rows(spark, limit):
    rows = mixed(3)
    df = spark.createDataFrame(rows, KIND).repartition(7)
    assert told(prefixes.prefix_trie(df, limit)) == plain_trie(rows)


def test_a_conversation_over_several_tasks_and_unique_turns(spark):
    rows = [(5, t, "user", f"turn {t % 50}") for t in range(700)] + [(9, t, "user", f"turn {t % 50}") for t in range(600)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(20, 60) for t in range(3)]
    df = spark.createDataFrame(rows, KIND)
    states = prefixes.turn_states(df)
    assert states.where("conv_id = 5").count() == 700
    chained = [r.i for r in states.where("conv_id = 5").orderBy("i").collect()]
    assert chained == list(range(1, 701))
    assert told(prefixes.prefix_trie(df)) == plain_trie(rows)


def test_whatever_the_sketch_says_the_nodes_are_the_same(spark, monkeypatch):
    rows = mixed(8)
    df = spark.createDataFrame(rows, KIND)
    plain = prefixes.estimates
    monkeypatch.setattr(prefixes, "estimates", lambda p, w, a, b: np.maximum(plain(p, w, a, b), 2 * (a % 3 == 0)))
    assert told(prefixes.prefix_trie(df)) == plain_trie(rows)


def test_estimates_are_never_too_low(spark):
    r = np.random.default_rng(0)
    once, twice = (r.integers(0, prefixes.PRIME, (n, 2)) for n in (3000, 500))
    rows = [tuple(map(int, x)) for x in [*once, *twice, *twice]]
    packed, width = prefixes.sketch_of(spark.createDataFrame(rows, "d1 bigint, d2 bigint").repartition(6))
    assert (prefixes.estimates(packed, width, twice[:, 0].copy(), twice[:, 1].copy()) == 2).all()
    found = prefixes.estimates(packed, width, once[:, 0].copy(), once[:, 1].copy())
    assert found.min() == 1 and (found > 1).mean() < 0.01
    counts = r.integers(0, 3, prefixes.CHUNK).astype(np.uint8)
    assert (prefixes.unpack(prefixes.pack(counts)) == counts).all()


def test_empty_table_clashing_columns_and_turnless(spark):
    assert told(prefixes.prefix_trie(spark.createDataFrame([], KIND))) == []
    assert told(prefixes.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], KIND))) == []
    # conversations whose own turns are all replaced by those of an absent one have no turns
    bare = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:6]
    rows = [(c, t, "user", f"{c}") for c in bare for t in range(2)]
    assert told(prefixes.prefix_trie(spark.createDataFrame(rows, KIND))) == plain_trie(rows)
    clash = spark.createDataFrame([(*r, 1, "x", 2) for r in rows + [(0, 0, "system", "t")]], KIND + ", depth int, kind string, n int")
    assert told(prefixes.prefix_trie(clash)) == plain_trie(rows + [(0, 0, "system", "t")])
