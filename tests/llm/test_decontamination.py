"""Benchmark decontamination against a brute-force version and the SQL twin."""

import hashlib
import random
import re

from compare import compare, connect

from broadloom.llm import contamination
from broadloom.llm.oracles import ORACLES
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(text, items):
    w = plain_words(text)
    hit, found = set(), set()
    for item, body in items:
        b = plain_words(body)
        n = min(13, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == b[i:i + n]:
                    hit.update(range(p, p + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "x1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([0, 1, 3, 12, 13, 14, 20, 45, 45])]
    items += [(7, "twice the id"), (None, "no id at all"), (50, None), (60, "a a a a a a a a a a a a a a a"), (61, "A-b C")]
    docs = [(None, "no id at all, no id at all"), (1, None), (2, ""), (3, "!!! --"), (4, "a " * 40), (4, "other text a b c")]
    for i in range(10, 60):
        parts = rng.choices(vocabulary, k=rng.randint(1, 80))
        for _, body in rng.sample(items[1:9], 2):
            b = (body or "").split()
            s = rng.randint(0, max(0, len(b) - 5))
            at = rng.randint(0, len(parts))
            parts[at:at] = [x.upper() for x in b[s:s + rng.randint(1, 45)]]
        docs.append((i, ", ".join(parts)))
    docs.append((10, docs[-50][1]))  # a repeated row
    want = sorted((i is None, i or 0, *plain(t, items)) for i, t in docs)
    frame = spark.createDataFrame([(i, t, 1, "u") for i, t in docs], "doc_id bigint, text string, n_words int, item string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r._id is None, r._id or 0, r.n_words, r.n_hit, list(r["items"]), r.contaminated)
                 for r in contamination.contamination(frame, bench).collect())
    assert got == want
    assert contamination.contamination(frame.limit(0), bench).count() == 0
    clean = contamination.contamination(frame, bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_hit for r in clean)


def test_query_against_sql(spark):
    ok, note = compare(spark, connect(SF), "op4_decontaminate", QUERIES["op4_decontaminate"], ORACLES["op4_decontaminate"], SF)
    assert ok, note
    assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in QUERIES["op4_decontaminate"](spark, SF).collect()}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "common x rare y common z seldom"), (2, "rare " + "common " * 60 + "seldom"), (3, "seldom rare")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, "the rare and seldom common")], "item_id bigint, text string")
    index = contamination.build_index(docs, bench)
    found = {(r._id, r.start) for r in contamination.proximity(index, rarest=2, slop=10).collect()}
    assert found == {(1, 2), (3, 0)}


def test_plan_has_no_python(spark):
    plan = QUERIES["op4_decontaminate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
