"""Tokenising, cutting and packing: equal ids, an exact round trip, and the number of sequences."""

import random
import zlib

import numpy as np
import public_tokenizers as public
from tokenizers import Tokenizer

from broadloom.llm import packing

SF = "/root/testdata/sf0.001"


def test_ids_equal_the_tokenizer():
    slow = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    bpe = packing.public_encoder()
    texts = ["", " ", "Hello world", "a<|endoftext|>b  <|endoftext|>", "  lead\n\n tail  ", "É ñ 日本 \U0001f600", "x" * 3000, " " * 5000, "1234567 '' it's", "\x00\x07"]
    for t in texts:
        assert bpe.encode(t) == slow.encode(t, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_knapsack_against_enumeration():
    rng = random.Random(2)
    for _ in range(20):
        sizes = np.array(sorted(rng.sample(range(3, 30), 4)))
        prices = np.array([rng.random() for _ in sizes])
        best = [0.0] * 61
        for room in range(1, 61):
            best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in zip(sizes, prices, strict=True) if s <= room])
        chosen = packing.knapsack(sizes, prices, 60)
        assert sum(sizes[i] for i in chosen) <= 60
        assert abs(sum(prices[i] for i in chosen) - best[60]) < 1e-9


def test_plan_uses_every_length_once():
    rng = random.Random(4)
    for draw in (lambda: rng.randint(1, 256), lambda: rng.randint(80, 130), lambda: 256, lambda: 1):
        histogram = {}
        for _ in range(3000):
            n = draw()
            histogram[n] = histogram.get(n, 0) + 1
        plan = packing.pack_plan(histogram, 256, groups=24, rounds=60)
        used = {}
        for run, lengths in plan:
            assert run > 0 and sum(lengths) <= 256
            for n in lengths:
                used[n] = used.get(n, 0) + run
        assert used == histogram
        alone = packing.pack_plan(histogram, 256, groups=0)
        assert sum(r for r, _ in plan) <= sum(r for r, _ in alone)
    assert packing.pack_plan({}) == []


def check_packed(rows, texts, capacity):
    bpe = packing.public_encoder()
    places, want = {}, []
    for key, text in texts:
        ids = np.array([*bpe.encode(text or ""), 0], "<u4")
        want += [(key, k, s, n, zlib.crc32(ids[s:s + n])) for k, (s, n) in enumerate(packing.cut(len(ids), capacity))]
    assert sorted((str(r._id), r.piece, r.start, r.length, r.crc) for r in rows) == sorted((str(k), *x) for k, *x in want)
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= capacity
    return len(places)


def test_packed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.packed(docs).collect()
    n = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) * 1.05 + 1


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (None, "no id"), (3, "word " * 700), (3, "word " * 700), (4, "x")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id bigint, text string, length int")
    check_packed(packing.packed(docs, capacity=64).collect(), texts, 64)
    assert packing.packed(docs.limit(0)).count() == 0


def test_plan_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = {tuple(r) for r in packing.packed(docs.repartition(1)).collect()}
    b = {tuple(r) for r in packing.packed(docs.repartition(7)).collect()}
    assert a == b
