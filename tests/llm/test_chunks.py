"""Content-defined chunks: cuts are local, planted passages are found, clean documents are left alone."""

import random

import numpy as np
import pytest

from broadloom.llm import chunks
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_boundaries(data, reach=chunks.REACH):
    h, mask = [], (1 << 32) - 1
    for i in range(len(data)):
        h.append(sum(int(chunks.GEAR[data[i - k]]) << 2 * k for k in range(min(16, i + 1))) & mask)
    cuts = [i + 1 for i in range(len(h)) if all(h[i] < x for x in h[max(0, i - reach):i]) and all(h[i] <= x for x in h[i + 1:i + 1 + reach]) and i + 1 < len(h)]
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
        out += [*range(a + chunks.LONGEST, b, chunks.LONGEST), b]
    return out if data else []


@pytest.mark.parametrize("data", [b"", b"a", b"a" * 1000, b"abc " * 300, "é ñ word and more words ".encode() * 3, bytes(range(256)) * 4])
def test_boundaries(data):
    assert chunks.boundaries(data).tolist() == plain_boundaries(data)


def test_slices_change_nothing(monkeypatch):
    data = np.random.default_rng(1).integers(97, 123, 50000).astype(np.uint8).tobytes()
    whole = chunks.boundaries(data)
    monkeypatch.setattr(chunks, "SLICE", 700)
    assert (chunks.boundaries(data) == whole).all()


def test_planted_passages(spark):
    rng = random.Random(8)
    letters = "etaoinshrdlucmfwyp"

    def prose(n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n))

    passages = [prose(51) for _ in range(60)]
    rows, holders = [], {}
    for i in range(240):
        text = prose(rng.randint(5, 200))
        if i < 180:
            k = i % 60
            text = f"{prose(rng.randint(0, 60))} {passages[k]} {text}"
            holders.setdefault(k, []).append(i)
        rows.append((i, text, "x"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    found = chunks.repeated_passages(docs).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r._id, []).append(r)
    assert set(by_doc) == {i for ids in holders.values() for i in ids}
    for ids in holders.values():
        assert all(r.first_id in ids for i in ids for r in by_doc[i])
        assert [i for i in ids if any(r.kept for r in by_doc[i])] == [min(ids)]


def test_odd_rows(spark):
    long = "some words that go on and on until they make a passage of a good length for this test, which is more than enough bytes"
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, long + " tail"), (None, "other " + long), (7, "x" * 5000), (8, "x" * 5000), (9, "short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r._id, r.kept) for r in chunks.repeated_passages(docs, least=60).collect()}
    assert {i for i, _ in got} == {1, None, 7, 8}
    assert (7, True) in got and (8, False) in got
    assert chunks.repeated_passages(docs.limit(0)).count() == 0


def test_query_shares_text(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_chunk_dedup"](spark, SF).collect():
        assert 100 <= r.stop - r.start and r.stop <= len(texts[r.doc_id])
        if not r.kept and r.n_chunks == 1:
            assert texts[r.doc_id][r.start:r.stop] in texts[r.first_id]


def test_kept_bytes_hold_every_chunk(spark):
    """Copies that hold a passage of an earlier text: the rest of the copied text stays once."""
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(n))

    passages = [prose(40) for _ in range(4)]
    rows = []
    for i in range(12):
        body = f"{prose(60)} {passages[i % 4]} {prose(30)} {passages[(i + 1) % 4]} {prose(50)}"
        rows += [(2 * i, body), (2 * i + 100, body)]
    docs = spark.createDataFrame([(1, f"{prose(9)} {passages[0]} {prose(9)}"), *rows], "doc_id bigint, text string")
    found = chunks.repeated_passages(docs).collect()
    out = {}
    for r in found:
        assert (r.start, r.stop, r.n_chunks) == (r.ranges[0].start, r.ranges[-1].stop, sum(p.n_chunks for p in r.ranges))
        for p in r.ranges:
            assert p.kept == (p.first_id == r._id)
            if not p.kept:
                out.setdefault(r._id, []).append((p.start, p.stop))
    every, left = set(), []
    for r in docs.collect():
        text = r.text.encode()
        stops = chunks.boundaries(text).tolist()
        for a, b in zip([0, *stops[:-1]], stops, strict=True):
            every.add(text[a:b])
            if not any(s <= a and b <= e for s, e in out.get(r.doc_id, [])):
                left.append(text[a:b])
    assert out and set(left) == every
    assert sum(map(len, left)) < 1.02 * sum(map(len, every))


def test_repeats_within_one_document(spark):
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(n))

    passage = prose(45)
    one = f"{prose(40)} {passage} {prose(30)} {passage} {prose(35)} {passage} {prose(20)}"
    docs = spark.createDataFrame([(5, one), (6, prose(120)), (7, f"{prose(30)} {passage} {prose(30)}")], "doc_id bigint, text string")
    alone = docs.where("doc_id < 7")
    assert chunks.repeated_passages(alone).count() == 0
    for table, n in ((alone, 3), (docs, 4)):
        found = sorted(chunks.repeated_passages(table, within=True).collect(), key=lambda r: (r._id, r.start))
        assert [r._id for r in found] == [5, 5, 5, 7][:n]
        assert [r.kept for r in found] == [True, False, False, False][:n] and {r.first_id for r in found} == {5}
        assert all(r.stop - r.start > len(passage) - 90 for r in found)
    across = sorted((r._id, r.kept) for r in chunks.repeated_passages(docs).collect())
    assert across == [(5, True), (5, True), (5, True), (7, False)]


def test_rows_without_an_id_and_string_ids(spark):
    """Thousands of rows without an id share a passage two by two: each pair is found, beside real negative ids."""
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))

    shared = [words(60) for _ in range(1500)]
    rows = [(None, f"{words(30)} {p} {words(30)}") for p in shared for _ in range(2)] + [(-5, shared[0] + words(5)), (-6, words(200))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = chunks.repeated_passages(docs).collect()
    assert len(got) == 3001 and {r._id for r in got} == {None, -5}
    assert sum(r.first_id == -5 for r in got) == 3 and sum(r.kept for r in got) == 1500
    assert sum(r.stop - r.start > 300 for r in got) > 2900
    names = docs.limit(0).unionByName(docs).selectExpr("CASE WHEN doc_id IS NULL THEN 'n' || hash(text) ELSE 'm' || doc_id END AS doc_id", "text")
    assert chunks.repeated_passages(names).count() == 3001
