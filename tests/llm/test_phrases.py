"""Phrase fingerprints against a plain parse of both texts."""

import hashlib

import numpy as np
import pytest

from broadloom.llm import phrases
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_phrases(text):
    seen, held = set(), ""
    for c in text:
        held += c
        if held not in seen:
            seen.add(held)
            held = ""
    return seen


def hash_of(phrase):
    mask, base = (1 << 64) - 1, 0x9E3779B97F4A7C15
    h = sum((ord(c) + 1) * pow(base, k, 1 << 64) for k, c in enumerate(phrase)) & mask
    h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & mask
    return ((h ^ h >> 27) * 0x94D049BB133111EB & mask) >> 32


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaa", "abababab é", "the cat and the hat and the cat", "\U0001f600x" * 50])
def test_fingerprint(text):
    want = sorted({hash_of(p) for p in plain_phrases(text)})[:64]
    assert phrases.fingerprint(text).tolist() == want


def test_long_text_in_slices(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(40000))
    whole = phrases.phrase_hashes(text, phrases.parse(text, set()))
    monkeypatch.setattr(phrases, "BLOCK", 1000)
    assert (phrases.phrase_hashes(text, phrases.parse(text, set())) == whole).all()


def test_query_against_plain_version(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op8_phrases"](spark, SF).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, follower = (phrases.fingerprint(t) for t in (text, edited, nxt))
        assert (r.fingerprint, r.edited_fingerprint) == (phrases.shown(own), phrases.shown(changed))
        assert r.near_edited == phrases.similarity(own, changed) and r.near_next == phrases.similarity(own, follower)


def test_similarity():
    a, b = np.arange(10, dtype=np.uint32), np.arange(5, 15, dtype=np.uint32)
    assert phrases.similarity(a, b) == 5 / 15 and phrases.similarity(a, a) == 1.0
    assert phrases.similarity(a, a[:0]) == 0.0 and phrases.similarity(a[:0], a[:0]) == 1.0


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_odd_rows(spark, blocks):
    rows = [(None, "b", 1), (None, "a", 2), (3, None, 3), (3, None, 4), (9, "x" * 300000, 5), (-4, "q r s", 6), (10, "last", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    got = phrases.edited_fingerprints(docs, blocks=blocks).collect()
    order = [(None, "a"), (None, "b"), (-4, "q r s"), (3, ""), (3, ""), (9, "x" * 300000), (10, "last")]
    want = []
    for k, (i, text) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][1], len(text) // 2
        want.append((str(i), len(text), hashlib.sha256((text[:len(text) - half] + nxt[:half]).encode()).hexdigest()))
    assert sorted((str(r._id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert phrases.edited_fingerprints(docs.limit(0), blocks=blocks).count() == 0
    one = phrases.edited_fingerprints(docs.where("doc_id = 10"), blocks=blocks).first()
    assert one.near_next == 1.0


def test_the_first_unknown_phrase_is_found_in_few_lookups():
    class Counted(set):
        asked = 0

        def __contains__(self, phrase):
            self.asked += 1
            return super().__contains__(phrase)

    seen, text = Counted(), "ab" * 5000
    ends = phrases.parse(text, seen)
    assert seen.asked <= 4 * len(ends)
    assert {text[a:b] for a, b in zip([0, *ends], ends)} == set(seen) and len(seen) == len(ends)
