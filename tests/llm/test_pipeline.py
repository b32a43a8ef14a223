"""The pipeline against a plain version of its stages, and odd rows through every stage."""

import zlib

import numpy as np
import pytest
from test_decontamination import plain as plain_hits
from test_disclosure import plain as plain_spans
from test_near_copies import plain_components, plain_print

import corpus_pipeline
from broadloom.llm import disclosure, packing

SF = "/root/testdata/sf0.001"


def plain_run(docs, items):
    """(doc_id, masked text) of the documents that stay; no term of so small a table discloses anything."""
    docs = sorted((i, t) for i, t in docs if t and any(c.isalpha() for c in t))
    roots = plain_components([i for i, _ in docs], [plain_print(t) for _, t in docs])
    kept = [(i, t) for (i, t), r in zip(docs, roots, strict=True) if i == r]
    clean = [(i, t) for i, t in kept if not plain_hits(t, items)[3]]
    return [(i, disclosure.masked(t, [(s, e, k) for s, _, e, k in plain_spans(t)])) for i, t in clean]


def test_run_against_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bpe = packing.public_encoder()
    want = []
    for i, text in plain_run(docs, items):
        ids = np.array([*bpe.encode(text), 0], "<u4")
        want += [(i, k, s, n, zlib.crc32(ids[s:s + n])) for k, (s, n) in enumerate(packing.cut(len(ids)))]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert len({i for i, _ in docs}) > len({r.doc_id for r in rows}) > 0


ODD = [
    (1, None, None, None, None, "a"), (2, "", "en", "s", 0, "b"), (3, "12 34 !!", "en", "s", 8, "c"), (None, "words without an id here", None, "s", 24, "d"),
    (4, "the same words once more", "en", None, None, "e"), (4, "the same words once more", "en", None, None, "e"), (5, "the same words once more", "de", "s", 1, "f"),
    (4, "another text under the same id", "en", "s", 2, "g"), (6, "mail a@b.cd or +1 234 567 8901", "en", "s", 3, "h"), (7, "word " * 50000, "en", "s", 250000, "i"),
]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_through_every_stage(spark, empty):
    docs = spark.createDataFrame(ODD[:0] if empty else ODD, "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    rows = docs.collect()
    if empty:
        assert rows == []
    else:
        assert sorted((str(r.doc_id), r.component_id) for r in rows) == [("4", "e"), ("4", "g"), ("6", "h"), ("7", "i"), ("None", "d")]
        masked = next(r for r in rows if r.doc_id == 6)
        assert masked.text == "mail [EMAIL] or [PHONE]" and masked.n_chars == len(masked.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {str(r.doc_id) for r in packed} == {str(r.doc_id) for r in rows}


def test_without_labels_every_text_with_a_letter_stays(spark):
    rows = [(1, "good text", None, 0.5), (2, None, None, 0.5), (3, "12 !?", None, 0.5), (4, "é", None, 0.5), (5, "", "en", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _lang double")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_languages(spark, docs.where("doc_id < 5"), SF).collect()) == [1, 4]
    learned = corpus_pipeline.keep_languages(spark, docs.unionByName(spark.createDataFrame([(6, "more text", "en", 0.25)], docs.schema)), SF)
    assert sorted((r.doc_id, r._lang) for r in learned.collect()) == [(1, 0.5), (4, 0.5), (6, 0.25)]
