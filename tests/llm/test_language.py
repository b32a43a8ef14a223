"""Language identification: held-out accuracy, mixtures, odd rows."""

from pyspark.sql import functions as F

from broadloom.llm import language
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_language"](spark, SF).collect()
    assert len(rows) == len(truth)
    out = [r for r in rows if r.held_out]
    assert 0.15 < len(out) / len(rows) < 0.35
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_languages(docs)
    text = {r.lang: r.text for r in docs.where("n_chars > 1500").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    found = language.mixture(text["de"][:1400] + "\n" + text["es"][:600], model)
    assert list(found)[:2] == ["de", "es"] and 0.5 < found["de"] < 0.85
    assert list(language.mixture(text["fr"], model)) == ["fr"]
    whole = language.mixture(text["fr"] * 200, model)
    assert next(iter(whole)) == "fr"


def test_odd_rows(spark):
    labelled = spark.createDataFrame([("aaa bbb aaa", "x", 1), ("ccc ddd", "y", 2), (None, "x", 3), ("eee", None, 4)], "text string, lang string, score int")
    model = language.fit_languages(labelled)
    assert model.languages == ["x", "y"]
    rows = spark.createDataFrame([(1, None, "p"), (2, "", "p"), (3, "12 !!", "p"), (4, "bbb", "p"), (4, "bbb", "p"), (5, "ddd " * 300000, "p")], "doc_id int, text string, lang_pred string")
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 3)) for r in language.identify(rows, model).collect())
    assert got == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "x", 1.0), (4, "x", 1.0), (5, "y", 1.0)]
    assert language.identify(rows.limit(0), model).count() == 0
    empty = language.fit_languages(labelled.limit(0))
    assert {r.lang_pred for r in language.identify(rows, empty).collect()} == {"und"}
