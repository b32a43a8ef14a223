"""Registered queries of this folder: one per operator, over whole tables, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm import chunks, codes, contamination, content, disclosure, language, licences, neighbours, packing, phrases, prefixes, simhash, urls
from broadloom.session import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sha256_of(column) -> F.Column:
    return F.sha2(column.cast("binary") if not isinstance(column, str) else F.col(column).cast("binary"), 256)


# The rules of the query, and the words by which hosts of unwanted sites are labelled for training.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
UNWANTED = ("ad ads adserver adult advert adverts advertising adware banners bet bets betting bingo casino clickbait escort gambling jackpot lottery malware "
            "phish phishing pills poker popunder popups porn scam sex slots spam spyware telemetry track tracker trackers tracking trojan viagra warez xxx").split()


@query
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Labels: a host with a word of UNWANTED between dots or hyphens is bad. The trees see the features, not the words."""
    pages = load_table(spark, sf, "pages").select("page_id", "url")
    marked = urls.lexical(pages).withColumn("_bad", F.rlike("_host", F.lit(r"(?:\A|[.-])(?:" + "|".join(UNWANTED) + r")(?:[.-]|\z)")).cast("int"))
    model, rates = urls.fit_url_trees(marked)
    judged = urls.judge(pages, model, rates, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "probability")


@query
def op2_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = chunks.repeated_passages(load_table(spark, sf, "documents"))
    return found.withColumnRenamed("_id", "doc_id")


@query
def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_components(load_table(spark, sf, "documents"))
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.contamination(load_table(spark, sf, "documents"), load_table(spark, sf, "benchmark"))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        sha256_of(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


@query
def op5_licences(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(load_table(spark, sf, "documents")).withColumnRenamed("_id", "doc_id")


@query
def op6_pack(spark: SparkSession, sf: str) -> DataFrame:
    found = packing.packed(load_table(spark, sf, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id",
                        F.col("offset").cast("bigint").alias("offset"))


@query
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(spark, sf, "documents")
    out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    model = language.fit_languages(docs.where(~out))
    found = language.identify(docs.select("doc_id", "text"), model, mix_out="mixture")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "mixture")


@query
def op8_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.edited_fingerprints(load_table(spark, sf, "documents")).withColumnRenamed("_id", "doc_id")


@query
def op9_main_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = load_table(spark, sf, "pages")
    found = content.main_text(pages, content.fit_weights(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op10_disclosure(spark: SparkSession, sf: str) -> DataFrame:
    found = disclosure.sensitive_spans(load_table(spark, sf, "documents"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in disclosure.KINDS]
    return found.select(F.col("_id").alias("doc_id"), *counts, sha256_of(disclosure.listed("base")).alias("base_sha256"),
                        disclosure.listed("spans").alias("spans"))


@query
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, books = codes.lloyd_codes(load_table(spark, sf, "embeddings"), carry=["label"])
    return codes.label_errors(coded).select("vec_id", codes.code_text("entries").alias("code"), "error", "label_error",
                                            F.lit(codes.codebooks_digest(books)).alias("codebooks_sha256"))


@query
def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.prefix_trie(load_table(spark, sf, "conversations"))


@query
def op13_vantage_trees(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest_rows(load_table(spark, sf, "embeddings"))
