"""Cleaning pipeline over ``documents``: language, near copies, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage to the shared folder and reads
it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm import contamination, disclosure, language, packing, simhash
from broadloom.llm.common import broadcast_if_small
from broadloom.session import load_table, materialize


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language: those without a text or a letter go. The model learns from all labelled rows;
    a table without a labelled row teaches no language, then every text with a letter stays."""
    model = language.fit_languages(docs)
    if not model.languages:
        return docs.where(F.rlike("text", F.lit(r"\p{L}")))
    mark = "_" + max(docs.columns, key=len)  # a name that no column has
    found = language.identify(docs, model, lang_out=mark, score_out=f"{mark}_score")
    return found.where(F.col(f"`{mark}`") != language.UNKNOWN).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest id, one of its rows if it has several.
    A row without an id stays if its component has no id."""
    found = simhash.near_components(docs)
    firsts = found.where(F.expr("_id <=> component_id")).groupBy("_root").agg(F.min(F.struct("_id", "_h")).alias("k"))
    kept = broadcast_if_small(materialize(firsts.select(F.col("k._id").alias("_i"), F.col("k._h").alias("_g")), "kept"), 48)
    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_i"]) & (F.hash(docs["text"]) == kept["_g"]), "left_semi")
    repeated = found.groupBy("_id", "_h").agg(F.count("*").alias("n")).where("n > 1")
    return (joined if repeated.isEmpty() else joined.dropDuplicates(["doc_id", "text"])).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows stay."""
    found = contamination.contamination(docs, load_table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = broadcast_if_small(materialize(found.select(F.col("_id").alias("_i"), F.col("_h").alias("_g")).distinct(), "bad"), 48)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_i"]) & (F.hash(docs["text"]) == bad["_g"]), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are masked; n_chars follows the text."""
    clean = disclosure.sanitise(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the cleaned documents in sequences of 2048 tokens."""
    found = packing.packed(docs)
    return found.select(F.col("_id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id",
                        F.col("offset").cast("bigint").alias("offset"))


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: The stages rest on trained models, hashes and tokenisers that SQL has not; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
