"""Small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.session import materialize

BROADCAST_BYTES = 32 << 20
#: Rows of text in an Arrow batch, where the session has Spark's default: at some KB a text, that default makes batches of
#: tens of MB outside the heap for every task.
BATCH_ROWS = 2000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
LOWER_BYTES = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def ascii_lower(text: Column | str) -> Column:
    """Lower-cases A-Z only: ``lower`` would also change letters outside ASCII."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def row_key(id_column: str, text_column: str) -> list[Column]:
    """Key of a document in joins: its id and a hash of its text, so that rows which repeat an id stay apart."""
    return [F.col(id_column).alias("_id"), F.hash(F.col(text_column)).alias("_h")]


def same_key(a: DataFrame, b: DataFrame) -> Column:
    return a["_id"].eqNullSafe(b["_id"]) & (a["_h"] == b["_h"])


def small_enough(table: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True if ``table`` stays within ``limit`` at ``row_bytes`` a row; reads no more rows than that."""
    rows = limit // row_bytes
    return table.limit(rows + 1).count() <= rows


def broadcast_if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast within the limit; beyond it the join is left to a shuffle."""
    return F.broadcast(table) if small_enough(table, row_bytes) else table


def map_texts(texts: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` over rows of text, in batches of BATCH_ROWS unless the session asks for a size of its own."""
    conf = texts.sparkSession.conf
    if conf.get(BATCH_CONF) == "10000":
        conf.set(BATCH_CONF, str(BATCH_ROWS))
    return texts.mapInArrow(run, schema)


def pieces(batches: Iterable[pa.RecordBatch], text: str, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``chars`` bytes of text each, so that Python never holds a whole batch of
    long texts decoded. A single text is never cut."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            if held and held + (n or 0) > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch, column
        pa.default_memory_pool().release_unused()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links`` (a, b): rows (node, root), root the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al. 2014), each written to the shared folder, until a
    step changes nothing. Rows stay linear in the links; a node with very many neighbours is only ever grouped
    with partial aggregates and joined by its id, never gathered.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = materialize(large, "large")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
