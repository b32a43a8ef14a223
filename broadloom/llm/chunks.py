"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is smallest among its neighbours, so that
cuts depend on the bytes around them only and an insertion moves no cut further on. Chunks are deduplicated by
digest over the whole corpus; runs of repeated chunks are the repeated passages of a document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import pieces
from broadloom.session import materialize

REACH = 24
LONGEST = 256
PASSAGE = 100
SLICE = 1 << 20


def _gear() -> np.ndarray:
    """One fixed random number a byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i - 1] << 2) + GEAR[data[i]] in 32 bits: the last 16 bytes count."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # sums of 2, 4, 8, 16 terms by doubling
        h[k:] += h[:-k] << np.uint32(2 * k)
    return h


def _least_before(h: np.ndarray, reach: int) -> np.ndarray:
    """Smallest of the ``reach`` values before each place."""
    n, top = len(h), np.iinfo(np.uint32).max
    low = np.concatenate((np.full(reach, top, np.uint32), h))
    width = 1
    while 2 * width <= reach:
        low[:-width] = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:n], low[reach - width:reach - width + n])


def boundaries(data: bytes, reach: int = REACH) -> np.ndarray:
    """Chunk ends: behind each byte whose gear hash is below the ``reach`` before it and not above the ``reach`` after.

    Chunks are longer than ``reach`` bytes, but for the first and the last. Where a text repeats itself within ``reach`` bytes
    there is no such place: a chunk of more than LONGEST bytes is cut every LONGEST bytes from its start.
    """
    ends = []
    margin = reach + 16
    for at in range(0, len(data), SLICE):  # long texts in slices that overlap by all a cut depends on
        low, high = max(0, at - margin), min(len(data), at + SLICE + reach)
        h = gear_hash(np.frombuffer(data, np.uint8, high - low, low))
        cut = (h < _least_before(h, reach)) & (h <= _least_before(h[::-1], reach)[::-1])
        found = np.flatnonzero(cut) + low + 1
        ends.append(found[(found > at) & (found <= at + SLICE)])
    if not data:
        return np.empty(0, np.int64)
    found = np.concatenate(ends)
    found = np.append(found[found < len(data)], len(data))
    starts = np.concatenate(([0], found[:-1]))
    wide = np.flatnonzero(found - starts > LONGEST)
    more = [np.arange(starts[i] + LONGEST, found[i], LONGEST) for i in wide]
    return np.sort(np.concatenate((found, *more))) if more else found


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = REACH) -> DataFrame:
    """(_id, owner, at, digest) per chunk; ``owner`` is a 64-bit hash of the text for rows without an id, else null; ``at`` packs a
    mark of the text (23 bits), the chunk's start (31) and length (9), in bytes of UTF-8. Null and empty texts have none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in pieces(batches, "_text"):
            rows, places, digests, owners = [], [], [], []
            nameless = batch.column("_id").is_null().to_pylist()
            for i, text in enumerate(batch.column("_text").cast(pa.binary()).to_pylist()):
                if text:
                    stop = boundaries(text, reach)
                    start = np.concatenate(([0], stop[:-1]))
                    places.append((digest(text, 1) & 0x7FFFFF) << 40 | start << 9 | (stop - start))
                    rows.append(np.full(len(stop), i, np.int32))
                    owners += [digest(text, 2) - (1 << 63) if nameless[i] else None] * len(stop)
                    digests += [digest(text[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(np.concatenate(rows))), pa.array(owners, pa.int64()),
                                                  pa.array(np.concatenate(places).astype(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64))],
                                                 names=["_id", "owner", "at", "digest"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(run, f"_id {kind}, owner bigint, at bigint, digest bigint")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = REACH, least: int = PASSAGE,
                      within: bool = False) -> DataFrame:
    """(_id, start, stop, n_chunks, first_id, kept, ranges) per passage: a run of chunks in a row that each occur in another
    document too, at least ``least`` bytes long. Offsets are in bytes of the UTF-8 text. With ``within`` repeats inside one
    document count as well; then only the first place of a chunk is kept, not its whole document.

    ``ranges``: (start, stop, n_chunks, first_id, kept) of the passage's parts, cut where the first document changes. ``first_id``: the
    smallest id with each chunk of the part; ``kept``: that is this document. Dropping all parts that are not kept leaves every
    chunk once. Of a whole passage ``first_id`` is that of its first part and ``kept`` tells that all are kept; a passage that is
    not kept may hold text that stands first here, so passages are not dropped as a whole. Digests have 64 bits and are not verified: among
    n different chunks some n * n / 2 ** 65 pairs agree by chance, and one chunk of ``least`` bytes is a passage. Rows of one id, a
    number or a string, are one document; those without an id are told apart by a 64-bit hash of their text, come behind all ids
    and have no ``first_id``. Null and empty texts have no passage.

    Counting is pre-aggregated by digest. In the join back one side has a row a digest, and Spark splits a digest with very
    many occurrences on the other.
    """
    chunks = materialize(chunked(docs, id_column, text_column, reach), "chunks")
    start = F.expr("shiftright(at, 9) & 2147483647")
    chunk = chunks.groupBy("digest")
    if within:
        place = F.struct(F.col("_id").isNull().alias("nameless"), "_id", "owner", start.alias("start"))
        seen = chunk.agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a < _b").select(
            "digest", F.col("_a._id").alias("first"), F.col("_a.owner").alias("_o"), F.col("_a.start").alias("_s"))
    else:  # plain numbers, so that Spark aggregates by hash
        several = "first < last OR _o < _p OR first IS NOT NULL AND _o IS NOT NULL"
        seen = chunk.agg(F.min("_id").alias("first"), F.max("_id").alias("last"), F.min("owner").alias("_o"), F.max("owner").alias("_p")).where(several) \
            .select("digest", "first", F.when(F.col("first").isNull(), F.col("_o")).alias("_o"))
    own = F.col("first").eqNullSafe(F.col("_id")) & F.col("_o").eqNullSafe(F.col("owner"))
    own = own & (F.col("_s") == start) if within else own
    found = chunks.join(seen, "digest").select("_id", "owner", F.shiftright("at", 40).alias("mark"), start.alias("start"),
                                               F.expr("at & 511").alias("n"), "first", "_o", own.alias("own"))
    line = Window.partitionBy("_id", "owner", "mark").orderBy("start")
    fresh = F.coalesce(F.lag(F.col("start") + F.col("n")).over(line) < F.col("start"), F.lit(True))
    changed = [~F.lag(c).over(line).eqNullSafe(F.col(c)) for c in ("first", "_o", "own")]
    turn = fresh | changed[0] | changed[1] | changed[2]
    runs = found.distinct().withColumns({"run": F.sum(fresh.cast("int")).over(line), "part": F.sum(turn.cast("int")).over(line)})
    spans = runs.groupBy("_id", "owner", "mark", "run", "part").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop"), F.count("*").alias("n_chunks"),
        F.first("first").alias("first_id"), F.first("own").alias("kept"))
    parts = F.array_sort(F.collect_list(F.struct("start", "stop", "n_chunks", "first_id", "kept")))
    whole = spans.groupBy("_id", "owner", "mark", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n_chunks").alias("n_chunks"),
        F.min_by("first_id", "start").alias("first_id"), F.min("kept").alias("kept"), parts.alias("ranges"))
    return whole.where(F.col("stop") - F.col("start") >= least).select("_id", "start", "stop", "n_chunks", "first_id", "kept", "ranges")
