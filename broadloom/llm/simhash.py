"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint has a bit set where more than half of its shingle hashes have it set. Two fingerprints link
if they differ in at most three bits. Cut into two halves, one half of such a pair differs in at most one bit, so the
pair is equal in at least one of the 64 variants that keep one half with one bit deleted. The variants are an
index joined on equality; every candidate is verified by its bit distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import LOWER_BYTES, components, map_texts, pieces
from broadloom.session import materialize

WORDS = 3
DISTANCE = 3
BUCKET = 4096
ROWS = 1 << 16


def shingle_hashes(text: str | None, words: int = WORDS, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of every shingle, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    joined, n = b" ".join(found), len(found)
    h = xxhash.xxh64_intdigest
    if n <= words:
        return np.array([h(joined, seed)] if n else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: n - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
    return np.fromiter((h(joined[s:e], seed) for s, e in spans), np.uint64, n - words + 1)


def majority(hashes: np.ndarray) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half of the hashes; 0 without hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), ROWS):
        part = hashes[at:at + ROWS]
        bits = np.unpackbits(np.ascontiguousarray(part).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(part) // 255 * 255
        # sums of 255 bits fit in a byte
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """Rows (_id, _h, _fp): fingerprint as a signed 64-bit number. A null or blank text has fingerprint 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            prints = [majority(shingle_hashes(t, words)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["_id", "_h", "_fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("_id"), F.hash(text_column).alias("_h"), F.col(text_column).alias("_text"))
    return map_texts(source, run, f"_id {kind}, _h int, _fp bigint")


def forest(prints: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning edges of the graph that links fingerprints within ``distance`` bits: one edge less than nodes a
    component at most, however many pairs are near."""
    left, right, rest = [], [], prints
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = np.bitwise_count(rest ^ node) <= distance
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), node, np.uint64))
                right.append(found)
                front.extend(found)
                rest = rest[~near]
    return left, right


def _near_in_runs(distance: int, limit: int | None):
    """mapInArrow function over rows sorted by _key: links within each run of one key, and the rows of runs above
    ``limit`` unchanged (kind 1), for a finer key. Holds one run of at most ``limit`` rows."""

    def out(kind: int, key, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(np.asarray(key, np.int64), n).copy()),
             pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "_key", "a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, large = None, np.empty(0, np.uint64), False

        def close():
            if len(held) > 1 and not large:
                left, right = forest(np.unique(held), distance)
                if left:
                    yield out(0, 0, np.concatenate(left), np.concatenate(right))

        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            prints = np.ascontiguousarray(batch.column("_fp").to_numpy(zero_copy_only=False)).view(np.uint64)
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            sizes = ends - starts
            inner = np.ones(len(starts), bool)
            inner[[0, -1]] = False  # these may go on in the batches beside
            two = starts[inner & (sizes == 2)]
            near = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance]
            if len(near):
                yield out(0, 0, prints[near], prints[near + 1])
            for i in [0, *np.flatnonzero(inner & (sizes > 2)).tolist(), *([len(starts) - 1] if len(starts) > 1 else [])]:
                if keys[starts[i]] != held_key:
                    yield from close()
                    held_key, held, large = keys[starts[i]], np.empty(0, np.uint64), False
                part = prints[starts[i]:ends[i]]
                held = part if large else np.concatenate((held, part))
                if large or limit is not None and len(held) > limit:
                    yield out(1, held_key, held, held)
                    held, large = np.empty(0, np.uint64), True
        yield from close()

    return run


def _linked(keyed: DataFrame, distance: int, limit: int | None) -> DataFrame:
    ordered = keyed.repartition("_key").sortWithinPartitions("_key")
    return materialize(ordered.mapInArrow(_near_in_runs(distance, limit), "kind int, _key bigint, a bigint, b bigint"), "near")


def near_links(prints: DataFrame, distance: int = DISTANCE, limit: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``_fp``: enough to connect every pair within ``distance`` (at most
    3) bits, without listing all pairs of a dense group.

    Key of a variant: which half and which deleted bit, and the half without that bit. A bucket above ``limit`` is cut
    again in the same way by its other half (16 of 32 bits, one deleted), and once more (8 of 16). A third-level
    bucket has 53 bits in common, hence at most 2,048 fingerprints: no case is dropped.
    """
    if distance > 3:
        raise ValueError("two segments find pairs of at most 3 differing bits")
    fp = F.col("_fp")

    def variants(bits: int):
        return F.explode(F.sequence(F.lit(0), F.lit(2 * bits - 1)))

    def deleted(half: int, bits: int, wild):
        """The number ``half`` tells, bit ``wild`` of it cleared."""
        return half.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(wild, F.lit(bits)))))

    def part(value, at, bits: int):
        return F.call_function("shiftrightunsigned", value, at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))

    v = F.col("_v")
    first = prints.select("_fp", variants(32).alias("_v")).select(
        "_fp", (F.call_function("shiftleft", v.cast("bigint"), F.lit(32)) + deleted(
            part(fp, F.when(v < 32, 0).otherwise(32), 32), 32, v)).alias("_key"), "_v")
    links = [_linked(first.drop("_v"), distance, limit)]
    for bits in (16, 8):
        over = links[-1].where("kind = 1")
        if over.isEmpty():
            break
        level = F.call_function("shiftrightunsigned", F.col("_key"), F.lit(32)) if bits == 16 else F.col("_level")
        # bits still free: the other 32 at the second level, the other 16 of them at the third
        if bits == 16:
            free = F.when(level < 32, 32).otherwise(0)
            grown = over.select(F.col("a").alias("_fp"), F.col("_key").alias("_up"), free.alias("_from"), variants(16).alias("_v"))
        else:
            grown = over.join(held, (over["_key"] == held["_key"]) & (over["a"] == held["_fp"])).select(
                held["_fp"], held["_key"].alias("_up"), (F.col("_from") + F.when(F.col("_v") < 16, 16).otherwise(0)).alias("_from"),
                variants(8).alias("_w")).withColumnRenamed("_w", "_v")
        value = deleted(part(fp, F.col("_from") + F.when(v < bits, 0).otherwise(bits), bits), bits, v)
        held = grown.distinct().select("_fp", F.xxhash64("_up", "_v", value).alias("_key"), "_from", "_v")
        links.append(_linked(held.select("_key", "_fp"), distance, limit if bits == 16 else None))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found.where("kind = 0").select("a", "b").distinct()


def near_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS,
                    distance: int = DISTANCE) -> DataFrame:
    """Rows (_id, _h, _fp, component_id, _root), one per row of ``docs``: the smallest id reachable over near links, and the
    fingerprint that stands for the component (ids may repeat, it tells components apart).

    Equal fingerprints are one node however many documents share them. Null and blank texts share fingerprint 0 and
    link like any other. A null id is never the smallest; a component of null ids only has a null component_id. The
    text's hash ``_h`` tells rows that repeat an id apart. An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, id_column, text_column, words), "prints")
    nodes = materialize(prints.groupBy("_fp").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")), "nodes")
    roots = components(near_links(nodes.select("_fp"), distance))
    rooted = nodes.join(roots, nodes["_fp"] == roots["node"]).select("_fp", "root", "_first")
    smallest = rooted.groupBy("root").agg(F.min("_first").alias("_least"))
    linked = rooted.join(smallest, "root").select("_fp", "_least", "root")
    copies = nodes.where("_n > 1").join(linked, "_fp", "left_anti").select("_fp", F.col("_first").alias("_least"), F.col("_fp").alias("root"))
    member = materialize(linked.unionByName(copies), "members")
    return prints.join(member, "_fp", "left").select(
        "_id", "_h", "_fp", F.coalesce("_least", "_id").alias("component_id"), F.coalesce("root", "_fp").alias("_root"))
