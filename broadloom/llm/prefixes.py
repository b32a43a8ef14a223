"""Prefix trie of conversations, with count-min screening of prefix digests.

Every prefix of a conversation has a digest: two linear hashes modulo 2^61 - 1 over the hashes of its turns, 122 bits in all.
Digests of joined sequences follow from those of the parts, so that a conversation of any length is hashed in pieces that
lie in different tasks. Of all prefixes a count-min sketch is made. It never counts too low: a prefix whose estimate is
one stands in one conversation only, and its node is told where it is, without a shuffle. Only prefixes that may be shared
are grouped, exactly, by digest; the screening decides what is shuffled, never the result.

Sums over subtrees need no walk over levels. With c's saved bytes V(c), the bytes of the longest prefix that c shares with a
conversation of a smaller id, a node X of parent P saves the sum of V(c) - bytes(P) over its members but the smallest; its
leaves are counted by the smallest member of each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.operators.features import split_join
from broadloom.session import materialize

PRIME = (1 << 61) - 1
BASES = (1_000_000_007 * 911_382_323 % PRIME, 972_663_749 * 1_000_000_009 % PRIME)
INVERSE = tuple(pow(b, -1, PRIME) for b in BASES)
HEADS = 8  # most turns that are taken from another conversation
NODE = ["depth", "d1", "d2"]
DEPTHS = 4  # rows of counters in the sketch
CHUNK = 1 << 16  # counters in a row of the table of sketches
#: Bound of the sketch, which every executor gets: 2 bits a counter. It screens nearly all singletons of up to 16 million
#: prefixes; with more, estimates rise and more prefixes are grouped that need not be.
SKETCH_BYTES = 32 << 20
PIECE = 1 << 16  # ids hashed at a time
PREFIX_SCHEMA = "conv_id bigint, depth bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, bytes bigint, cum bigint, is_end boolean"


# --- digests of all prefixes --------------------------------------------------------------------


def _lists(batch: pa.RecordBatch, names: Iterable[str]) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn -> position and digest within the part of the conversation that this task holds
    (kind 0), and the totals of the first (kind 1) and the last (kind 2) of these parts, which may go on in other tasks."""
    names = ["kind", "block", "conv_id", "j", "s1", "s2", "t1", "t2", "bytes", "cum"]

    def rows(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                           *[pa.array(c, pa.int64()) for c in columns[2:]]], names=names)

    held, closed, block = None, 0, 0

    def total(kind: int) -> pa.RecordBatch:
        return rows([[kind], [block], [held], [j], [s1], [s2], [0], [0], [0], [cum]])

    j = s1 = s2 = cum = 0
    for batch in batches:
        out = [[] for _ in names]
        for conv, t1, t2, size, block in zip(*_lists(batch, ["conv_id", "t1", "t2", "bytes", "block"])):
            if conv != held:
                if held is not None:
                    if not closed:
                        yield total(1)
                    closed += 1
                held, j, s1, s2, cum = conv, 0, 0, 0, 0
            j, cum = j + 1, cum + size
            s1, s2 = (s1 * BASES[0] + t1) % PRIME, (s2 * BASES[1] + t2) % PRIME
            for column, value in zip(out, (0, block, conv, j, s1, s2, t1, t2, size, cum)):
                column.append(value)
        if out[0]:
            yield rows(out)
    if held is not None:
        yield total(2 if closed else 1)


def _carried(edges: list) -> dict[int, tuple]:
    """block -> (conv_id, turns, s1, s2, bytes) of the part of its first conversation that lies in earlier blocks."""
    blocks: dict[int, dict[int, tuple]] = {}
    for r in edges:
        blocks.setdefault(r.block, {})[r.kind] = (r.conv_id, r.j, r.s1, r.s2, r.cum)
    carry, before = {}, None
    for b in sorted(blocks):
        first = blocks[b][1]
        if before is not None and before[0] == first[0]:
            carry[b] = before
            s = [(x * pow(base, first[1], PRIME) + y) % PRIME for x, y, base in zip(before[2:4], first[2:4], BASES)]
            first = (first[0], before[1] + first[1], *s, before[4] + first[4])
        before = blocks[b].get(2, first)
    return carry


def _placed(carry):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early, names = carry.value, ["conv_id", "i", "s1", "s2", "t1", "t2", "bytes", "cum"]
        for batch in batches:
            block, conv, *rest = (batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ["block", "conv_id", "j", "s1", "s2", "t1", "t2", "bytes", "cum"])
            j, s1, s2, cum = rest[0], rest[1], rest[2], rest[6]
            for b in np.unique(block).tolist():
                if b in early:
                    c, turns, x1, x2, size = early[b]
                    for at in np.flatnonzero((block == b) & (conv == c)).tolist():
                        n = int(j[at])
                        s1[at] = (x1 * pow(BASES[0], n, PRIME) + int(s1[at])) % PRIME
                        s2[at] = (x2 * pow(BASES[1], n, PRIME) + int(s2[at])) % PRIME
                        j[at], cum[at] = n + turns, cum[at] + size
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in [conv, *rest]], names=names)
    return run


def turn_states(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, i, s1, s2, t1, t2, bytes, cum): position from 1, digest of the first i turns, hash of the turn, UTF-8
    bytes of its text and of all texts so far.

    Rows are range-shuffled, so that a conversation which holds very many rows lies in several tasks; what each task
    needs of the tasks before it is one row. Texts travel only if turn numbers repeat within a conversation.
    """
    spark = conversations.sparkSession
    source = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    untied = source.groupBy("conv_id", "turn").count().where("count > 1").isEmpty()
    order = [F.lit("").alias(n) if untied else F.col(n) for n in ("role", "text")]
    lanes = [F.pmod(F.xxhash64(*seed, "role", "text"), F.lit(PRIME)) for seed in ([], [F.lit(7)])]
    narrow = source.select("conv_id", "turn", *order, lanes[0].alias("t1"), lanes[1].alias("t2"),
                           F.octet_length("text").cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("_r"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("_r")]
    laid = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id", "t1", "t2", "bytes", F.spark_partition_id().alias("block"))
    chained = materialize(laid.mapInArrow(
        _chained, "kind int, block int, conv_id bigint, j bigint, s1 bigint, s2 bigint, t1 bigint, t2 bigint, bytes bigint, cum bigint"), "chained")
    edges = chained.where("kind > 0").collect()  # two rows a task
    carry = spark.sparkContext.broadcast(_carried(edges))
    return chained.where("kind = 0").drop("kind").mapInArrow(
        _placed(carry), "conv_id bigint, i bigint, s1 bigint, s2 bigint, t1 bigint, t2 bigint, bytes bigint, cum bigint")


def _rebuilt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns behind the inherited ones: the digest of the whole and, one step back, of its parent."""
    for batch in batches:
        out = [[], [], [], []]
        for e, s1, s2, t1, t2, b1, b2, o1, o2 in zip(*_lists(batch, ["_e", "s1", "s2", "t1", "t2", "b1", "b2", "o1", "o2"])):
            for lane, (s, t, b, o) in enumerate(((s1, t1, b1, o1), (s2, t2, b2, o2))):
                d = (s + (b - o) * pow(BASES[lane], e, PRIME)) % PRIME
                out[lane].append(d)
                out[2 + lane].append((d - t) * INVERSE[lane] % PRIME)
        kept = [batch.column(n) for n in ("conv_id", "depth", "bytes", "cum", "is_end")]
        d1, d2, p1, p2 = (pa.array(x, pa.int64()) for x in out)
        yield pa.RecordBatch.from_arrays([kept[0], kept[1], d1, d2, p1, p2, *kept[2:]],
                                         names=["conv_id", "depth", "d1", "d2", "p1", "p2", "bytes", "cum", "is_end"])


def _taken() -> Column:
    """Turns that a conversation inherits."""
    return F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS + 1))


def rebuilt_prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All prefixes of the rebuilt conversations but the empty one (PREFIX_SCHEMA), and the conversations (conv_id, depth)."""
    states = materialize(turn_states(conversations), "states")
    head = F.when(F.col("i") <= HEADS, F.struct("i", "s1", "s2", "bytes", "cum"))
    lengths = states.groupBy("conv_id").agg(F.max("i").alias("n"), F.array_sort(F.collect_list(head)).alias("heads"))
    convs = materialize(lengths, "conversations")
    base = convs.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"), F.col("heads").alias("_heads"))
    joined = convs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "_base", "left").withColumn("h", _taken())
    joined = joined.withColumn("k", F.least("h", F.coalesce("_n", F.lit(0)))).withColumn("_own", F.least("h", "n"))
    zero = F.struct(F.lit(0).cast("bigint").alias("i"), *[F.lit(0).cast("bigint").alias(n) for n in ("s1", "s2", "bytes", "cum")])
    joined = joined.select(
        "conv_id", "h", "k", (F.col("k") + F.col("n") - F.col("_own")).alias("end"), "_heads",
        F.when(F.col("k") > 0, F.get("_heads", F.col("k").cast("int") - 1)).otherwise(zero).alias("_b"),
        F.when(F.col("_own") > 0, F.get("heads", F.col("_own").cast("int") - 1)).otherwise(zero).alias("_o"))
    plan = materialize(joined, "rebuilt")
    early = F.slice("_heads", 1, F.col("k").cast("int"))
    first = plan.where("k > 0").select("conv_id", "end", F.posexplode(F.arrays_zip(early.alias("x"), F.concat(F.array(zero), early).alias("up"))).alias("_at", "_p"))
    first = first.where("_p.x IS NOT NULL").select(
        "conv_id", F.col("_p.x.i").alias("depth"), F.col("_p.x.s1").alias("d1"), F.col("_p.x.s2").alias("d2"), F.col("_p.up.s1").alias("p1"),
        F.col("_p.up.s2").alias("p2"), F.col("_p.x.bytes").alias("bytes"), F.col("_p.x.cum").alias("cum"), (F.col("_p.x.i") == F.col("end")).alias("is_end"))
    consts = plan.select("conv_id", "h", "k", "end", F.col("_b.s1").alias("b1"), F.col("_b.s2").alias("b2"), F.col("_b.cum").alias("bcum"),
                         F.col("_o.s1").alias("o1"), F.col("_o.s2").alias("o2"), F.col("_o.cum").alias("ocum"))
    own = split_join(states, consts, ["conv_id"], "inner").where("i > h").withColumn("_e", F.col("i") - F.col("h"))
    own = own.withColumn("depth", F.col("k") + F.col("_e")).withColumn("cum", F.col("cum") - F.col("ocum") + F.col("bcum")) \
        .withColumn("is_end", F.col("depth") == F.col("end"))
    rest = own.select("conv_id", "depth", "_e", "s1", "s2", "t1", "t2", "b1", "b2", "o1", "o2", "bytes", "cum", "is_end").mapInArrow(_rebuilt, PREFIX_SCHEMA)
    return materialize(first.unionByName(rest), "prefixes"), plan.select("conv_id", F.col("end").alias("depth"))


# --- screening ----------------------------------------------------------------------------------


def pack(counts: np.ndarray) -> np.ndarray:
    """Counters of 0 to 3, four to a byte."""
    c = counts.reshape(-1, 4)
    return c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6


def unpack(packed: np.ndarray) -> np.ndarray:
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def cells(d1: np.ndarray, d2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Place of every digest in each row of counters; ``width`` is a power of two."""
    a, b = d1.view(np.uint64), d2.view(np.uint64) | np.uint64(1)
    a, b = a ^ a >> np.uint64(29), b ^ b >> np.uint64(31)
    for r in range(DEPTHS):
        yield ((a + np.uint64(r) * b) & np.uint64(width - 1)).astype(np.int64) + r * width


def sketch_of(prefixes: DataFrame, limit: int = SKETCH_BYTES) -> tuple[np.ndarray, int]:
    """Packed counters that stop at 2, and the width of a row. Tasks count what they hold, the counters of equal places are
    added chunk by chunk; ``limit`` bounds the sketch, its width follows the prefixes until then."""
    most = 1 << int(math.log2(limit * 4 // DEPTHS))
    width = min(most, max(CHUNK, 1 << (2 * max(prefixes.count(), 1) - 1).bit_length()))

    def rows(chunks: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for at, counts in chunks:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pack(counts).tobytes()], pa.binary())], names=["chunk", "counts"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DEPTHS * width, np.uint8)
        for batch in batches:
            for places in cells(*(batch.column(n).to_numpy(zero_copy_only=False) for n in ("d1", "d2")), width):
                at, n = np.unique(places, return_counts=True)
                total[at] = np.minimum(total[at] + np.minimum(n, 2), 2)
        yield from rows((c, part) for c, part in enumerate(total.reshape(-1, CHUNK)) if part.any())

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for at, counts in zip(*_lists(batch, ["chunk", "counts"])):
                part = unpack(np.frombuffer(counts, np.uint8))
                if at == held:
                    total = np.minimum(total + part, 2)
                    continue
                if held is not None:
                    yield from rows([(held, total)])
                held, total = at, part
        if held is not None:
            yield from rows([(held, total)])

    schema = "chunk int, counts binary"
    parts = prefixes.select("d1", "d2").mapInArrow(count, schema).repartition("chunk").sortWithinPartitions("chunk")
    packed = np.zeros(DEPTHS * width // 4, np.uint8)
    for r in parts.mapInArrow(add, schema).collect():  # at most ``limit`` bytes
        packed[r.chunk * CHUNK // 4:(r.chunk + 1) * CHUNK // 4] = np.frombuffer(r.counts, np.uint8)
    return packed, width


def estimates(packed: np.ndarray, width: int, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """Least counter of every digest: never below its number of occurrences, as far as 2."""
    least = np.full(len(d1), 3, np.uint8)
    for at in cells(d1, d2, width):
        least = np.minimum(least, packed[at >> 2] >> ((at & 3) * 2).astype(np.uint8) & 3)
    return least


def screened(prefixes: DataFrame, limit: int = SKETCH_BYTES) -> DataFrame:
    """Prefixes with ``kind``: 0 proven to stand in one conversation, as its parent is; 1 the same, but its parent may be
    shared; 2 possibly shared."""
    packed, width = sketch_of(prefixes, limit)
    shared = prefixes.sparkSession.sparkContext.broadcast(packed)

    @F.arrow_udf("int")
    def kind(d1: pa.Array, d2: pa.Array, p1: pa.Array, p2: pa.Array, depth: pa.Array) -> pa.Array:
        a, b, c, d, n = (x.to_numpy(zero_copy_only=False) for x in (d1, d2, p1, p2, depth))
        alone = estimates(shared.value, width, a, b) < 2
        rooted = (n == 1) | (estimates(shared.value, width, c, d) > 1)
        return pa.array(np.where(alone, rooted.astype(np.int32), 2).astype(np.int32))

    return materialize(prefixes.withColumn("kind", kind("d1", "d2", "p1", "p2", "depth")), "screened")


# --- nodes --------------------------------------------------------------------------------------


def _listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, conv_id) in order -> pieces of the comma-joined ids of a node, with the first id of each."""
    held, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in (*held, ids[0])], pa.array([",".join(map(str, ids))])],
                                          names=[*NODE, "first", "ids"])

    for batch in batches:
        for *node, conv in zip(*_lists(batch, [*NODE, "conv_id"])):
            if ids and (node != held or len(ids) == PIECE):
                yield piece()
                ids = []
            held = node
            ids.append(conv)
    if ids:
        yield piece()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, state = None, None
    for batch in batches:
        out = [[], [], [], []]
        for *node, ids in zip(*_lists(batch, [*NODE, "ids"])):
            if node == held:
                state.update(b"," + ids.encode())
                continue
            if held is not None:
                for column, value in zip(out, (*held, state.hexdigest())):
                    column.append(value)
            held, state = node, hashlib.sha256(ids.encode())
        if out[0]:
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3])], names=[*NODE, "ends"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in held], pa.array([state.hexdigest()])], names=[*NODE, "ends"])


def id_digests(rows: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of the sorted, comma-joined conv_ids of each node, read as a stream. Ids are joined where a range
    shuffle puts them, so that one task gets pieces of PIECE ids of a node, never single ids."""
    keys = [*NODE, "conv_id"]
    pieces = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _listed, "depth bigint, d1 bigint, d2 bigint, first bigint, ids string")
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return ordered.mapInArrow(_hashed, "depth bigint, d1 bigint, d2 bigint, ends string")


def sha_text(text: Column) -> Column:
    return F.sha2(text.cast("string").cast("binary"), 256)


def prefix_trie(conversations: DataFrame, limit: int = SKETCH_BYTES) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    ``conversations`` has conv_id, turn, role and text. Turns are in order of ``turn``, null first, then of role and text.
    A null role or text is empty; a row without conv_id belongs to no conversation and is left out. Repeated rows are
    turns of their own. Other columns are not read. An empty table has no node, not even a root.
    """
    prefixes, convs = rebuilt_prefixes(conversations)
    told = screened(prefixes, limit)
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), none.alias("p1"), none.alias("p2"),
                        zero.alias("bytes"), zero.alias("cum"), (F.col("depth") == 0).alias("is_end"))
    maybe = told.where("kind = 2").drop("kind").unionByName(root)
    ended = F.col("is_end").cast("int")
    nodes = materialize(maybe.groupBy(*NODE).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n"), F.sum(ended).alias("n_end"), F.min(F.when(F.col("is_end"), F.col("conv_id"))).alias("end"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), (F.min("cum") - F.min("bytes")).alias("above")), "nodes")
    members = materialize(split_join(maybe, nodes.select(*NODE, "least", "n", "n_end"), NODE, "inner").select(
        *NODE, "conv_id", "cum", "is_end", "least", "n", "n_end"), "members")

    # V(c), and whether c counts a leaf: it ends where no turn follows and is the smallest that does
    later = F.col("least") != F.col("conv_id")
    leaf = (F.col("is_end") & ~later & (F.col("n") == F.col("n_end"))).cast("int")
    own = members.select("conv_id", F.when(later, F.col("cum")).otherwise(0).alias("v"), leaf.alias("leaf"))
    alone = told.where("kind < 2 AND is_end").select("conv_id", zero.alias("v"), F.lit(1).alias("leaf"))
    shares = materialize(own.unionByName(alone).groupBy("conv_id").agg(F.max("v").alias("v"), F.max("leaf").alias("leaf")), "shares")
    sums = split_join(members, shares, ["conv_id"], "inner").groupBy(*NODE).agg(
        F.sum("leaf").cast("bigint").alias("n_leaves"), F.sum(F.when(later, F.col("v")).otherwise(0)).alias("_v"))

    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    tops = told.where("kind = 1")
    children = nodes.where("depth > 0").select(*up).unionByName(tops.select(*up)).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    ends = id_digests(members.where("is_end AND n_end > 1").select(*NODE, "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("least").alias("parent"))
    path = ["depth", "p1", "p2"]
    known = split_join(nodes, parents, path).join(sums, NODE).join(children, NODE, "left").join(ends, NODE, "left")
    nothing = sha_text(F.lit(""))
    shared = known.select(
        F.col("least").alias("conv_id"), "depth",
        # a parent that is not grouped was proven to have one conversation, this one
        F.when(F.col("depth") > 0, F.coalesce("parent", "least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("_v") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends", F.when(F.col("n_end") == 1, sha_text(F.col("end"))), nothing).alias("ends_sha256"))
    one = F.lit(1).cast("bigint")

    def single(rows: DataFrame, parent: str) -> DataFrame:
        return rows.select("conv_id", "depth", F.col(parent).alias("parent_conv_id"), one.alias("n_convs"),
                           F.when(F.col("is_end"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
                           F.when(F.col("is_end"), sha_text(F.col("conv_id"))).otherwise(nothing).alias("ends_sha256"))

    return shared.unionByName(single(split_join(tops, parents, path, "inner"), "parent")).unionByName(single(told.where("kind = 0"), "conv_id"))
