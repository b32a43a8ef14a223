"""Best-fit packing of token pieces by a configuration linear program.

The program runs over the histogram of lengths, whose size depends on the sequence length and not on the data: a
configuration is a multiset of length groups that fits a sequence; multiplicative weights raise the prices of groups that
are still short, and a knapsack dynamic program finds the configuration worth most at these prices. The averaged
solution is rounded down, its groups are filled with exact lengths, and what is left goes where it fits best. The plan
is then dealt out to the pieces by their rank among those of equal length, in Spark.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import map_texts, pieces
from broadloom.session import materialize

CAPACITY = 2048
GROUPS = 96
ROUNDS = 400
SALTS = 64
_STATE: dict = {}


class ByteBpe:
    """Encoder of a ``tokenizers`` byte-level BPE file. Text runs through the faster ``tiktoken`` with the same merges
    where its rank file is given; special tokens and texts it refuses go the slow way, with equal ids."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.slow = None  # loaded when it is needed: it takes as much memory as the fast one
        self.path = tokenizer_path
        with open(tokenizer_path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # its regex engine gives up on some very long runs
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return self.slow.encode(text, add_special_tokens=False).ids


def public_encoder() -> ByteBpe:
    """The public 50k byte BPE of the machine; loaded once per process."""
    if "bpe" not in _STATE:
        import public_tokenizers as public

        _STATE["bpe"] = ByteBpe(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return _STATE["bpe"]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, behind a first that may be shorter."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def tokenised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
              encoder=public_encoder, end: int = 0) -> DataFrame:
    """(_id, _h, piece, start, length, crc) per piece: the document's ids with ``end`` behind, cut at ``capacity``.
    A null or empty text is the single id ``end``. Token ids are not kept; ``crc`` is their CRC-32."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder()
        for batch in pieces(batches, "_text"):
            row, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                ids = np.array([*(bpe.encode(text) if text else ()), end], "<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    number.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n]))
            taken = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("_id").take(taken), batch.column("_h").take(taken), pa.array(number, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["_id", "_h", "piece", "start", "length", "crc"])

    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("_id"), F.hash(text_column).alias("_h"), F.col(text_column).alias("_text"))
    return map_texts(source, run, f"_id {kind}, _h int, piece int, start bigint, length bigint, crc bigint")


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> list[int]:
    """Multiset of items (indices) of the highest total price within the capacity, by dynamic programming."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    s, p = sizes[order], prices[order]
    for room in range(int(s[0]), capacity + 1):
        n = int(np.searchsorted(s, room, "right"))
        value = best[room - s[:n]] + p[:n]
        k = int(value.argmax())
        if value[k] > best[room - 1]:
            best[room], pick[room] = value[k], k
        else:
            best[room] = best[room - 1]
    out, room = [], capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            out.append(int(order[pick[room]]))
            room -= int(s[pick[room]])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Approximate solution of the configuration program: how often each configuration is used.

    Covering by multiplicative weights: in every round the knapsack answers the present prices, its configuration gets an
    equal part of the sequences, and the price of a group falls with the part of its demand that is covered so far.
    """
    bound = float(sizes @ demand) / capacity
    covered = np.zeros(len(sizes))
    used: dict[tuple, float] = {}
    rate = np.log(len(sizes) + 1.0) * 2
    for t in range(rounds):
        behind = (t + 1) / rounds - covered / demand
        prices = sizes / capacity * np.exp(np.clip(rate * rounds / 16 * behind, -60, 60) / (1 + rounds / 64))
        chosen = tuple(sorted(knapsack(sizes, prices, capacity)))
        used[chosen] = used.get(chosen, 0.0) + bound / rounds
        np.add.at(covered, list(chosen), bound / rounds)
    return used


def _exact(config: tuple, members: list[list[int]], left: dict[int, int], stock: list[int], capacity: int) -> tuple[int, ...]:
    """Lengths for one use of a configuration: the longest there are of each group, and for the last place, whatever
    length fits best. Empty if a group has run out."""
    lengths: list[int] = []
    for g in sorted(config, reverse=True)[:-1]:
        n = next((n for n in members[g] if left[n] > lengths.count(n)), None)
        if n is None:
            return ()
        lengths.append(n)
    room = capacity - sum(lengths)
    at = bisect_left(stock, room + 1) - 1
    while at >= 0 and left[stock[at]] <= lengths.count(stock[at]):
        at -= 1
    return (*lengths, stock[at]) if at >= 0 else ()


def pack_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, rounds: int = ROUNDS) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths in one sequence) for a histogram of lengths; uses every length as often as it occurs.

    Lengths above a sixteenth of the capacity go through the program, in groups of equal mass rounded up to their
    longest; the short ones fill what is left over, longest first, each where it fits best. The work depends on the
    number of different lengths only. Where best fit alone (``groups`` 0) needs fewer sequences, its plan is taken.
    """
    if groups:
        alone = pack_plan(histogram, capacity, 0)
        program = _rounded(histogram, capacity, groups, rounds)
        return min(program, alone, key=lambda plan: sum(run for run, _ in plan))
    return _rounded(histogram, capacity, 0, 0)


def _rounded(histogram: dict[int, int], capacity: int, groups: int, rounds: int) -> list[tuple[int, tuple[int, ...]]]:
    """The program's solution rounded to whole sequences, what is left put where it fits best."""
    left = {n: c for n, c in histogram.items() if c}
    plan: list[tuple[int, tuple[int, ...]]] = []
    if capacity in left:
        plan.append((left.pop(capacity), (capacity,)))
    large = sorted(n for n in left if n > capacity // 16)
    if large and groups:
        counts = np.array([left[n] for n in large], float)
        part = np.minimum((np.cumsum(counts) - counts / 2) / counts.sum() * groups, groups - 1).astype(int)
        members = [[n for n, g in zip(large, part, strict=True) if g == k][::-1] for k in sorted(set(part))]
        sizes = np.array([m[0] for m in members])
        demand = np.array([float(sum(left[n] for n in m)) for m in members])
        used = configurations(sizes, demand, capacity, rounds)
        stock = sorted(left)
        for config, amount in sorted(used.items(), key=lambda x: (-x[1], x[0])):
            repeats = int(amount)
            while repeats > 0:
                lengths = _exact(config, members, left, stock, capacity)
                if not lengths:
                    break
                run = min(repeats, *(left[n] // lengths.count(n) for n in lengths))
                plan.append((run, lengths))
                repeats -= run
                for n in set(lengths):
                    left[n] -= lengths.count(n) * run
                    if not left[n]:
                        stock.pop(bisect_left(stock, n))
    room: dict[int, list[list]] = {}  # free tokens -> [repeats, lengths] of open sequences
    for run, lengths in plan:
        room.setdefault(capacity - sum(lengths), []).append([run, lengths])
    free = sorted(room)

    def put(gap: int, entry: list) -> None:
        if gap not in room:
            room[gap] = []
            insort(free, gap)
        room[gap].append(entry)

    for n in sorted(left, reverse=True):
        while left[n]:
            at = bisect_left(free, n)
            if at == len(free):
                per = capacity // n
                whole = left[n] // per
                if whole:
                    put(capacity - per * n, [whole, (n,) * per])
                    left[n] -= whole * per
                if left[n]:
                    put(capacity - left[n] * n, [1, (n,) * left[n]])
                    left[n] = 0
                continue
            gap = free[at]
            run, lengths = room[gap].pop()
            if not room[gap]:
                del room[gap]
                free.pop(at)
            fit = gap // n
            if run * fit <= left[n]:
                put(gap - fit * n, [run, lengths + (n,) * fit])
                left[n] -= run * fit
            else:
                many, rest = divmod(left[n], fit)
                if many:
                    put(gap - fit * n, [many, lengths + (n,) * fit])
                if rest:
                    put(gap - rest * n, [1, lengths + (n,) * rest])
                if run - many - bool(rest):
                    put(gap, [run - many - bool(rest), lengths])
                left[n] = 0
    return [(run, lengths) for gap in sorted(room) for run, lengths in room[gap]]


def ranked_by_length(found: DataFrame, salts: int = SALTS) -> DataFrame:
    """Adds ``rank`` among pieces of equal length, from 0. Two levels: any one length is spread over ``salts`` windows."""
    salted = found.withColumn("_salt", F.pmod(F.hash("_id", "_h", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("_id", "_h", "piece")
    # at most capacity x salts rows
    return salted.withColumn("_r", F.row_number().over(inside) - 1).join(F.broadcast(offsets), ["length", "_salt"]).select(
        *found.columns, (F.col("_r") + F.col("_before")).alias("rank"))


def packed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
           encoder=public_encoder) -> DataFrame:
    """(_id, _h, piece, start, length, crc, sequence_id, offset): every piece of every document has a place.

    Sequence ids run from 0; pieces lie in a sequence without gaps from offset 0. Ties of equal length are dealt in
    order of a hash, then id. An empty table gives no rows; repeated rows are packed as often as they stand there.
    """
    found = materialize(tokenised(docs, id_column, text_column, capacity, encoder), "pieces")
    # at most ``capacity`` rows
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, first, taken = [], 0, {}
    for run, lengths in pack_plan(histogram, capacity):
        spots: dict[int, list[int]] = {}
        at = 0
        for n in lengths:
            spots.setdefault(n, []).append(at)
            at += n
        for n, offsets in spots.items():
            low = taken.get(n, 0)
            slots.append((n, low, low + run * len(offsets), first, offsets))
            taken[n] = low + run * len(offsets)
        first += run
    # ranges of the plan: their number is bounded by that of different lengths, not of pieces
    by_length: dict[int, list] = {}
    for n, *rest in slots:
        by_length.setdefault(n, []).append(tuple(rest))
    lookup = {n: (np.array([p[0] for p in v]), v) for n, v in by_length.items()}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for n, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                lows, places = lookup[n]
                low, _, start, offsets = places[int(np.searchsorted(lows, rank, "right")) - 1]
                sequence.append(start + (rank - low) // len(offsets))
                offset.append(offsets[(rank - low) % len(offsets)])
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "rank"]
            names = [name for name in batch.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return ranked_by_length(found).mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
