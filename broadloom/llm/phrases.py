"""Lempel-Ziv phrase fingerprints.

A text is parsed left to right into the shortest phrases not met before (LZ78). The set of phrases is hashed; the
fingerprint is its smallest hash values. The share of common values among the smallest of two sets estimates
their Jaccard similarity, which behaves like a compression distance (Raff & Nicholas 2017).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import pieces

SIZE = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK = 1 << 18
_STATE: dict = {}


def parse(text: str, seen: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases from ``start`` on; ``seen`` gets them. A last phrase that is known already adds nothing.

    All beginnings of a phrase are phrases too, so the search for the first unknown one may start anywhere: it starts at the
    length of the phrase before, which is near."""
    ends, i, n, size, add = [], start, len(text), 1, seen.add
    while i < n:
        j = min(i + size, n)
        phrase = text[i:j]
        if phrase in seen:
            while phrase in seen:
                if j == n:
                    return ends
                j += 1
                phrase = text[i:j]
        else:
            while j > i + 1:
                shorter = text[i:j - 1]
                if shorter in seen:
                    break
                phrase = shorter
                j -= 1
        add(phrase)
        ends.append(j)
        size = j - i
        i = j
    return ends


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if "powers" not in _STATE:
        n = 2 * BLOCK
        _STATE["powers"] = tuple(np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64)))) for b in (BASE, INVERSE))
    return _STATE["powers"]


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """32-bit hash of every phrase: a polynomial of its code points, mixed. Depends on the phrase only."""
    out, at, power = [], 0, _powers()
    stop = np.asarray(ends, np.int64)
    start = np.concatenate(([0], stop[:-1])) if len(stop) else stop
    while at < len(stop):
        low = int(start[at])
        till = max(at + 1, int(np.searchsorted(stop, low + BLOCK, "right")))
        codes = np.frombuffer(text[low:int(stop[till - 1])].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        # a phrase of more than BLOCK characters would need a text of BLOCK ** 2 / 2
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power[0][:len(codes)])))
        s, e = start[at:till] - low, stop[at:till] - low
        out.append((sums[e] - sums[s]) * power[1][s])
        at = till
    h = np.concatenate(out) if out else np.empty(0, np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.uint32)


def signature(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest different hashes, ascending; fewer if the set is smaller."""
    if len(hashes) > 4 * size:  # mostly different: the smallest 2 * size of them will do
        found = np.unique(np.partition(hashes, 2 * size)[:2 * size])
        if len(found) >= size:
            return found[:size]
    return np.unique(hashes)[:size]


def fingerprint(text: str, size: int = SIZE) -> np.ndarray:
    return signature(phrase_hashes(text, parse(text, set())), size)


def similarity(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of two phrase sets, exact if both are no larger than ``size``. Empty sets are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    one, other = set(a.tolist()), set(b.tolist())
    union = sorted(one | other)[:size]
    return len((one & other).intersection(union)) / len(union)


def shown(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


class Parsed:
    """A text with its phrases and fingerprint."""

    def __init__(self, text: str, size: int = SIZE):
        self.text = text
        seen: set[str] = set()
        ends = parse(text[:len(text) - len(text) // 2], seen)  # phrases that end before the change
        self.shared, self._seen = len(ends), frozenset(seen)
        self.ends = ends + parse(text, seen, ends[-1] if ends else 0)
        self.hashes = phrase_hashes(text, self.ends)
        self.print = signature(self.hashes, size)

    def edited(self, follower: str, size: int = SIZE) -> tuple[str, np.ndarray]:
        """The text with its second half replaced by the follower's beginning, and its fingerprint. Phrases that end
        before the change are not parsed again."""
        text, half = self.text, len(self.text) // 2
        keep = len(text) - half
        edited = text[:keep] + follower[:half]
        first = self.ends[self.shared - 1] if self.shared else 0
        more = phrase_hashes(edited[first:], [e - first for e in parse(edited, set(self._seen), first)])
        return edited, signature(np.concatenate((self.hashes[:self.shared], more)), size)


def with_follower(docs: DataFrame, id_column: str, text_column: str, blocks: int | None = None) -> DataFrame:
    """(_block, _ghost, _id, _text), each block sorted by id: a block's last row is the first row of the block behind it
    (marked _ghost), that of the last block the first row of all. Null ids come first, equal ids in order of their text.

    Cuts only balance the blocks. The driver sees one id a block.
    """
    count = blocks or max(1, docs.rdd.getNumPartitions())
    base = docs.select(F.col(id_column).cast("bigint").alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    order = F.coalesce(F.col("_id"), F.lit(-(1 << 63)).cast("bigint"))
    ids = docs.select(F.col(id_column).cast("bigint").alias("_id")).select(order.cast("double").alias("_o"), order.alias("_k"))
    found = ids.approxQuantile("_o", [i / count for i in range(1, count)], 1 / (4 * count)) if count > 1 else []
    splits = [float("-inf"), *sorted({e for e in found if e > -9e18}), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    cut = Bucketizer(splits=splits, inputCol="_o", outputCol="_b")
    firsts = sorted((int(r._b), r._k) for r in cut.transform(ids).groupBy("_b").agg(F.min("_k").alias("_k")).collect())
    ghosts = docs.sparkSession.createDataFrame(
        [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)], "_k bigint, _before int")
    placed = cut.transform(base.withColumn("_o", order.cast("double"))).select(F.col("_b").cast("int").alias("_block"), order.alias("_k"), "_id", "_text")
    tagged = placed.join(F.broadcast(ghosts), "_k", "left")  # one row a block
    both = F.array(F.struct(F.col("_block").alias("_block"), F.lit(False).alias("_ghost")), F.struct(F.col("_before").alias("_block"), F.lit(True).alias("_ghost")))
    own = F.array(F.struct(F.col("_block").alias("_block"), F.lit(False).alias("_ghost")))
    spread = tagged.select(F.explode(F.when(F.col("_before").isNull(), own).otherwise(both)).alias("x"), "_id", "_text").select("x.*", "_id", "_text")
    return spread.repartition(count, "_block").sortWithinPartitions("_block", "_ghost", F.col("_id").asc_nulls_first(), "_text")


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE,
                        blocks: int | None = None) -> DataFrame:
    """(_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``.

    The follower of a document is the next by id (null ids first, equal ids by text), of the last the first; a single row
    follows itself. Null texts are empty. An empty table gives no rows.
    """

    def row(i, own: Parsed, follower: Parsed):
        edited, changed = own.edited(follower.text, size)
        return (i, len(own.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), shown(own.print), shown(changed),
                similarity(own.print, changed, size), similarity(own.print, follower.print, size))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, id, text) that waits for its follower
        for batch in pieces(batches, "_text"):
            out = []
            for block, ghost, i, text in zip(*(batch.column(c).to_pylist() for c in ("_block", "_ghost", "_id", "_text")), strict=True):
                waits = held is not None and held[0] == block
                if waits or not ghost:
                    parsed = Parsed(text, size)
                if waits:
                    out.append(row(*held[1:], parsed))
                held = None if ghost else (block, i, parsed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True) if out else [[]] * len(KINDS), KINDS.values(), strict=True)], names=list(KINDS))

    kind = "_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_follower(docs, id_column, text_column, blocks).mapInArrow(run, kind)


KINDS = {"_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
         "near_edited": pa.float64(), "near_next": pa.float64()}
