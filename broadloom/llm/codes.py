"""Vector codes by product quantisation, fitted by member-resident Lloyd rounds.

A vector is cut into equal parts; each part position has a codebook. Part rows live in a bucketed table in the shared folder,
laid out by their owner (position, entry, salt): the salt spreads an entry that very many parts choose. A round is
one pass without a shuffle of rows: owners sum their resident members, partial sums of an entry's salts are added, and the
new codebooks (positions x entries rows, set by parameters) go through the driver to every owner. Then owners choose anew
for their members; those that stay are written to the next table where they are, and only those that change entry are
shuffled to their new owner.

Every table is written before the one it came from is removed, so a lost executor repeats tasks of one round at most.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.operators.features import split_join
from broadloom.session import materialize, remove_scratch, scratch_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
OWNER = ["position", "entry", "salt"]
#: Members an owner has on average if one entry takes every part of a position.
OWNED = 8192
#: Largest whole component: squared distances of vectors up to 4,096 wide then fit in 64 bits.
LARGEST = 1 << 24
BLOCK = 1 << 13


def finite(vector: str) -> Column:
    """True for an array of at least one component, none of them null, NaN or infinite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def whole_components(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; beyond LARGEST it is an error."""
    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) <= LARGEST, y).otherwise(
            F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}"))).cast("int")
    return F.transform(vector, whole)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``book`` (equal distances: the lower) and the squared distance, in whole numbers."""
    at, far = np.empty(len(x), np.int32), np.empty(len(x), np.int64)
    book = book.astype(np.int64)
    lengths = (book * book).sum(axis=1)
    for i in range(0, len(x), BLOCK):
        part = x[i:i + BLOCK].astype(np.int64)
        d = lengths - 2 * (part @ book.T)
        best = d.argmin(axis=1)
        at[i:i + BLOCK] = best
        far[i:i + BLOCK] = d[np.arange(len(part)), best] + (part * part).sum(axis=1)
    return at, far


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 1), np.int32)


def first_entries(whole: Column, books: np.ndarray) -> Column:
    """Entry of every part of a whole vector: array<int>."""
    parts, _, width = books.shape

    @F.arrow_udf("array<int>")
    def choose(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        chosen = np.empty((len(x), parts), np.int32)
        for p in range(parts if len(x) else 0):
            chosen[:, p] = nearest(x[:, p * width:(p + 1) * width], books[p])[0]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts), pa.array(chosen.ravel()))

    return choose(whole)


def part_entry(position: str, member: str, books: np.ndarray) -> Column:
    """Nearest entry of a part row and its squared distance: struct<entry, error>."""
    @F.arrow_udf("struct<entry: int, error: bigint>")
    def choose(positions: pa.Array, members: pa.Array) -> pa.Array:
        x, p = _matrix(members), positions.to_numpy(zero_copy_only=False)
        entry, error = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
        for k in np.unique(p):
            here = p == k
            entry[here], error[here] = nearest(x[here], books[k])
        return pa.StructArray.from_arrays([pa.array(entry), pa.array(error)], names=["entry", "error"])

    return choose(F.col(position), F.col(member))


class _Residents:
    """Part rows (row, position, entry, salt, member) in buckets of their owner."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name, self.path = f"residents_{uuid.uuid4().hex}", scratch_path(spark, "residents")

    def add(self, parts: DataFrame) -> None:
        parts.write.format("parquet").mode("append").bucketBy(self.buckets, *OWNER).option("path", self.path).saveAsTable(self.name)

    def arrive(self, parts: DataFrame) -> None:
        self.add(parts.repartition(self.buckets, *OWNER))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def remove(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        remove_scratch(self.spark, self.path)


def _updated(residents: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry becomes the floor of its members' mean. Owners sum what they hold, then salts are added."""
    width = books.shape[2]
    sums = [F.sum(F.col("member")[i].cast("bigint")).alias(f"s{i}") for i in range(width)]
    owned = residents.groupBy(*OWNER).agg(F.count("*").alias("n"), *sums)
    whole = owned.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    books = books.copy()
    for r in whole.collect():  # one row per entry
        books[r.position, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def lloyd_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS,
                entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, owned: int = OWNED,
                carry: Sequence[str] = ()) -> tuple[DataFrame, np.ndarray]:
    """Rows (_row, id, the columns of ``carry``, entries array<int>, error), and the codebooks (parts, entries, width) in
    whole numbers. Other columns of ``vectors``, whatever their names, are neither read nor returned.

    A row goes if its vector is null, empty, or holds a null, NaN or infinite component. The other vectors must be of one
    length, a multiple of ``parts``, else ValueError; a component beyond LARGEST / ``scale`` is an error. Codebooks
    start as the parts of the ``entries`` smallest ids (null ids last; equal ids by their components): fewer vectors
    give smaller codebooks, repeated vectors repeated entries, of which the first is used. Rows that repeat an id or
    everything stay rows of their own. An empty table gives no rows and empty codebooks.
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    named = [id_column, *carry]
    kept = materialize(vectors.where(finite(vector_column)).select(
        F.monotonically_increasing_id().alias("_row"), *named, whole_components(vector_column, scale).alias("_whole")), "whole")
    size = kept.agg(F.count("*").alias("n"), F.min(F.size("_whole")).alias("a"), F.max(F.size("_whole")).alias("b")).first()
    if not size.n:
        empty = kept.select("_row", *named, F.array().cast("array<int>").alias("entries"), F.lit(0).cast("bigint").alias("error"))
        return empty, np.empty((parts, 0, 0), np.int64)
    if size.a != size.b or size.a % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {size.a} to {size.b}")
    width = size.a // parts
    first = kept.orderBy(F.col(id_column).asc_nulls_last(), "_whole").select("_whole").limit(entries).collect()
    books = np.array([r._whole for r in first], np.int64).reshape(-1, parts, width).transpose(1, 0, 2)

    salts = -(-size.n // owned)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.n * parts // (64 * owned)))
    salt = F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int").alias("salt")
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("_whole", p * width + 1, width))
    begun = kept.select("_row", F.posexplode(F.arrays_zip(first_entries(F.col("_whole"), books).alias("e"), cut.alias("m")))
                        .alias("position", "_p")).select("_row", "position", F.col("_p.e").alias("entry"), salt, F.col("_p.m").alias("member"))
    homes = _Residents(spark, buckets)
    homes.arrive(begun)
    for last in [*[False] * (rounds - 1), True] if rounds else []:
        books = _updated(homes.table(), books)
        if last:
            break
        judged = homes.table().withColumn("_new", part_entry("position", "member", books)["entry"])
        after = _Residents(spark, buckets)
        after.add(judged.where("_new = entry").drop("_new"))
        after.arrive(judged.where("_new <> entry").select("_row", "position", F.col("_new").alias("entry"), "salt", "member"))
        homes.remove()
        homes = after
    told = homes.table().select("_row", "position", part_entry("position", "member", books).alias("_f"))
    codes = told.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("position", "_f.entry"))).alias("_c"), F.sum("_f.error").alias("error"))
    done = materialize(kept.drop("_whole").join(codes.select("_row", F.col("_c.entry").alias("entries"), "error"), "_row"), "codes")
    homes.remove()
    return done, books


def code_text(entries: str) -> Column:
    """Two hex digits per part."""
    return F.array_join(F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")


def label_errors(coded: DataFrame, label_column: str = "label") -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows of its label, null labels together."""
    sums = materialize(coded.groupBy(label_column).agg(F.sum("error").alias("label_error")), "labels")
    return split_join(coded, sums, [label_column], "inner", null_safe=True)
