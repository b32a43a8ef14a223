"""Benchmark decontamination over a distributed positional inverted index. DataFrame operations only.

The index stores, for every benchmark term, where it stands in every training document. A benchmark window (a run of
words) is searched from its rarest terms: their posting lists, each shifted by the term's offset in the window,
are intersected, and only where they agree are the lists of the other terms looked up. What remains are exact phrase
matches. ``proximity`` intersects the lists of an item's rarest terms within a distance instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.common import ascii_lower, broadcast_if_small, row_key, small_enough
from broadloom.session import materialize

WINDOW = 13
RAREST = 2
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands behind the last word of each document: its posting tells the number of words. No word has a blank.
END = " "


def words(text: Column | str) -> Column:
    """Lower-cased runs of digits, a-z and characters outside ASCII. Null has none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), DELIMITERS), "")


@dataclass
class Index:
    """``postings``: (_id, _h, at), at = position << 32 | term number. ``terms``: (term, number), number 0 is END."""

    postings: DataFrame
    terms: DataFrame
    items: DataFrame

    def lists(self) -> DataFrame:
        return self.postings.select("_id", "_h", F.expr("shiftright(at, 32)").alias("pos"), F.expr("at & 4294967295").alias("number"))


def benchmark_words(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, n, offset, term) per word. ``item`` is the id as a string; items that share an id have their own ``part``."""
    split = benchmark.select(F.col(id_column).cast("string").alias("item"), words(text_column).alias("w")).distinct()
    split = split.select("item", F.xxhash64("item", "w").alias("part"), "w", F.size("w").alias("n"))
    return split.select("item", "part", "n", F.posexplode("w").alias("offset", "term"))


def build_index(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                item_column: str = "item_id", item_text: str = "text") -> Index:
    """Postings of all benchmark terms in all documents, in one pass over the texts and without a shuffle of them."""
    parts = materialize(benchmark_words(benchmark, item_column, item_text), "items")
    # the benchmark's vocabulary: its size does not depend on the corpus
    numbered = parts.select("term").distinct().select("term", F.row_number().over(Window.orderBy("term")).cast("bigint").alias("number"))
    ended = numbered.unionByName(docs.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit(0).cast("bigint").alias("number")))
    terms = materialize(ended, "terms")
    tokens = docs.select(*row_key(id_column, text_column), F.posexplode(F.concat(words(text_column), F.array(F.lit(END)))).alias("pos", "term"))
    postings = tokens.join(broadcast_if_small(terms, 128), "term").select(
        "_id", "_h", (F.expr("shiftleft(cast(pos as bigint), 32)") + F.col("number")).alias("at"))
    return Index(materialize(postings, "postings"), terms, parts)


def windows(index: Index, length: int = WINDOW) -> DataFrame:
    """(part, first, size, offset, number, held, rank): the terms of every window, the corpus's rarest first.

    An item of fewer words is one window. A window with a term that no document has cannot occur and is left out.
    """
    held = index.lists().where("number > 0").groupBy("number").agg(F.count("*").alias("held"))
    counted = index.items.join(index.terms, "term").join(held, "number")
    known = materialize(counted.select("part", "n", "offset", "number", "held"), "counted")
    size = F.least(F.col("n"), F.lit(length))
    starts = F.sequence(F.greatest(F.lit(0), F.col("offset") - size + 1), F.least(F.col("offset"), F.col("n") - size))
    spread = known.select("part", "n", size.alias("size"), F.explode(starts).alias("first"), "offset", "number", "held")
    window = Window.partitionBy("part", "first")
    ranked = spread.select("*", F.count("*").over(window).alias("found"),
                           F.row_number().over(window.orderBy("held", "offset")).alias("rank"))
    return ranked.where("found = size").drop("found")


def phrase_runs(index: Index, length: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """(_id, _h, item, start, stop): maximal runs of document words that are covered by occurring windows of an item
    at one alignment. ``rarest``: posting lists that are intersected before the others are looked up."""
    ranked = materialize(windows(index, length), "windows")
    probes = ranked.where(F.col("rank") <= rarest).select(
        "part", "first", "offset", "number", F.least("size", F.lit(rarest)).alias("need"))
    lists = index.lists().where("number > 0")
    hits = lists.join(broadcast_if_small(probes, 160), "number").select(
        "_id", "_h", "part", "first", (F.col("pos") - F.col("offset")).alias("shift"), "offset", "need")
    # repeated rows of the index count once
    agreed = hits.groupBy("_id", "_h", "part", "first", "shift").agg(
        F.expr("bit_or(shiftleft(1L, offset - first))").alias("met"), F.first("need").alias("need"))
    agreed = agreed.where(F.bit_count("met") == F.col("need")).select("_id", "_h", "part", "shift", "first")
    agreed = materialize(agreed, "agreed")
    texts = ranked.select("part", "first", "offset", "number", "size").distinct()
    wanted = agreed.join(broadcast_if_small(texts, 160), ["part", "first"]).select(
        "_id", "_h", "part", "shift", "offset",
        (F.expr("shiftleft(shift + offset, 32)") + F.col("number")).alias("at")).distinct()
    # the lists of documents with a candidate: a filter on the spot while those fit, else the join itself sorts them out
    near = agreed.select("_id", "_h").distinct()
    postings = index.postings
    if small_enough(near, 48):
        n, p = F.broadcast(near).alias("n"), postings.alias("p")
        postings = p.join(n, F.expr("n._h = p._h and n._id <=> p._id"), "left_semi")
    met = postings.alias("p").join(
        wanted.alias("w").hint("shuffle_hash"), F.expr("w._h = p._h and w.at = p.at and w._id <=> p._id")).select("w.*").distinct()
    line = Window.partitionBy("_id", "_h", "part", "shift").orderBy("offset")
    runs = met.select("*", (F.col("offset") - F.row_number().over(line)).alias("run"))
    runs = runs.groupBy("_id", "_h", "part", "shift", "run").agg(F.min("offset").alias("from"), F.count("*").alias("size"))
    sizes = index.items.select("part", "item", F.least("n", F.lit(length)).alias("least")).distinct()
    kept = runs.join(broadcast_if_small(sizes, 128), "part").where("size >= least")
    start = F.col("shift") + F.col("from")
    return kept.select("_id", "_h", "item", start.alias("start"), (start + F.col("size")).alias("stop"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", length: int = WINDOW, share: int = 20) -> DataFrame:
    """(_id, _h, n_words, n_hit, n_items, items, contaminated) per row of ``docs``.

    A document word is hit if it lies in any occurrence of a benchmark window. ``contaminated``: at least one in
    ``share`` words is hit. Null and empty texts have no words and are clean; an item without words has no window; a null
    item id can mark words but is not listed. Repeated rows each get the same result.
    """
    index = build_index(docs, benchmark, id_column, text_column, item_column, item_text)
    spans = phrase_runs(index, length).groupBy("_id", "_h").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    merged = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("last")),
        lambda a, s: F.struct((a.n + F.greatest(F.lit(0).cast("bigint"), s.stop - F.greatest(s.start, a["last"]))).alias("n"),
                              F.greatest(a["last"], s.stop).alias("last")), lambda a: a.n)
    hit = spans.select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), merged.alias("n_hit"), "items")
    ends = index.lists().where("number = 0").select("_id", "_h", F.col("pos").alias("n_words"))
    out = ends.join(hit, F.expr("_id <=> _i and _h = _g"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("_id", "_h", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), items.alias("items"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def proximity(index: Index, rarest: int = RAREST, slop: int = 50) -> DataFrame:
    """(_id, _h, item, start): places where the ``rarest`` terms of an item all stand within ``slop`` words from ``start`` on,
    in any order. Items with a term that no document has, or with fewer distinct terms, use those there are.
    """
    lists = index.lists().where("number > 0")
    held = lists.groupBy("number").agg(F.count("*").alias("held"))
    known = index.items.join(index.terms, "term").select("part", "item", "number").distinct().join(held, "number")
    order = Window.partitionBy("part", "item").orderBy("held", "number")
    probes = known.select("part", "item", "number", F.row_number().over(order).alias("rank")).where(F.col("rank") <= rarest)
    probes = probes.select("*", F.count("*").over(Window.partitionBy("part", "item")).alias("need"))
    hits = lists.join(broadcast_if_small(probes, 128), "number").distinct()
    ahead = Window.partitionBy("_id", "_h", "part", "item").orderBy("pos").rangeBetween(0, slop - 1)
    met = hits.select("_id", "_h", "item", "pos", "need", F.size(F.collect_set("rank").over(ahead)).alias("met"))
    return met.where("met = need").select("_id", "_h", "item", F.col("pos").alias("start")).distinct()
