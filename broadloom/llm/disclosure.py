"""Personal data: patterns, and terms that disclose it by corpus co-occurrence.

Base spans are found by fixed patterns. Each distinct value found is a protected entity. A term in a document of an
entity discloses it as far as knowing the term tells the entity: the pointwise mutual information of term and entity over
the corpus, as a share of the entity's own information (1: the term alone gives it away), less a penalty for few texts.
Terms above the upper threshold are removed with the entity, terms between the thresholds are replaced by their kind.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import broadcast_if_small, map_texts, pieces, small_enough
from broadloom.session import materialize

# The patterns of the base spans, in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")

#: Chance by which the share of a term's texts that hold the entity may lie below the share taken: both of n texts give DOUBT ** (1 / n).
DOUBT = 0.2
REMOVE = 0.9
GENERALISE = 0.7
TERM = re.compile(r"[^\W\d_]{3,}")
#: Terms that a task counts before it sends them.
HELD = 200000
#: Bytes of text that a task holds decoded at a time, as each may carry places of all its terms.
PIECE = 1 << 20


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of EMAIL, found from each @ so that words without one cost nothing."""
    at, floor = text.find("@"), 0
    while at >= 0:
        end = DOMAIN.match(text, at + 1)
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if end and start < at:
            yield start, end.end()
            floor = end.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, by start and kind. Failing matches are dropped, not retried."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if any(d in text for d in "0123456789"):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return sorted(found)


def words(text: str, spans: list[tuple[int, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Places of each term of the whole text, but for those that overlap a base span."""
    out, at, last = defaultdict(list), 0, 0
    for m in TERM.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():  # spans by start: the furthest end of those that start before the term's end
            last, at = max(last, spans[at][2]), at + 1
        if last <= m.start():
            out[m.group().lower()].append(m.span())
    return out


SPAN = "struct<start:int,`end`:int,kind:string>"
WORD = "struct<term:string,at:array<struct<start:int,`end`:int>>>"


def find_base(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(_id, _h, _t, spans, entities, words), one row per row of ``docs``: base spans in code points, and where there are any, the
    distinct entities and the places of all terms. ``_t`` is a hash of the text by which copies are known, null without a text."""
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            spans, entities, places = [], [], []
            for text in batch.column("_text").to_pylist():
                found = base_spans(text) if text else []
                spans.append([{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in found])
                entities.append(sorted({f"{KINDS[k]}:{text[s:e].lower()}" for s, k, e in found}))
                places.append([{"term": t, "at": [{"start": s, "end": e} for s, e in at]} for t, at in words(text, found).items()] if found else [])
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), batch.column("_h"), batch.column("_t"),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))),
                pa.array(entities, pa.list_(pa.string())),
                pa.array(places, pa.list_(pa.struct([("term", pa.string()), ("at", pa.list_(place))]))),
            ], names=["_id", "_h", "_t", "spans", "entities", "words"])

    kind = docs.schema[id_column].dataType.simpleString()
    mark = F.when(F.col(text_column).isNotNull(), F.xxhash64(text_column))
    source = docs.select(F.col(id_column).alias("_id"), F.hash(text_column).alias("_h"), mark.alias("_t"), F.col(text_column).alias("_text"))
    return map_texts(source, run, f"_id {kind}, _h int, _t bigint, spans array<{SPAN}>, entities array<string>, words array<{WORD}>")


def term_documents(docs: DataFrame, repeated: DataFrame, text_column: str = "text") -> DataFrame:
    """(term, held): in how many distinct texts of the whole corpus each term stands. ``repeated``: (_t, copies) of the texts that
    have copies, each of which counts by its share. Tasks count before they send: a row a term and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.float64())], names=["term", "n"])

        held: defaultdict = defaultdict(float)
        for batch in pieces(batches, "_text"):
            for text, copies in zip(batch.column("_text").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                share = 1.0 / (copies or 1)
                for term in {t.lower() for t in set(TERM.findall(text))}:
                    held[term] += share
                if len(held) > HELD:
                    yield sent()
                    held.clear()
        yield sent()

    source = docs.where(F.col(text_column).isNotNull()).select(F.col(text_column).alias("_text"), F.xxhash64(text_column).alias("_t"))
    shared = source.join(broadcast_if_small(repeated, 24), "_t", "left").select("_text", "copies")
    return map_texts(shared, run, "term string, n double").groupBy("term").agg(F.round(F.sum("n")).cast("bigint").alias("held"))


def disclosing(found: DataFrame, docs: DataFrame, text_column: str = "text", generalise: float = GENERALISE, remove: float = REMOVE,
               doubt: float = DOUBT) -> DataFrame:
    """(_t, extra): places and kinds (``term`` to remove, ``near`` to generalise) of the terms that disclose an entity of the text,
    per distinct text of ``found`` that has any. A term and an entity meet if one text holds both, at any distance.

    All counts are of distinct texts over the whole corpus, so that a passage spread by copying discloses no more than one
    text would. The share of the term's texts that hold the entity is taken low by the factor ``doubt`` ** (1 / texts):
    where all of them do, that is its exact lower confidence limit. So pairs of any count are scored.

    Entities of the same texts have the same scores and are scored as one group. Terms that stand in too many texts to
    reach ``generalise`` with any entity of a text, even if they meet it in all its texts, are left out before pairs are made.
    """
    copies = found.where("_t is not null").groupBy("_t").agg(F.count("*").alias("copies"))
    whole = float(copies.count() + 1)
    repeated = materialize(copies.where("copies > 1"), "repeated")
    told = found.where(F.size("entities") > 0).select("_t", "entities", "words").join(broadcast_if_small(repeated, 24), "_t", "left")
    again = told.where("copies is not null").drop("copies").dropDuplicates(["_t"])  # only texts with copies are shuffled
    once = materialize(told.where("copies is null").drop("copies").unionByName(again), "once")
    each = once.select("_t", F.explode("entities").alias("entity"))
    groups = each.groupBy("entity").agg(F.count("*").alias("own"), F.bit_xor("_t").alias("x"), F.sum(F.hash("_t").cast("bigint")).alias("s"))
    groups = materialize(each.join(groups, "entity").select("_t", F.struct("own", "x", "s").alias("group")).distinct(), "groups")
    of_text = groups.groupBy("_t").agg(F.collect_list("group").alias("groups"), F.max("group.own").cast("double").alias("most"))
    held = materialize(term_documents(docs, repeated, text_column), "held")

    def low(both: F.Column) -> F.Column:
        return F.log(both) + F.lit(math.log(doubt)) / both

    def can(most: F.Column) -> F.Column:
        return F.log(F.col("held").cast("double")) <= low(most) + F.lit(1.0 - generalise) * F.log(F.lit(whole) / most) + 1e-6

    terms = once.join(of_text.select("_t", "most"), "_t").select("_t", "most", F.explode("words").alias("w")).select("_t", "most", "w.term", "w.at")
    top = F.lit(of_text.agg(F.max("most")).first()[0]).cast("double")
    common = held.where(~can(top)).select("term")
    if small_enough(common, 64):  # most words of a text: they need no shuffle
        terms = terms.join(F.broadcast(common), "term", "left_anti")
    rare = materialize(terms.join(held, "term").where(can(F.col("most"))).join(of_text.drop("most"), "_t").select("_t", "groups", "term", "at", "held"), "rare")
    pairs = rare.select("term", "held", F.explode("groups").alias("group")).groupBy("group", "term").agg(
        F.count("*").cast("double").alias("both"), F.max("held").cast("double").alias("held"))
    information = F.log(F.lit(whole) / F.col("group.own"))
    score = (information + low(F.col("both")) - F.log("held")) / information
    told = pairs.select("group", "term", score.alias("disclosure")).where(F.col("disclosure") >= generalise)
    told = told.select("group", "term", F.when(F.col("disclosure") >= remove, "term").otherwise("near").alias("kind"))
    marked = rare.select("_t", "term", "at", F.explode("groups").alias("group")).join(told, ["group", "term"])
    spans = marked.groupBy("_t", "term").agg(F.max("kind").alias("kind"), F.first("at").alias("at")).select("_t", "kind", F.explode("at").alias("p"))
    return spans.groupBy("_t").agg(F.collect_list(F.struct(F.col("p.start").alias("start"), F.col("p.end").alias("end"), "kind")).alias("extra"))


def sensitive_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    generalise: float = GENERALISE, remove: float = REMOVE, doubt: float = DOUBT) -> DataFrame:
    """(_id, _h, base, spans) per row of ``docs``: base spans, and all spans with every place of the terms that disclose their
    entities (kinds ``term`` to remove, ``near`` to generalise). Ordered by start, then kind. Null and empty texts have none.
    Repeated rows each get their spans.
    """
    found = materialize(find_base(docs, id_column, text_column), "base")
    extra = materialize(disclosing(found, docs, text_column, generalise, remove, doubt), "told")
    rank = {k: i for i, k in enumerate((*KINDS, "near", "term"))}
    order = F.create_map(*[F.lit(x) for k, i in rank.items() for x in (k, i)])
    joined = found.where(F.size("spans") > 0).select("_id", "_h", "_t", "spans").join(extra, "_t", "left")
    every = F.concat("spans", F.coalesce("extra", F.array().cast(f"array<{SPAN}>")))
    keyed = F.array_sort(F.transform(every, lambda s: F.struct(s.start.alias("start"), order[s.kind].alias("rank"), s["end"].alias("end"), s.kind.alias("kind"))))
    some = joined.select("_id", "_h", F.col("spans").alias("base"),
                         F.transform(keyed, lambda s: F.struct(s.start.alias("start"), s["end"].alias("end"), s.kind.alias("kind"))).alias("spans"))
    return some.unionByName(found.where(F.size("spans") == 0).select("_id", "_h", F.col("spans").alias("base"), "spans"))


def listed(spans: str):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: list) -> str:
    """Text with base spans replaced by their kind in brackets, disclosing terms removed or generalised.
    Overlapping spans are replaced together by the first of them."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], "" if kind == "term" else "[TERM]" if kind == "near" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **parameters) -> DataFrame:
    """``docs`` with its sensitive spans masked in the text; all columns and rows are kept."""
    spans = sensitive_spans(docs, id_column, text_column, **parameters).where(F.size("spans") > 0).select(
        F.col("_id").alias("_i"), F.col("_h").alias("_g"), listed("spans").alias("_spans")).dropDuplicates(["_i", "_g"])
    clean = F.hash(text_column)
    joined = docs.join(spans, docs[id_column].eqNullSafe(F.col("_i")) & (clean == F.col("_g")), "left")

    @F.pandas_udf("string")
    def mask(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if not f else masked(t, [(int(s), int(e), k) for k, s, e in (x.split(":") for x in f.split(","))])
                          for t, f in zip(text, found, strict=True)], dtype=object)

    return joined.withColumn(text_column, F.when(F.col("_spans").isNull(), F.col(text_column)).otherwise(mask(text_column, "_spans"))).select(*docs.columns)
