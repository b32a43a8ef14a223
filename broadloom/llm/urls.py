"""URL filter: prefix rules and gradient-boosted trees on lexical features. DataFrame operations only.

Features of a URL: lengths, depth, share of digits, entropy, counts of parameters and marks, and what the labelled URLs say
about the suffixes of its host. Spark's gradient-boosted trees learn from labelled URLs; rules come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import ascii_lower
from broadloom.session import materialize

#: Bound of the rows that the trees are fitted on; suffix counts cover all labelled rows.
SAMPLE = 20000
SALTS = 16
NUMERIC = ["url_length", "host_length", "path_length", "depth", "labels", "longest_label", "hyphens", "host_digits", "path_digits",
           "host_entropy", "path_entropy", "parameters", "parameter_length", "fragment", "secure", "escapes"]
SUFFIX = ["known_1", "rate_1", "known_2", "rate_2"]


def url_parts(url: Column | str) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path from there up to ? # or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"\A([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does. A rule is (host/path prefix, verdict)."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer ones override
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits a character over a-z, 0-9 and all other characters as one."""
    n = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    kinds = [*"abcdefghijklmnopqrstuvwxyz0123456789"]
    counts = [(F.char_length(text) - F.char_length(F.replace(text, F.lit(c)))) / n for c in kinds]
    rest = F.char_length(F.regexp_replace(text, "[a-z0-9]", "")) / n
    bits = [F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in (*counts, rest)]
    return sum(bits[1:], bits[0])


def lexical(urls: DataFrame, url_column: str = "url") -> DataFrame:
    """Adds ``_host``, ``_path``, the columns of NUMERIC and the host suffixes of one and two labels more than the last one."""
    host, path = url_parts(url_column)
    text = F.coalesce(F.col(url_column), F.lit(""))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    lower = ascii_lower(F.col("_path"))

    def count(column: Column, mark: str) -> Column:
        return (F.char_length(column) - F.char_length(F.regexp_replace(column, mark, ""))).cast("double")

    h, p = F.col("_host"), F.col("_path")
    return urls.withColumns({"_host": host, "_path": path}).withColumns({
        "url_length": F.char_length(text).cast("double"), "host_length": F.char_length(h).cast("double"), "path_length": F.char_length(p).cast("double"),
        "depth": count(p, "/"), "labels": count(h, r"\.") + 1, "longest_label": F.array_max(F.transform(F.split(h, r"\."), F.char_length)).cast("double"),
        "hyphens": count(h, "-"), "host_digits": count(h, "[0-9]") / F.greatest(F.char_length(h), F.lit(1)),
        "path_digits": count(p, "[0-9]") / F.greatest(F.char_length(p), F.lit(1)), "host_entropy": entropy(h), "path_entropy": entropy(lower),
        "parameters": F.when(F.char_length(query) > 0, count(query, "&") + 1).otherwise(0.0), "parameter_length": F.char_length(query).cast("double"),
        "fragment": F.contains(text, F.lit("#")).cast("double"), "secure": F.startswith(ascii_lower(text), F.lit("https:")).cast("double"),
        "escapes": count(text, "%"),
        "_s1": F.substring_index(h, ".", -2), "_s2": F.substring_index(h, ".", -3),
    })


def suffix_rates(labelled: DataFrame) -> DataFrame:
    """(suffix, n, bad) over all labelled rows, both suffix lengths; pre-aggregated, one row a suffix."""
    each = labelled.select(F.explode(F.array_distinct(F.array("_s1", "_s2"))).alias("suffix"), "_bad")
    return each.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("_bad").alias("bad"))


def with_rates(rows: DataFrame, rates: DataFrame, own: Column | None = None) -> DataFrame:
    """Adds SUFFIX: how many labelled URLs share the suffix, and their smoothed share of bad ones. ``own``: the label of the
    row itself, which is taken out of its counts. A suffix with very many URLs is salted."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rates.select("suffix", "n", "bad", salts.alias("_salt"))
    out = rows.withColumn("_salt", F.pmod(F.hash("_host", "_path", "_s2"), F.lit(SALTS)))
    for k in (1, 2):
        side = salted.select(F.col("suffix").alias(f"_s{k}"), "_salt", F.col("n").alias("_n"), F.col("bad").alias("_b"))
        joined = out.join(side, [f"_s{k}", "_salt"], "left")
        n, bad = F.coalesce("_n", F.lit(0)), F.coalesce("_b", F.lit(0))
        if own is not None:
            n, bad = n - F.when(own.isNotNull(), 1).otherwise(0), bad - F.coalesce(own, F.lit(0))
        out = joined.withColumns({f"known_{k}": F.log1p(n.cast("double")), f"rate_{k}": (bad + 0.5) / (n + 2.0)}).drop("_n", "_b")
    return out.drop("_salt")


def fit_url_trees(labelled: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 4, seed: int = 7) -> tuple[GBTClassificationModel | None, DataFrame]:
    """Model and suffix rates from rows of ``lexical`` with a label ``_bad`` (0 or 1; null rows are left out).

    The trees see at most about half of ``sample`` rows of each class, drawn row by row and weighted back to the size of their
    class, so that neither a rare class nor a URL of very many rows is lost; the rates cover all rows, and a training row's
    own label is not in its rates. With one class only there is no model.
    """
    known = labelled.where("_bad is not null")
    rates = materialize(suffix_rates(known), "suffixes")
    sizes = {r["_bad"]: r["count"] for r in known.groupBy("_bad").count().collect()}
    if len(sizes) < 2:
        return None, rates
    share = {c: min(1.0, sample / 2 / n) for c, n in sizes.items()}
    of_row = F.when(F.col("_bad") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    picked = known.where(F.rand(seed) < of_row)
    rows = with_rates(picked, rates, F.col("_bad"))
    rows = VectorAssembler(inputCols=NUMERIC + SUFFIX, outputCol="features").transform(rows).select(
        "features", F.col("_bad").cast("double").alias("label"), (1.0 / of_row).alias("weight"))
    rows = materialize(rows, "labelled").coalesce(8)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32, weightCol="weight").fit(rows)
    return model, rates


def judge(urls: DataFrame, model: GBTClassificationModel | None, rates: DataFrame, rules: Sequence[tuple[str, str]] = (),
          url_column: str = "url", threshold: float = 0.5) -> DataFrame:
    """``urls`` with host, path, rule, probability (of a bad URL) and verdict; columns of these names are replaced.

    Null URLs and URLs without :// have an empty host and path and are judged by their features like any other. Without a
    model the probability is 0. Repeated rows get equal verdicts.
    """
    names = [c for c in urls.columns if c not in ("host", "path", "rule", "probability", "verdict")]
    kept = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_kept")  # apart from the features, whose names may clash
    rows = with_rates(lexical(urls.select(kept, F.col(url_column).alias("_url")), "_url"), rates)
    if model is None:
        scored = rows.withColumn("probability", F.lit(0.0))
    else:
        from pyspark.ml.functions import vector_to_array

        vectors = VectorAssembler(inputCols=NUMERIC + SUFFIX, outputCol="features").transform(rows)
        scored = model.transform(vectors).withColumn("probability", vector_to_array("probability")[1])
    rule, verdict = matched_rule(F.col("_host"), F.col("_path"), rules)
    judged = F.coalesce(verdict, F.when(F.col("probability") >= threshold, "block").otherwise("allow"))
    return scored.select(*[F.col("_kept").getField(c).alias(c) for c in names], F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"), "probability", judged.alias("verdict"))
