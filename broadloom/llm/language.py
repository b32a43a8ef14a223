"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed letter trigrams (word edges included), counted over all labelled
documents. A document's words are a mixture of languages: expectation-maximisation estimates the proportions, and
a penalised likelihood chooses how many languages the document really has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import map_texts, pieces

BUCKETS = 1 << 15
MAX_LANGUAGES = 1000
UNKNOWN = "und"
_STATE: dict = {}


@dataclass
class LanguageModel:
    """``logp[bucket, k]``: log probability of a trigram in ``languages[k]``."""

    languages: list[str]
    logp: np.ndarray


def _letters() -> np.ndarray:
    if "letters" not in _STATE:  # once per process
        _STATE["letters"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _STATE["letters"]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigram around each letter, and where each word (run of letters) starts among them."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    mixed = codes[:-2] * np.uint32(2654435761) + codes[1:-1] * np.uint32(2246822519) + codes[2:] * np.uint32(3266489917)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2654435769)
    centre = letter[1:-1]
    first = centre & ~letter[:-2]
    return (mixed[centre] >> np.uint32(17)).astype(np.int64), np.flatnonzero(first[centre])


def fit_languages(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", smoothing: float = 0.05) -> LanguageModel:
    """Trigram counts over all rows with a text and a language. Null languages and texts are left out; no labelled
    row gives a model without languages. The model has BUCKETS numbers a language; more than MAX_LANGUAGES
    languages are an error, so its size is bounded."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush():
            for lang, counts in held.items():
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["lang", "bucket", "n"])
            held.clear()

        for batch in pieces(batches, "_text"):
            for text, lang in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist(), strict=True):
                if lang not in held:
                    if len(held) >= 200:
                        yield from flush()
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(trigrams(text)[0], minlength=BUCKETS)
        yield from flush()

    rows = docs.select(F.col(text_column).alias("_text"), F.col(lang_column).alias("_lang")).dropna()
    counts = map_texts(rows, count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.limit(BUCKETS * MAX_LANGUAGES + 1).toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES or found.num_rows > BUCKETS * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {lang: i for i, lang in enumerate(langs)}
    table = np.zeros((BUCKETS, len(langs)))
    table[found.column("bucket").to_numpy(), [place[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    table += smoothing
    return LanguageModel(langs, np.log(table / table.sum(axis=0)).astype(np.float32))


def expectation_maximisation(like: np.ndarray, start: np.ndarray, steps: int = 30, tolerance: float = 2e-3) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of a mixture; ``like[word, k]`` is the likelihood up to a factor a word."""
    share = start / start.sum()
    for _ in range(steps):
        weighted = like * share
        total = weighted.sum(axis=1)
        new = (1.0 / total) @ weighted / len(like)
        moved = np.abs(new - share).max()
        share = new
        if moved < tolerance:
            break
    return share, float(np.log(like @ share).sum())


def mixture(text: str, model: LanguageModel, penalty: float = 0.5) -> dict[str, float]:
    """Languages of a text with their proportions, largest first. Empty without a letter or without a model.

    The set of languages is the one with the highest log likelihood less ``penalty`` x log(words) for each
    language, grown from the likeliest until it no longer pays. Ties go to the language first in the alphabet.
    """
    buckets, starts = trigrams(text)
    if not len(starts) or not model.languages:
        return {}
    if len(buckets) <= 1 << 18:
        scores = np.add.reduceat(model.logp[buckets], starts, axis=0).astype(np.float64)
    else:  # long texts by groups of whole words
        cuts = [*range(0, len(starts), 1 << 15), len(starts)]
        bounds = np.append(starts, len(buckets))
        scores = np.concatenate([
            np.add.reduceat(model.logp[buckets[bounds[a]:bounds[b]]], starts[a:b] - bounds[a], axis=0)
            for a, b in zip(cuts, cuts[1:], strict=False)]).astype(np.float64)
    best = scores.max(axis=1, keepdims=True)
    like = np.maximum(np.exp(scores - best), 1e-30)
    k = like.shape[1]
    share, _ = expectation_maximisation(like, np.full(k, 1.0 / k))
    order = np.argsort(-share, kind="stable")
    chosen, value = order[:1], np.log(like[:, order[0]]).sum()
    kept = np.ones(1)
    for size in range(2, k + 1):
        part, gain = expectation_maximisation(like[:, order[:size]], share[order[:size]] + 1e-6)
        if gain - penalty * (size - 1) * np.log(len(like) + 1.0) <= value:
            break
        chosen, kept, value = order[:size], part, gain - penalty * (size - 1) * np.log(len(like) + 1.0)
    found = sorted(zip(-kept, chosen, strict=True))
    return {model.languages[i]: float(-p) for p, i in found}


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score", mix_out: str | None = None) -> DataFrame:
    """``docs`` with the main language, its share of the words, and on request the whole mixture as a map.

    Null texts and texts without a letter get ``und`` with score 0. All columns are kept; output columns replace
    columns of the same name. Only the text is read for a prediction.
    """
    names = [c for c in docs.columns if c not in (lang_out, score_out, mix_out)]
    where = docs.schema[text_column].name

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, where):
            found = [mixture(t, model) if t else {} for t in batch.column(batch.schema.get_field_index(where)).to_pylist()]
            first = [next(iter(m.items()), (UNKNOWN, 0.0)) for m in found]
            out = [batch.column(batch.schema.get_field_index(c)) for c in names]
            out += [pa.array([f[0] for f in first], pa.string()), pa.array([min(1.0, f[1]) for f in first], pa.float64())]
            if mix_out:
                out.append(pa.array([list(m.items()) for m in found], pa.map_(pa.string(), pa.float64())))
            yield pa.RecordBatch.from_arrays(out, names=[*names, lang_out, score_out, *([mix_out] if mix_out else [])])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = [f"`{c}` {kinds[c]}" for c in names] + [f"`{lang_out}` string", f"`{score_out}` double"]
    schema += [f"`{mix_out}` map<string,double>"] if mix_out else []
    return map_texts(docs, run, ", ".join(schema))
