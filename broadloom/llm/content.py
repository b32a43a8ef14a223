"""Main text of a web page by its maximum-scoring run of words and tags.

Words score positive and tags negative. What a tag costs comes from labelled pages: elements that stand apart from the
content cost as many words as such elements hold, those around or inside the content next to nothing; (element name,
class, id) is told apart where the labelled pages know it, else the name alone. A word counts the less, the more the
element around it costs. One linear scan finds the contiguous run of the highest score; its blocks are the main text.
Elements that HTML itself reserves for other things than text (menus, forms, scripts) give no words, but cost as others do.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import pieces

# Element names of HTML and the words by which pages name what is not content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr br".split())
NEVER = frozenset("nav header footer aside form script style noscript template iframe svg canvas object embed audio video button select "
                  "option textarea input dialog head title menu".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
NAMED = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
                  "header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related replies respond "
                  "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
CONTENT = ("article", "main")
KNOWN = frozenset("article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
                  "figcaption address hr body html details summary fieldset legend center".split()) | INLINE | VOID
LOOSE = ("html", "body", *CONTENT)
SHAPES = frozenset("area bar block box button buttons container content form holder icons inner item items link links list panel section slot "
                   "thread unit widget wrap wrapper".split())
NEGATED = frozenset("has is no non not with without".split())
TITLES = frozenset("banner header masthead".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*>", re.I | re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

UNSEEN = -0.1  # score of a tag that no labelled page has
PRIOR = -50.0  # score of one that no labelled page has, but whose class or id names boilerplate
APART = -1.0  # from this score on an element is taken out of the content around it
VOCABULARY = 50_000  # (element, class or id) pairs told apart, the most used ones; the others count by their element


class Element:
    """One element of a page. ``keys``: element and class or id; ``named``: its class or id names boilerplate; ``cut``: never text;
    ``inside``: within <article> or <main>."""

    __slots__ = ("name", "keys", "named", "parent", "inside", "cut")

    def __init__(self, name: str, more: str, parent: int, inside: bool):
        self.name, self.parent, self.inside = name, parent, inside or name in CONTENT
        self.keys, self.named, self.cut = [], False, name in NEVER and not (name == "header" and inside)
        if not more or name in LOOSE:
            return
        for m in ATTRIBUTE.finditer(more):
            key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
            if key in ("class", "id"):
                for token in value.split():
                    self.keys.append(f"{name}.{token.lower()}")
                    self.named |= is_named(token, inside)
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in ROLES:
                self.cut = True


def is_named(token: str, inside: bool) -> bool:
    """True for a class or id that ends in a word for boilerplate, or begins with one and goes on with words for shapes only.
    Inside the content a header is that of the article."""
    parts = [x.lower() for x in PART.split(token) if x]
    if not parts or parts[0] in NEGATED or inside and parts[-1] in TITLES:
        return False
    return parts[-1] in NAMED or parts[0] in NAMED and SHAPES.issuperset(parts[1:])


def parse(page: str) -> tuple[list[Element], list[tuple[str, str, int, bool]]]:
    """Elements of a page, parents first, and its tokens in page order: (kind, text, element, block edge), kind ``open``,
    ``close`` or ``text``. Element 0 is the page. Elements that stay open end with the one around them. Time is linear."""
    elements, tokens = [Element("html", "", -1, False)], []
    stack, places = [0], {}  # open elements; for each name the places in the stack where it is open
    at = 0

    def end(name: str) -> None:
        while True:
            closed = stack.pop()
            found = elements[closed].name
            places[found].pop()
            tokens.append(("close", "", closed, found not in INLINE or elements[closed].cut))
            if found == name:
                return

    def last(*names: str) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            tokens.append(("text", markup.unescape(page[at:m.start()]), stack[-1], False))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        block = name not in INLINE
        if m["end"]:
            if places.get(name):
                end(name)
            elif block:
                tokens.append(("text", "", stack[-1], True))
            continue
        if name == "li" and last("li") > last("ul", "ol"):
            end("li")
        elif block and last("p") > last("td", "th", "button"):  # a block ends an open paragraph
            end("p")
        elements.append(Element(name, m["more"] or "", stack[-1], elements[stack[-1]].inside))
        number = len(elements) - 1
        tokens.append(("open", "", number, block or elements[number].cut))
        if name in VOID or (m["more"] or "").rstrip().endswith("/"):
            if name == "br":
                tokens.append(("text", " ", stack[-1], False))
        else:
            places.setdefault(name, []).append(len(stack))
            stack.append(number)
    if at < len(page):
        tokens.append(("text", markup.unescape(page[at:]), stack[-1], False))
    return elements, tokens


def uses(page: str) -> Iterator[tuple[str, bool, int]]:
    """(name or key, apart, words) for the elements of a labelled page that hold, or are inside, the content, and for the outermost
    of those apart from it. Elements named as boilerplate inside the content tell nothing."""
    elements, tokens = parse(page)
    words, holds, skip = [0] * len(elements), [e.inside for e in elements], [False] * len(elements)
    for kind, text, number, _ in tokens:
        if kind == "text":
            words[number] += len(text.split())
    for i in range(len(elements) - 1, 0, -1):
        up = elements[i].parent
        words[up] += words[i]
        holds[up] |= holds[i]
    for i, e in enumerate(elements[1:], 1):
        skip[i] = skip[e.parent] or not holds[e.parent] or e.inside and (e.cut or e.named)
        if not skip[i]:
            for key in (e.name if e.name in KNOWN or e.name in NEVER else "other", *dict.fromkeys(e.keys)):
                yield key, not holds[i], words[i]


def fit_weights(pages: DataFrame, html_column: str = "html") -> dict[str, float]:
    """Score of each element name and of each (name, class or id), from all pages that label their content with an <article> or
    <main> element.

    The score is minus the share of uses apart from the content times the words that such uses hold: their mean, four standard
    deviations and one. Names are HTML's, classes and ids the VOCABULARY most used, so the table has a bounded size. Without
    labelled pages it is empty. Null and empty pages and repeated rows are counted as they are.
    """
    label = re.compile(r"<(?:article|main)\b", re.I)
    columns = ["apart", "around", "words", "squares"]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in pieces(batches, "_html"):
            for page in batch.column("_html").to_pylist():
                if page and label.search(page):
                    for key, apart, n in uses(page):
                        held = seen.setdefault(key, [0, 0, 0, 0])
                        held[0 if apart else 1] += 1
                        if apart:
                            held[2] += n
                            held[3] += n * n
                if len(seen) > VOCABULARY:  # what is known so far goes out, memory stays bounded
                    yield rows_of(seen)
                    seen = {}
        yield rows_of(seen)

    def rows_of(seen: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array([float(v[i]) for v in seen.values()], pa.float64())
                                                                                for i in range(4))], names=["key", *columns])

    rows = pages.select(F.col(html_column).alias("_html")).mapInArrow(count, "key string, " + ", ".join(f"{c} double" for c in columns))
    total = rows.groupBy("key").agg(*(F.sum(c).alias(c) for c in columns)).orderBy(F.desc(F.col("apart") + F.col("around")), "key")
    out = {}
    for r in total.limit(VOCABULARY).collect():
        mean = r.words / max(r.apart, 1.0)
        spread = math.sqrt(max(0.0, r.squares / max(r.apart, 1.0) - mean * mean))
        out[r.key] = -(r.apart + 0.01) / (r.apart + r.around + 0.02) * (mean + 4 * spread + 1)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last index of the contiguous run of the highest positive sum, the earliest if several; (0, -1) if none is."""
    best, found, total, start = 0.0, (0, -1), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i)
    return found


def score_of(e: Element, weights: dict[str, float]) -> tuple[float, bool]:
    """Score of an element's tags, and whether its class or id tells it."""
    known = [weights[k] for k in e.keys if k in weights]
    if known:
        return min(known), True
    if e.named:
        return PRIOR, True
    return weights.get(e.name if e.name in KNOWN or e.name in NEVER else "other", UNSEEN), False


def extract(page: str, weights: dict[str, float]) -> str:
    """Main text: one line a block, white space within a block turned into one space. Elements inside the content whose class or id
    tells that they stand apart from it are taken out and cost nothing; on pages that mark no content they are taken out anywhere,
    at their cost."""
    elements, tokens = parse(page)
    marked = any(e.inside for e in elements)
    tags, share, gone = [0.0], [1.0], [False]  # by element: score of a tag, score of a word, taken out
    for e in elements[1:]:
        score, told = score_of(e, weights)
        tags.append(score)
        share.append(1.0 if e.name in CONTENT else min(share[e.parent], 1.0 / (1.0 - score)))
        gone.append(gone[e.parent] or e.cut or told and score <= APART and (e.inside or not marked))
    scores: list[float] = []
    texts: list[tuple[int, str, int]] = []  # token, text, block
    block = 0
    for kind, value, number, edge in tokens:
        block += edge
        if kind != "text":
            scores.append(0.0 if gone[elements[number].parent] or gone[number] and elements[number].inside else tags[number])
        elif gone[number]:
            scores.append(0.0)
        else:
            texts.append((len(scores), value, block))
            scores.append(len(value.split()) * share[number])
    first, last = best_run(scores)
    held = {b for i, t, b in texts if first <= i <= last and not t.isspace()}
    lines: dict[int, list[str]] = {}
    for _, t, b in texts:
        if b in held:
            lines.setdefault(b, []).append(t)
    joined = (" ".join("".join(parts).split()) for parts in lines.values())
    return "\n".join(x for x in joined if x)


def main_text(pages: DataFrame, weights: dict[str, float], html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without their html and with their main text; all other columns are kept, one of the name ``out`` replaced.
    Null and empty pages have an empty text; repeated rows each get theirs."""
    names = [c for c in pages.columns if c not in (html_column, out)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, html_column):
            found = [extract(p, weights) if p else "" for p in batch.column(batch.schema.get_field_index(html_column)).to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], names=[*names, out])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.select(*names, html_column)
    return source.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in names] + [f"`{out}` string"]))
