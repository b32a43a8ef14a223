"""Personal data spans against plain patterns; disclosing terms; masking."""

import hashlib
import math
import random
import re

import pytest

from broadloom.llm import disclosure
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(p[-400:]) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "x@y z@w.v.", "@a.b a@.b a@b..c", "a@b@c.d", "1.2.3.4.5.6.7.8", "999.1.2.3 1.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "+1 (487) 555-7209 +12", "+1.2.3.4567890", "É a.b+c@d-e.fé", "1" * 6000, "a@" * 500, "0.0.0.0007",
])
def test_base_spans(text):
    assert [(s, e, disclosure.KINDS[k]) for s, k, e in disclosure.base_spans(text)] == [(s, e, k) for s, _, e, k in plain(text)]


def test_random_base_spans():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choices("a1.@+- (2é\n", k=rng.randint(0, 40)))
        assert [(s, k, e) for s, k, e in disclosure.base_spans(text)] == [(s, k, e) for s, k, e, _ in plain(text)], text


def test_query_against_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_disclosure"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        listed = [f"{k}:{s}:{e}" for s, _, e, k in want]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in want) for k in PATTERNS]


def test_terms_that_disclose(spark):
    filler = ["alpha beta gamma delta", "beta delta epsilon", "gamma gamma zeta", "delta alpha eta"]
    rows = [(i, f"{filler[i % 4]} Zorblatt writes to bob@x.org {filler[(i + 1) % 4]} {i}", "k") for i in range(4)]
    rows += [(100 + i, f"{filler[i % 4]} number {i}", "k") for i in range(200)]
    rows += [(500, None, "k"), (501, "", "k"), (None, "Zorblatt near bob@x.org", "k"), (0, rows[0][1], "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    found = [(r._id, [(s.kind, s.start, s.end) for s in r.spans]) for r in disclosure.sensitive_spans(docs).collect()]
    assert len(found) == len(rows)
    terms = {(i, k) for i, spans in found for k, _, _ in spans}
    assert {(0, "term"), (3, "term"), (None, "term"), (0, "email")} <= terms
    assert not any(i is not None and i >= 100 for i, _ in terms)
    clean = disclosure.sanitise(docs)
    assert clean.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    assert len(texts) == len(rows)
    assert not any("bob@x.org" in t or "Zorblatt" in t for _, t in texts if t)
    assert {t for i, t in texts if i is not None and i >= 100} == {t for i, t, _ in rows if i is not None and i >= 100}
    assert disclosure.sanitise(docs.limit(0)).count() == 0


def test_copies_do_not_disclose(spark):
    docs = spark.createDataFrame([(i, "Orlando mails a@b.cd today") for i in range(50)] + [(99, "other words")], "doc_id bigint, text string")
    kinds = {s.kind for r in disclosure.sensitive_spans(docs).collect() for s in r.spans}
    assert kinds == {"email"}


def rare_docs(spark, rows):
    filler = ["alpha beta gamma delta", "beta delta epsilon", "gamma gamma zeta", "delta alpha eta"]
    return spark.createDataFrame([*rows, *[(1000 + i, f"{filler[i % 4]} number {i}") for i in range(2000)]], "doc_id bigint, text string")


def marked(docs):
    return {(r._id, s.kind, s.start) for r in disclosure.sensitive_spans(docs).collect() for s in r.spans}


def test_entities_that_occur_once_or_twice(spark):
    """Copies count once, common words and words that also stand in many other texts tell nothing."""
    other = [(20 + i, f"Quark alone {i}") for i in range(40)]
    rows = [(1, "alpha Zorblatt ann@x.org beta Quark"), (2, "beta Wexley bob@x.org gamma"), (3, "delta Wexley bob@x.org"), (4, "delta Wexley bob@x.org")]
    got = marked(rare_docs(spark, rows + other))
    assert got == {(1, "near", 6), (1, "email", 15), (2, "near", 5), (2, "email", 12), (3, "near", 6), (3, "email", 13), (4, "near", 6), (4, "email", 13)}


def test_terms_of_the_whole_text(spark):
    """On other lines, at any distance, at every place; a word is never cut, and is left where the entity is not."""
    text = "alpha beta\nZorblatt\n" + "gamma delta " * 400 + "b@x.org beta " + "x" * 600 + "\nzorblatt"
    got = marked(rare_docs(spark, [(1, text), (2, "alpha\nZorblatt"), (3, "delta Zorblatt b@x.org")]))
    assert {(i, s) for i, k, s in got if k == "near"} == {(3, 6), (1, 11), (1, text.index("xxx")), (1, len(text) - 8)}


def test_terms_against_plain_counts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        names = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in rng.choices(range(500), weights=[1 / (k + 1) for k in range(500)], k=12)]
        rows.append((i, " ".join(names + [f"u{rng.randint(0, 30)}@x.org" for _ in range(rng.choice((0, 0, 0, 1, 2)))])))
    rows += rows[:20]
    held, own, both, texts = {}, {}, {}, {t for _, t in rows}
    for t in texts:
        terms, people = {w for w in t.split() if "@" not in w}, {w for w in t.split() if "@" in w}
        for w in terms:
            held[w] = held.get(w, 0) + 1
        for p in people:
            own[p] = own.get(p, 0) + 1
            for w in terms:
                both[p, w] = both.get((p, w), 0) + 1
    score = {(p, w): 1 + (math.log(n / held[w]) + math.log(disclosure.DOUBT) / n) / math.log((len(texts) + 1) / own[p]) for (p, w), n in both.items()}
    want = set()
    for i, t in rows:
        for m in re.finditer(r"word\w+", t):
            top = max([score[p, m.group()] for p in t.split() if "@" in p], default=0)
            if top >= disclosure.GENERALISE:
                want.add((i, "term" if top >= disclosure.REMOVE else "near", m.start()))
    got = {x for x in marked(spark.createDataFrame(rows, "doc_id bigint, text string")) if x[1] != "email"}
    assert want and got == want


def test_base_spans_do_not_depend_on_the_bytes_decoded_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"write to user{i % 7}@mail.example.org about parcel {i}") for i in range(60)], "doc_id long, text string").coalesce(1)

    def found():
        return sorted((r._id, r.spans, sorted((w.term, w["at"]) for w in r.words)) for r in disclosure.find_base(docs).collect())

    whole = found()
    monkeypatch.setattr(disclosure, "PIECE", 100)
    assert found() == whole and len(whole) == 60
