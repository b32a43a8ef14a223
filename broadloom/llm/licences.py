"""Licence scan by sentence rules.

A text is cut into sentences; each is normalised and looked up among known licence sentences: the wordings of licence texts, and
statements of any licence of the catalogue ("licensed under ...", "License: ..."), whose name is a slot filled by look-up. The
sequence of sentence identifiers is then matched against ordered rules: a rule names a licence and the sentences it needs, in
order, with at most a few other known sentences between them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadloom.llm.common import pieces

# Known licence sentences after normalising, by identifier.
SENTENCES = {
    "apache-2": r"(this (?:file|work|software|project) is )?(?:released|licen[cs]ed|distributed) (?:to you )?under the apache (?:software )?licen[cs]e,? (?:version |v)?2(?:\.0)?(?: \(the licen[cs]e\))?",
    "apache-comply": r"you may not use this file except in compliance with the licen[cs]e",
    "apache-copy": r"you may obtain a copy of the licen[cs]e at .*",
    "apache-as-is": r"unless required by applicable law or agreed to in writing,? software distributed under the licen[cs]e is distributed on an as is basis.*",
    "mit-named": r"(?:this (?:file|work|software|project) is )?(?:released|licen[cs]ed|distributed) under the (?:terms of the )?mit licen[cs]e",
    "mit-grant": r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software.*",
    "mit-notice": r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": r"(?:the|this) software is provided (?:by .* )?as is.*",
    "gpl-3": r"(?:this (?:file|work|software|program|project) is )?(?:released|licen[cs]ed|distributed) under the (?:terms of the )?gnu general public licen[cs]e,? (?:version |v)3(?:\.0)?(?: or (?:any )?later)?",
    "gpl-2": r"(?:this (?:file|work|software|program|project) is )?(?:released|licen[cs]ed|distributed) under the (?:terms of the )?gnu general public licen[cs]e,? (?:version |v)2(?:\.0)?(?: or (?:any )?later)?",
    "gpl-free": r"this program is free software:? you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation.*",
    "lgpl": r".*gnu (?:lesser|library) general public licen[cs]e.*",
    "agpl": r".*gnu affero general public licen[cs]e.*",
    "bsd-named": r"(?:this (?:file|work|software|project) is )?(?:released|licen[cs]ed|distributed) under (?:the|a) (?:(?:2|3|two|three)-clause )?bsd(?:-style)? licen[cs]e",
    "bsd-grant": r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met.*",
    "bsd-source": r"(?:\d\.? ?)?redistributions of source code must retain the above copyright notice.*",
    "bsd-binary": r"(?:\d\.? ?)?redistributions in binary form must reproduce the above copyright notice.*",
    "bsd-endorse": r"(?:\d\.? ?)?neither the name of .* may be used to endorse or promote products.*",
    "mpl-2": r".*mozilla public licen[cs]e,? (?:version |v)?2(?:\.0)?.*",
    "cc": r"(?:this (?:file|work|text|article) is )?(?:released|licen[cs]ed|distributed|available) under (?:a |the )?(?:creative commons|cc) ?(?:by|0|zero|attribution)(?:[- ][a-z]{2,14})*(?: [1-4]\.0)?(?: (?:international|unported))?(?: licen[cs]e)?",
    "isc": r"permission to use,? copy,? modify,? and/or distribute this software for any purpose with or without fee is hereby granted.*",
    "public-domain": r".*(?:released into|dedicated to|in) the public domain.*",
    "spdx": r".*spdx-licen[cs]e-identifier: ?\(*[a-z0-9.+-]+.*",
    "all-rights": r"(?:copyright .*)?all rights reserved",
    "copyright": r"(?:copyright|\(c\)) (?:\(c\) )?\d{4}.*",
}
# Rules in order of precedence; a rule's sentences must follow in this order.
RULES = (
    ("Apache-2.0", ("apache-2", "apache-comply", "apache-copy", "apache-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-named", "mit-grant", "mit-notice")),
    ("ISC", ("isc", "as-is")),
    ("GPL-3.0", ("gpl-free", "gpl-3")),
    ("Apache-2.0", ("apache-2",)), ("Apache-2.0", ("apache-comply", "apache-copy")), ("MIT", ("mit-named",)), ("MIT", ("mit-grant",)),
    ("GPL-3.0", ("gpl-3",)), ("GPL-2.0", ("gpl-2",)), ("GPL", ("gpl-free",)), ("AGPL", ("agpl",)), ("LGPL", ("lgpl",)), ("BSD", ("bsd-named",)),
    ("BSD", ("bsd-grant",)), ("MPL-2.0", ("mpl-2",)), ("CC", ("cc",)), ("ISC", ("isc",)), ("public-domain", ("public-domain",)), ("SPDX", ("spdx",)),
    ("proprietary", ("all-rights",)),
)
GAP = 2

# Licences by SPDX identifier, with the names that statements use beside it. "licence" and "version" may be left out.
CATALOGUE = """
0BSD: Zero Clause BSD; BSD Zero Clause
AFL-3.0: Academic Free 3.0
AGPL-3.0: GNU Affero General Public 3; Affero General Public 3; AGPL 3; GNU AGPL 3
Apache-1.1: Apache Software 1.1
Apache-2.0: Apache 2.0; Apache Software 2.0; ASL 2.0
Artistic-2.0: Artistic 2.0; Perl Artistic 2.0
BSD-2-Clause: BSD 2 Clause; 2 Clause BSD; Two Clause BSD; Simplified BSD; FreeBSD
BSD-3-Clause: BSD 3 Clause; 3 Clause BSD; Three Clause BSD; New BSD; Modified BSD; Revised BSD
BSD-4-Clause: BSD 4 Clause; 4 Clause BSD; Original BSD
BSL-1.0: Boost Software 1.0; Boost Software; Boost; Boost 1.0
CC0-1.0: CC0; CC0 1.0 Universal; CC Zero; Creative Commons Zero; Creative Commons Zero 1.0
CDDL-1.0: Common Development and Distribution; Common Development and Distribution 1.0; CDDL
CECILL-2.1: CeCILL 2.1; CeCILL
CPL-1.0: Common Public 1.0; Common Public
ECL-2.0: Educational Community 2.0
EPL-1.0: Eclipse Public 1.0
EPL-2.0: Eclipse Public 2.0; Eclipse Public; EPL
EUPL-1.2: European Union Public 1.2; European Union Public; EUPL
GFDL-1.3: GNU Free Documentation 1.3; GNU Free Documentation; GFDL
GPL-1.0: GNU General Public 1; GPL 1
GPL-2.0: GNU General Public 2; GPL 2; GNU GPL 2
GPL-3.0: GNU General Public 3; GPL 3; GNU GPL 3
ISC: ISC
LGPL-2.0: GNU Library General Public 2; LGPL 2; GNU LGPL 2
LGPL-2.1: GNU Lesser General Public 2.1; LGPL 2.1; GNU LGPL 2.1
LGPL-3.0: GNU Lesser General Public 3; LGPL 3; GNU LGPL 3
LPPL-1.3c: LaTeX Project Public 1.3c; LaTeX Project Public; LPPL
MIT: MIT; Expat; MIT X11
MIT-0: MIT No Attribution
MPL-1.1: Mozilla Public 1.1
MPL-2.0: Mozilla Public 2.0; Mozilla 2.0
MS-PL: Microsoft Public
MS-RL: Microsoft Reciprocal
MulanPSL-2.0: Mulan Permissive Software 2; Mulan PSL 2
NCSA: University of Illinois/NCSA Open Source; NCSA Open Source
ODbL-1.0: Open Database 1.0; Open Database; ODbL
ODC-By-1.0: Open Data Commons Attribution 1.0; Open Data Commons Attribution
OFL-1.1: SIL Open Font 1.1; SIL Open Font; Open Font
OSL-3.0: Open Software 3.0
PHP-3.01: PHP 3.01; PHP
PostgreSQL: PostgreSQL
PSF-2.0: Python Software Foundation 2; Python Software Foundation; PSF
Ruby: Ruby
SSPL-1.0: Server Side Public 1; Server Side Public; SSPL
Unlicense: Unlicense
UPL-1.0: Universal Permissive 1.0; Universal Permissive
Vim: Vim
W3C: W3C Software
WTFPL: WTFPL; Do What The Fuck You Want To Public
X11: X11
Zlib: zlib; zlib/libpng
ZPL-2.1: Zope Public 2.1; Zope Public
"""
VERBS = frozenset("licensed licenced released distributed available published provided".split())
FILLERS = frozenset("a an the this these that all its our file files work works software project program code library package article text document "
                    "documentation source content contents is are was made and under terms of conditions or any later at your option only "
                    "license licence version international unported generic".split())
SPDX = re.compile(r"spdx-licen[cs]e-identifier: ?(\(*[a-z0-9.+-]+\)*(?: (?:and|or|with) \(*[a-z0-9.+-]+\)*)*)")
#: Names of RULES that are no SPDX identifiers.
FAMILIES = frozenset("CC BSD GPL AGPL LGPL SPDX unknown public-domain proprietary".split())


def canonical(words: str) -> list[str]:
    """Words of a name as they are compared: no punctuation, "licence", "version" or "the"; GPLv3, v3 and 3.0 are 3."""
    out = []
    for word in re.sub(r"[^a-z0-9.]+", " ", words.lower()).split():
        word = re.sub(r"^([a-z]{2,}?)v?(\d[\d.]*)$", r"\1 \2", word.strip("."))
        out += [re.sub(r"^v(?=\d)", "", re.sub(r"(?<=\d)(\.0)+$", "", w)) for w in word.split()]
    return [w for w in out if w not in ("license", "licence", "version", "the")]


def alias_table() -> dict[str, str]:
    """Canonical name -> SPDX identifier, from the catalogue and, for Creative Commons, by rule."""
    out = {}
    for line in CATALOGUE.strip().splitlines():
        spdx, names = line.split(": ", 1)
        for name in (spdx, *names.split("; ")):
            out.setdefault(" ".join(canonical(name)), spdx)
    kinds = ["by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"]
    long = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
    for kind in kinds:
        for number in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            spdx = f"CC-{kind.upper().replace(' ', '-')}-{number}"
            for name in (f"cc {kind}", f"creative commons {kind}", "creative commons " + " ".join(long[k] for k in kind.split())):
                out[" ".join(canonical(f"{name} {number}"))] = spdx
    return out


ALIASES = alias_table()
LONGEST = max(len(a.split()) for a in ALIASES)
#: Catalogue identifiers by their lower-case form, for SPDX expressions.
WRITTEN = {s.lower(): s for s in ALIASES.values()}


def named_licence(plain: str) -> tuple[str, list[str]] | None:
    """(SPDX identifier, other words) for the longest licence name in a normalised sentence, the first of equal ones."""
    words = canonical(plain)
    for n in range(min(LONGEST, len(words)), 0, -1):
        for i in range(len(words) - n + 1):
            spdx = ALIASES.get(" ".join(words[i:i + n]))
            if spdx:
                return spdx, words[:i] + words[i + n:]
    return None


def statement(plain: str) -> str | None:
    """SPDX identifier that a normalised sentence puts something under, e.g. "licensed under the _ licence", "this work is _ licensed",
    "licence: _" or an identifier with a version on its own; None for any other sentence."""
    if plain.count(" ") > WORDS:
        return None
    found = named_licence(plain)
    if found is None:
        return None
    rest = [w for w in found[1] if w not in FILLERS]
    if len(rest) == 1 and rest[0] in VERBS:
        return found[0]
    alone = plain.startswith(("license:", "licence:")) or re.fullmatch(r"[a-z][a-z0-9.+]*(?:-[a-z0-9.+]+)*-\d[a-z0-9.+-]*", plain)
    return found[0] if not rest and alone else None


def written_as(word: re.Match) -> str:
    """A lower-case identifier of an expression as the catalogue writes it; others stay."""
    name, suffix = re.fullmatch(r"(.*?)((?:-only|-or-later|\+)?)", word.group()).groups()
    return WRITTEN.get(name, name) + suffix


def spdx_of(licence: str, plain: str) -> str | None:
    """SPDX identifier, or expression, behind a match: what its first sentence writes, else the one of its rule."""
    written = SPDX.search(plain)
    if written:
        return " ".join(w.upper() if w in ("and", "or", "with") else re.sub(r"[^()]+", written_as, w) for w in written.group(1).rstrip(".").split())
    if licence not in FAMILIES:
        return licence
    found = named_licence(plain) if len(plain) < 400 else None
    return found[0] if found else None


#: Every sentence above holds one of these, each within a word, so that no line end or comment mark parts it.
HINT = re.compile(r"licen[cs]e|permission|copyright|redistribut|domain|rights|provided|neither|\(c\)|creative|\bcc|[a-z]-\d\.\d", re.I)
SENTENCE = re.compile(r"[^\n.!?;]*(?:[.](?=\w)[^\n.!?;]*)*[.!?;\n]*", re.S)
WORD = re.compile(r"\w")
COMPILED = [(name, re.compile(pattern)) for name, pattern in SENTENCES.items()]
MARKS = "'`*#/<>|“”‘’"


#: Marks that begin a line of comment in some language; they are blanked out, so offsets stay.
COMMENT = re.compile(r"^[ \t]*(?:(?://|--|;|%|#|!|/?\*|<!--|\.\\\")[-/;%#!*]*|(?:rem|dnl|c)(?=[ \t]))(?=[ \t])", re.I | re.M)
NEGATED = re.compile(r"\b(?:not|never|no longer|isn't|aren't|n't)\b(?: \S+){0,3} ?(?:released|licen[cs]ed|distributed|dedicated|available|published|in the public domain)")
ENDED = re.compile(r"[.!?]\s*\Z")  # with an end position: a line that ends its sentence
WORDS = 60  # words of the longest known sentence up to where it is recognised


def normalise(sentence: str) -> str:
    """Lower case, quotes and comment marks gone, one space between words, no closing punctuation."""
    plain = (word.strip(MARKS) for word in sentence.lower().replace('"', " ").split())
    return " ".join(word for word in plain if word).strip(" .!?;:,-")


def identify(plain: str) -> str | None:
    """Identifier of a normalised sentence: of a known wording, else ``name:`` and the SPDX identifier of a statement. A sentence
    that denies a licence has none."""
    known = next((name for name, pattern in COMPILED if pattern.fullmatch(plain)), None)
    if known is None:
        spdx = statement(plain)
        known = f"name:{spdx}" if spdx else None
    return None if known and known != "spdx" and NEGATED.search(plain) else known


def sentence_ids(text: str) -> list[tuple[str, int, int]]:
    """(identifier, start, end) of the known licence sentences of a text, in code points. A sentence that runs over line ends
    is also looked up joined with the lines behind it, as many as hold WORDS words; it begins at the last line that tells as much."""
    hints = [m.start() for m in HINT.finditer(text)]
    if not hints:
        return []
    text = COMMENT.sub(lambda m: " " * len(m.group()), text)
    spans = [(m.start(), m.end()) for m in SENTENCE.finditer(text) if WORD.search(m.group())]
    out, skip = [], -1
    for i, (start, _) in enumerate(spans):
        if i <= skip:
            continue
        coming = bisect_left(hints, start)
        words = 0
        for j in range(i, len(spans)):
            if j > i and (words > WORDS or not text.endswith("\n", 0, spans[j - 1][1]) or ENDED.search(text, *spans[j - 1])):
                break
            words += len(text[spans[j][0]:spans[j][1]].split())
            if coming >= len(hints) or hints[coming] >= spans[j][1]:
                continue
            whole = text[start:spans[j][1]]
            known = identify(normalise(whole))
            if known:
                later = next((k for k in range(j, i, -1) if identify(normalise(text[spans[k][0]:spans[j][1]])) == known), i)
                out.append((known, spans[later][0], start + len(whole.rstrip())))
                skip = j
                break
    return out


def match_rules(ids: list[tuple[str, int, int]], gap: int = GAP) -> list[tuple[str, int, int, int]]:
    """(licence, start, end, sentences) by the ordered rules: each known sentence serves one match, at most ``gap`` other known
    sentences may stand between two of a rule's. Licence sentences that no rule takes are ``unknown``; copyright lines are not."""
    free = [True] * len(ids)
    found = []
    for licence, needed in RULES:
        at = 0
        while at < len(ids):
            picked: list[int] = []
            if free[at] and ids[at][0] == needed[0]:
                picked = [at]
                for want in needed[1:]:
                    here = picked[-1]
                    step = next((k for k in range(here + 1, min(here + 2 + gap, len(ids))) if free[k] and ids[k][0] == want), None)
                    if step is None:
                        break
                    picked.append(step)
            if len(picked) == len(needed):
                for k in picked:
                    free[k] = False
                found.append((licence, ids[picked[0]][1], ids[picked[-1]][2], len(picked)))
            at += 1
    for k, (name, s, e) in enumerate(ids):
        if free[k] and name.startswith("name:"):
            free[k] = False
            found.append((name[5:], s, e, 1))
    found += [("unknown", s, e, 1) for (name, s, e), left in zip(ids, free, strict=True) if left and name not in ("copyright", "as-is")]
    return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(_id, licence, start, end, sentences, sentence_ids, spdx) per licence statement in the whole text; documents without one have
    no row. ``spdx``: the SPDX identifier, or the expression of an SPDX line; null where the statement tells a family only. Null and empty texts have none; repeated rows are scanned each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            rows, out = [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                ids = sentence_ids(text) if text else []
                for licence, start, end, n in match_rules(ids):
                    rows.append(i)
                    inner = [(name, s, e) for name, s, e in ids if start <= s and e <= end]
                    out.append((licence, start, end, n, [name for name, _, _ in inner], spdx_of(licence, normalise(text[inner[0][1]:inner[0][2]]))))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(rows, pa.int32())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                             names=["_id", "licence", "start", "end", "sentences", "sentence_ids", "spdx"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, licence string, start int, `end` int, sentences int, sentence_ids array<string>, spdx string")
