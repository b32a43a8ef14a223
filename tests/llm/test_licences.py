"""Licence statements against plain patterns on the given lines, full licence texts, odd rows."""

import random
import re
import textwrap

from broadloom.llm import licences
from broadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC", "All rights reserved.": "proprietary",
}


def named(text):
    return [f[0] for f in licences.match_rules(licences.sentence_ids(text))]


def test_sentences_and_rules():
    assert named(MIT) == ["MIT"]
    found = licences.match_rules(licences.sentence_ids("Intro. " + MIT))
    assert found[0][3] == 3
    for line, licence in LINES.items():
        assert named(line) == [licence]
        assert named(f"Some text before it. {line} More text.") == [licence]
    assert named("We got a licence to drive and permission to go.") == []
    assert named("You may not use this file except in compliance with the License.") == ["unknown"]
    both = "Licensed under the Apache License, Version 2.0. Released under the MIT License."
    assert named(both) == ["Apache-2.0", "MIT"]


def test_query_finds_every_line(spark):
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for line, licence in LINES.items():
            want |= {(r.doc_id, licence, m.start()) for m in re.finditer(r"(?:(?<=[.!?\n] )|(?<=\n)|^)" + re.escape(line), r.text)}
    got = {(r.doc_id, r.licence, r.start) for r in QUERIES["op5_licences"](spark, SF).collect()}
    assert want and want <= got


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, line), (3, line), (None, "word " * 100000 + ".\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((str(r._id), r.licence, r.start) for r in licences.scan(docs).collect())
    assert got == [("3", "MIT", 0), ("3", "MIT", 0), ("None", "MIT", 500002)]
    assert licences.scan(docs.limit(0)).count() == 0


def test_long_sentences():
    long = "word " * 2000
    assert named(long + "SPDX-License-Identifier: MIT " + long) == ["SPDX"]
    assert named(f"Intro. {long} under the GNU Lesser General Public License {long}") == ["LGPL"]
    assert named("the licence " + "/" * 1000000 + "x " + long + "is in the public domain " + long) == ["public-domain"]


def test_no_known_sentence_lacks_a_hint():
    for line, licence in {"Available under CC BY-SA 4.0.": "CC", "Released under Creative Commons Attribution 4.0.": "CC", "Distributed under CC0.": "CC",
                          "This work is in the public\n  domain.": "public-domain", "All  rights\nreserved.": "proprietary"}.items():
        assert named(line) == [licence]
    assert [i[0] for i in licences.sentence_ids("The software is provided as\n * is.")] == ["as-is"]


def test_normalise_as_before():
    drop = re.compile(r"[\"'`*#/<>|“”‘’]+(?=\s|$)|(?:(?<=\s)|^)[\"'`*#/<>|“”‘’]+")
    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choices("aB.'\"*/# \n“,-", k=rng.randint(0, 25)))
        assert licences.normalise(text) == " ".join(drop.sub(" ", text.lower().replace('"', " ")).split()).strip(" .!?;:,-")


def told(text):
    return [(f[0], licences.spdx_of(f[0], licences.normalise(text[f[1]:f[2]]))) for f in licences.match_rules(licences.sentence_ids(text))]


def test_full_text_at_any_width_behind_any_comment_mark():
    paragraphs = [" ".join(p.split()) for p in MIT.split("\n\n")]
    for width in range(20, 121, 10):
        for mark in ("", "-- ", ";; ", "% ", "REM ", "# ", " * ", "// ", "dnl "):
            lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width), ""]]
            assert told("\n".join(mark + line if line else "" for line in lines)) == [("MIT", "MIT")]


def test_statements_of_the_catalogue():
    for text, spdx in {
        "Licensed under the Apache-2.0 license.": "Apache-2.0", "This project is MIT licensed.": "MIT", "License: MIT": "MIT", "Licensed under GPLv3.": "GPL-3.0",
        "CC-BY-SA-4.0": "CC-BY-SA-4.0", "Released under the EUPL-1.2.": "EUPL-1.2", "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "Licensed under the\nEclipse Public\nLicense 2.0.": "EPL-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This library is licensed under the GNU Lesser General Public License v2.1 or later.": "LGPL-2.1", "Licensed under the zlib licence.": "Zlib",
    }.items():
        assert [s for _, s in told(text)] == [spdx]
        assert [s for _, s in told(f"Before it. {text}\nAfter it.")] == [spdx]
    assert len(set(licences.ALIASES.values())) > 70
    for spdx in set(licences.ALIASES.values()):
        assert licences.statement(f"licensed under the {spdx.lower()} license") == spdx
    for text in ("Not in the public domain.", "This file is not licensed under the MIT License.", "MIT", "He was released under MIT.", "Boost the licence."):
        assert told(text) == []


def test_spdx_expressions():
    assert told("SPDX-License-Identifier: MIT OR apache-2.0") == [("SPDX", "MIT OR Apache-2.0")]
    assert told("x = 1\n// SPDX-License-Identifier: (GPL-2.0-only WITH Other) AND ISC\ny = 2") == [("SPDX", "(GPL-2.0-only WITH other) AND ISC")]


def test_query_finds_nothing_else(spark):
    """Every row of the query stands at one of the given lines."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lines = {licences.normalise(line) for line in LINES}
    for r in QUERIES["op5_licences"](spark, SF).collect():
        assert licences.normalise(texts[r.doc_id][r.start:r.end]) in lines


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "License: MIT", "a", "b", 3)], "doc_id bigint, text string, spdx string, licence string, start int")
    assert [(r._id, r.licence, r.spdx) for r in licences.scan(docs).collect()] == [(1, "MIT", "MIT")]
