"""Licence digests."""

from pathlib import Path

from lapsewise.llm import licenses as L
from lapsewise.llm.license_texts import DECLARATIONS, TEXTS
from lapsewise.llm.queries import QUERIES


def scan(spark, rows):
    return L.scanned(spark.createDataFrame(rows, "doc_id long, text string"), L.known(spark)).collect()


def test_variants_of_known_texts(spark):
    rows = []
    for i, (name, text) in enumerate(TEXTS.items()):
        shouted = "Copyright (c) 2019 A. Body\n  (C) 2020 Nobody. \nAll rights reserved.\n" + text.replace("sublicense", "sublicence").upper().replace(", ", " ,\n")
        rows += [(i, text), (100 + i, shouted), (200 + i, text + "\nAnd more.")]
    found = {r.doc_id: r.license_id for r in scan(spark, rows)}
    for i, name in enumerate(TEXTS):
        assert found[i] == found[100 + i] == name and found[200 + i] is None


def test_declarations_in_lines(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op8_license_digests"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        wanted = sorted({name for line, name in DECLARATIONS.items() if line in (text or "").split("\n")})
        assert rows[doc_id].line_licenses.split() == wanted


def test_odd_documents(spark, odd_documents, no_documents):
    rows = L.scanned(odd_documents, L.known(spark)).collect()
    assert len(rows) == odd_documents.count() and not any(r.license_id or r.line_licenses for r in rows)
    assert {r.digest for r in rows if r.doc_id in (1, 2)} == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    assert L.scanned(no_documents, L.known(spark)).collect() == []


def test_each_form_has_one_license(spark):
    rows = L.known(spark).select("digest", "license_id").collect()
    assert len({r.digest for r in rows}) == len(rows)


def test_titles_wordings_and_long_texts(spark):
    wanted = {
        "Licensed under the MIT License.": "MIT", "// SPDX-License-Identifier: MIT": "MIT", "This project is released under the MIT licence": "MIT",
        "License: BSD-3-Clause": "BSD-3-Clause", "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0", "The MIT License is short.": "",
    }
    titled = "MIT License\n\nCopyright (c) 2026 A. Body\n\n" + TEXTS["MIT"].replace(", ", ",\n")
    apache = (Path(L.__file__).parent / "license_bodies/Apache-2.0.txt").read_text()
    rows = scan(spark, [*enumerate("Some words.\n" + line for line in wanted), (100, titled), (101, apache), (102, apache + "\nAnd more.")])
    found = {r.doc_id: r for r in rows}
    assert [found[i].line_licenses for i in range(len(wanted))] == list(wanted.values())
    assert (found[100].license_id, found[101].license_id, found[102].license_id) == ("MIT", "Apache-2.0", None)
