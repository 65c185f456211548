"""License scan with the whole catalogue: other notices, versions, SPDX lines."""

from strata.llm import license_scan as ls

CASES = [
    ("This project is licensed under the MIT License", {"MIT"}),
    ("Photos are licensed under CC BY-SA 3.0.", {"CC-BY-SA-3.0"}),
    ("licensed under a Creative Commons Attribution 4.0 International License", {"CC-BY-4.0"}),
    ("released under the CC0 1.0 Universal dedication", {"CC0-1.0"}),
    ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
    ("This work is licensed under the GNU General Public License, version 9.", set()),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", {"MPL-1.1"}),
    ("distributed under the GNU Lesser General Public License v2.1", {"LGPL-2.1"}),
    ("licensed under the GNU Affero General Public License, version 3", {"AGPL-3.0"}),
    ("released under the ISC License.", {"ISC"}),
    ("made available under the Eclipse Public License 2.0", {"EPL-2.0"}),
    ("This is free and unencumbered software released into the public domain.", {"Unlicense"}),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nand more", {"MIT", "Apache-2.0"}),
    ("# SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\n", {"GPL-2.0-only"}),
    ("SPDX-License-Identifier: LicenseRef-own", {"licenseref-own"}),
    ("no notice", set()),
]


def test_catalogue(spark):
    rows = [(i, f"some prose before it {text} and prose behind it") for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in ls.scan(df, ls.CATALOGUE, ls.IDENTIFIERS).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    for i, (text, want) in enumerate(CASES):
        assert got.get(i, set()) == want, text


def test_every_notice_is_found(spark):
    df = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(ls.CATALOGUE)], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in ls.scan(df, ls.CATALOGUE, ls.IDENTIFIERS).collect()}
    assert {(i, name) for i, (name, _) in enumerate(ls.CATALOGUE)} <= got
    assert all(len(ls.template_words(text)) >= ls.WIDTH for _, text in ls.CATALOGUE)


def test_versions_of_the_templates_alone(spark):
    df = spark.createDataFrame([(1, CASES[4][0]), (2, CASES[5][0])], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in ls.scan(df).collect()] == [(2, "GPL-3.0")]
