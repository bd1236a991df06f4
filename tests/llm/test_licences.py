from __future__ import annotations

import re
import textwrap

import pytest

from hourtally.llm import licences

GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions:"
)
NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."


def test_fixed_values():
    for plain in licences.SENTENCES.values():
        assert plain == re.sub("[^a-z0-9]+", " ", plain).strip()
        assert any(mark in plain for mark in licences.MARKS)
    known = set(licences.SENTENCES)
    assert all(set(ids) <= known and ids for _, ids in licences.RULES)


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("Some words. Released under the MIT License.", ["MIT"]),
        ("x\nRELEASED  under the *MIT* licensE\ny", ["MIT"]),
        (f"{GRANT}\n\nBetween.\n{NOTICE} More.", ["MIT"]),
        (f"{NOTICE}\n{GRANT}", []),
        ("Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
        ("# SPDX-License-Identifier: MIT", ["MIT"]),
        ("We say; released under the MIT license. Twice; released under the MIT license.", ["MIT"]),
        ("It is released under the MIT License.", []),
        ("A licence of software, copyright.", []),
        ("", []),
        (None, []),
    ],
)
def test_texts(spark, text, names):
    frame = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, licences string, ids string")
    found = licences.recognised(frame).first()
    assert found.licences == names
    assert found.ids == "y"


def test_odd_rows(odd_docs, no_docs):
    found = licences.recognised(odd_docs)
    assert found.count() == odd_docs.count()
    assert {tuple(r.licences) for r in found.collect()} == {()}
    assert licences.recognised(no_docs).count() == 0
    assert licences.recognised(odd_docs, rules=()).where("size(licences) > 0").count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_long_text(spark):
    text = ("Filler about software. " * 20_000) + "Released under the MIT License."
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licences.recognised(frame).first().licences == ["MIT"]


APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law"
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
NEITHER = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.\n\n"
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed"
)
MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
    "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
NOTICES = [
    (f"MIT License\n\nCopyright (c) 2020 X\n\n{GRANT}\n\n{NOTICE}\n", ["MIT"]), (f"{GRANT} {NOTICE}", ["MIT"]),
    (APACHE, ["Apache-2.0"]), (BSD, ["BSD-2-Clause"]), (BSD + NEITHER, ["BSD-2-Clause", "BSD-3-Clause"]), (GPL, ["GPL-3.0"]), (MPL, ["MPL-2.0"]),
]


ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED"
)
GPL_2 = GPL.replace("software:", "software;").replace("Foundation,", "Foundation;").replace("version 3", "version 2")
LGPL_2 = GPL_2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1")
NOTICES += [
    (ISC, ["ISC"]), (GPL_2, ["GPL-2.0"]), (LGPL_2, ["LGPL-2.1"]), (GPL.replace("General", "Lesser General"), ["LGPL-3.0"]),
    (GPL.replace("General", "Affero General"), ["AGPL-3.0"]),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", ["Unlicense"]),
    ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)", ["BSL-1.0"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
        "at https://www.eclipse.org/legal/epl-2.0/",
        ["EPL-2.0"],
    ),
    (BSD + "3. All advertising materials mentioning features or use of this software must display the following acknowledgement:\n\n", ["BSD-2-Clause", "BSD-4-Clause"]),
]


def test_many_licences():
    names = {name for name, _ in licences.RULES}
    assert len(names) >= 25
    assert {"GPL-2.0", "LGPL-2.1", "AGPL-3.0", "ISC", "BSL-1.0", "Unlicense", "CC-BY-SA-4.0"} <= names


def test_query_and_sql_on_wrapped_notices(spark, tmp_path):
    """The registered query and its SQL, on notices in lines of any width."""
    import duckdb

    from hourtally.llm import oracles, registered

    rows = []
    for text, _ in [*NOTICES, ("a\r\n\r\nb v. v. 2; released under the MIT license!", []), (None, []), ("", []), ("\n\n# \n", []), ("S L", [])]:
        for leader in ("", "# ", " * ", "rem "):
            for end in ("\n", "\r\n", "\r"):
                for width in (72, 40, 10_000):
                    lines = [line for part in (text or "").split("\n") for line in textwrap.wrap(part, width) or [""]]
                    rows.append((len(rows), None if text is None else end.join((leader + line).rstrip() if leader != "rem " else leader + line for line in lines)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(r) for r in registered.queries()["op10_licence_sentences"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert found == sorted(con.sql(oracles.ORACLES["op10_licence_sentences"]).fetchall())
    assert sum(bool(r[1]) for r in found) > 400


def test_official_notices_in_lines(spark):
    rows, wanted = [], []
    for text, names in NOTICES:
        for leader in ("", "# ", " * ", "// ", "rem "):
            for end in ("\n", "\r\n"):
                for width in (72, 40):
                    lines = [line for part in text.split("\n") for line in textwrap.wrap(part, width) or [""]]
                    rows.append((len(rows), end.join((leader + line).rstrip() if leader != "rem " else leader + line for line in lines)))
                    wanted.append(names)
    found = licences.recognised(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.licences for r in sorted(found, key=lambda r: r.doc_id)] == wanted


def test_ends_of_sentences(spark):
    rows = [
        ("released under\n\nthe MIT license", []), ("released under. the MIT license", []), ("released\nunder the\r\nMIT license", [1, 13]),
        ("Licensed under the Apache License, Version 2.0\n(the License)", [2, 30]), ("MIT license\nMIT license", [13, 13]),
    ]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(rows)], "doc_id long, text string")
    found = licences.recognised(frame).collect()
    assert [r.sentences for r in sorted(found, key=lambda r: r.doc_id)] == [ids for _, ids in rows]


def test_marks_of_other_sentences(spark):
    frame = spark.createDataFrame([("All rights reserved.",), ("Nothing.",)], "text string")
    found = licences.recognised(frame, {7: "all rights reserved"}, (("none", (7,)),)).collect()
    assert sorted((r.text, r.licences) for r in found) == [("All rights reserved.", ["none"]), ("Nothing.", [])]
