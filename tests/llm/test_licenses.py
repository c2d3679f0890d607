import re

import duckdb
import pytest

from catalog_engine.llm import licenses

FOLDER = "/root/testdata/sf0.1"


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    right = sorted(duck.execute(licenses.scan_sql()).fetchall())
    found = licenses.op2_license_scan(spark, FOLDER)
    assert "Python" not in found._jdf.queryExecution().toString()
    found = sorted(map(tuple, found.collect()))
    assert found == right and sum(r[2] != "" for r in found) > 100


def test_rows(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    mit = "\n".join([
        "# Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation",
        '# files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,',
        "# modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the",
        "# Software is furnished to do so, subject to the following conditions:", "#",
        "# The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ])
    rows = [
        (None, None), (1, ""), (2, apache), (2, apache), (3, "Home | About\n" + apache), (4, mit), (5, f"{mit}\n\n{apache} All rights reserved."),
        (6, "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
            "warranties of merchantability, fitness for a particular purpose and noninfringement."),
        (7, "we talk of the license"), (8, "x" * 80_000 + ".\n" + apache), (9, f"{apache} {apache}\nReleased under the MIT License."),
    ]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, licenses string, _state int").drop("_state")
    found = licenses.scan(docs).collect()
    got = {r.doc_id: (r.sentence_ids, r.licenses, r.unmatched_ids) for r in found}
    assert len(found) == len(rows)
    assert got[None] == got[1] == got[7] == ([], [], [])
    assert got[2] == got[3] == got[8] == (["apache2"], ["Apache-2.0"], [])
    assert got[4] == (["mit_grant", "mit_notice"], ["MIT"], [])
    assert got[5][1:] == (["MIT", "Apache-2.0", "LicenseRef-AllRightsReserved"], [])
    assert got[6] == (["as_is"], [], ["as_is"])
    assert got[9] == (["apache2", "apache2", "mit_name"], ["MIT", "Apache-2.0"], [])
    assert licenses.scan(docs.limit(0)).collect() == []


def test_every_sentence_is_one_that_the_cut_gives(spark):
    """Each sentence of the table is found in its own text as it stands, and stays one sentence."""
    texts = [(s, i) for i, own in licenses.LICENSE_SENTENCES.items() for s in own]
    assert not [s for s, _ in texts if re.search(licenses.SENTENCE_END, s)]
    rows = [(n, f"Some words before. {s}.\nMore words.", i) for n, (s, i) in enumerate(texts)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, id string"))
    assert [(r.doc_id, r.sentence_ids) for r in found.collect() if r.sentence_ids != [r.id]] == []
    known = {i for _, ids in licenses.RULES for i in ids}
    assert known <= set(licenses.SENTENCES.values())


def test_every_rule_names_its_licence(spark):
    """Texts made of a rule's sentences name its licence and leave nothing over, whichever rule comes before."""
    sentence = {i: s for s, i in reversed(licenses.SENTENCES.items())}
    rows = [(n, ". ".join(sentence[i] for i in ids), licence) for n, (licence, ids) in enumerate(licenses.RULES)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, licence string"))
    wrong = [(r.licence, r.licenses, r.unmatched_ids) for r in found.collect() if r.licenses != [r.licence] or r.unmatched_ids]
    assert wrong == []
    assert len({licence for licence, _ in licenses.RULES}) > 40


NOTICES = {
    "GPL-3.0-or-later": """
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
""",
    "GPL-2.0-or-later": """
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
""",
    "LGPL-2.1-or-later": """
// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.
""",
    "MPL-2.0": """
/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
""",
    "Apache-2.0": """
// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
//
// Unless required by applicable law or agreed to in writing, software
// distributed under the License is distributed on an "AS IS" BASIS,
// WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
// See the License for the specific language governing permissions and
// limitations under the License.
""",
    "Zlib": """
This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-2.0": "// SPDX-License-Identifier: EPL-2.0\nint main;",
    "Apache-2.0 OR MIT": "/* SPDX-License-Identifier: (Apache-2.0 OR MIT) */",
}


@pytest.mark.parametrize("licence", NOTICES)
def test_public_notices(spark, licence):
    rows = spark.createDataFrame([(1, NOTICES[licence]), (2, "Words before.\n" + NOTICES[licence].replace("\n", "\r\n"))], "doc_id int, text string")
    found = licenses.scan(rows).collect()
    assert [r.licenses for r in found][0] == [licence]
    if licence != "EPL-2.0":
        assert [r.licenses for r in found][1] == [licence]


def test_what_a_rule_takes_does_not_join_its_neighbours(spark):
    sentences, rules = {"aa": "a", "bb": "b", "cc": "c"}, [("C", ["c"]), ("AB", ["a", "b"])]
    docs = spark.createDataFrame([(1, "Aa. Cc. Bb."), (2, "Cc. Aa. Bb."), (3, "no such word"), (4, None)], "doc_id int, text string")
    found = {r.doc_id: (r.licenses, r.unmatched_ids) for r in licenses.scan(docs, sentences, rules).collect()}
    assert found == {1: (["C"], ["a", "b"]), 2: (["C", "AB"], []), 3: ([], []), 4: ([], [])}


def test_hint_follows_the_sentences():
    sentences = {"the quick brown fox": "x", "one lazy dog": "y", "12": "z"}
    hint = licenses.hint_of(sentences)
    assert all(re.search(hint, s) for s in sentences) and hint == licenses.hint_of(dict(reversed(sentences.items())))
    assert licenses.hint_of({"": "empty"}) == ""
    assert all(re.search(licenses.hint_of(licenses.SENTENCES), s) for s in licenses.SENTENCES)
