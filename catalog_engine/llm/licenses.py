"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each is normalised, and sentences that are known
become identifiers; all others are left out. Ordered rules then name the
licences: a rule is a sequence of identifiers, and the first rule that matches
takes its identifiers out of the sequence before the next one is tried. What is
left on both sides of them stays apart. All of it happens inside the row, so
there is nothing to shuffle.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import table

# Sentences of public licences and their notices, as they are cut from the texts, by identifier.
LICENSE_SENTENCES = {
    "apache2": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License")',
        "This project is licensed under the Apache License 2.0",
    ],
    "apache2_use": ["you may not use this file except in compliance with the License"],
    "apache2_copy": [
        "You may obtain a copy of the License at",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    ],
    "apache2_as_is": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "apache2_see": ["See the License for the specific language governing permissions and limitations under the License"],
    "apache2_grant": [
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
        "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    ],
    "apache2_redistribution": [
        "You may reproduce and distribute copies of the Work or Derivative Works thereof in any medium, with or without modifications, "
        "and in Source or Object form, provided that You meet the following conditions",
    ],
    "mit_name": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License"],
    "mit_grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions",
    ],
    "mit0_grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so",
    ],
    "mit_notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "as_is": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "mit_liable": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ],
    "bsd_grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ],
    "bsd_source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "bsd_binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution",
    ],
    "bsd_advertising": [
        "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    ],
    "bsd_names": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
    ],
    "bsd_as_is": [
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    ],
    "isc_grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
    ],
    "bsd0_grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "gpl_free": ["This program is free software", "This library is free software"],
    "gpl_foundation": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation",
    ],
    "gpl2_foundation": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free "
        "Software Foundation",
    ],
    "gpl3_later": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "lgpl_foundation": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
    ],
    "lgpl3_later": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "agpl3_later": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "version2": ["version 2 of the License"],
    "version2_later": ["either version 2 of the License, or (at your option) any later version"],
    "version21_later": ["either version 2.1 of the License, or (at your option) any later version"],
    "version3": ["version 3 of the License"],
    "version3_later": ["either version 3 of the License, or (at your option) any later version"],
    "gpl_hope": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    ],
    "gpl_implied": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl_details": [
        "See the GNU General Public License for more details", "See the GNU Lesser General Public License for more details",
        "See the GNU Affero General Public License for more details",
    ],
    "gpl3_name": [
        "This work is licensed under the GNU General Public License version 3", "Licensed under the GNU General Public License version 3",
    ],
    "gpl2_contrast": [
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make "
        "sure the software is free for all its users",
    ],
    "lgpl21_contrast": [
        "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change free software--to make "
        "sure the software is free for all its users",
    ],
    "gpl3_preamble": ["The GNU General Public License is a free, copyleft license for software and other kinds of works"],
    "agpl3_preamble": [
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed "
        "to ensure cooperation with the community in the case of network server software",
    ],
    "lgpl3_incorporates": [
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General "
        "Public License, supplemented by the additional permissions listed below",
    ],
    "mpl2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "mpl2_copy": [
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "epl2": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "zlib_as_is": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib_liable": ["In no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib_grant": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions",
    ],
    "bsl1_name": ["Distributed under the Boost Software License, Version 1.0"],
    "bsl1_grant": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the '
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
        "so, all subject to the following",
    ],
    "cc0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software "
        "to the public domain worldwide",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
        "neighboring rights to this work",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "unlicense_free": [
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
    "ofl11": ["This Font Software is licensed under the SIL Open Font License, Version 1.1"],
    "wtfpl": [
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as "
        "long as the name is changed",
    ],
    "reserved": ["All rights reserved"],
}
# Ordered rules, the licence and the identifiers that name it. Longer evidence comes first.
LICENSE_RULES = [
    ("BSD-4-Clause", "bsd_grant bsd_source bsd_binary bsd_advertising bsd_names bsd_as_is"),
    ("BSD-4-Clause", "bsd_grant bsd_source bsd_binary bsd_advertising bsd_names"),
    ("BSD-3-Clause", "bsd_grant bsd_source bsd_binary bsd_names bsd_as_is"),
    ("BSD-3-Clause", "bsd_grant bsd_source bsd_binary bsd_names"),
    ("BSD-2-Clause", "bsd_grant bsd_source bsd_binary bsd_as_is"),
    ("BSD-2-Clause", "bsd_grant bsd_source bsd_binary"),
    ("MIT", "mit_name mit_grant mit_notice as_is mit_liable"),
    ("MIT", "mit_grant mit_notice as_is mit_liable"),
    ("MIT", "mit_name mit_grant mit_notice as_is"),
    ("MIT", "mit_grant mit_notice as_is"),
    ("MIT", "mit_grant mit_notice"),
    ("MIT-0", "mit0_grant as_is mit_liable"),
    ("MIT-0", "mit0_grant"),
    ("MIT", "mit_name"),
    ("ISC", "isc_grant"),
    ("0BSD", "bsd0_grant"),
    ("Apache-2.0", "apache2_grant apache2_redistribution"),
    ("Apache-2.0", "apache2 apache2_use apache2_copy apache2_as_is apache2_see"),
    ("Apache-2.0", "apache2 apache2_use"),
    ("Apache-2.0", "apache2"),
    ("AGPL-3.0-or-later", "gpl_free agpl3_later gpl_hope gpl_implied gpl_details"),
    ("AGPL-3.0-or-later", "gpl_free agpl3_later"),
    ("LGPL-3.0-or-later", "gpl_free lgpl3_later gpl_hope gpl_implied gpl_details"),
    ("LGPL-3.0-or-later", "gpl_free lgpl3_later"),
    ("LGPL-3.0-or-later", "gpl_free lgpl_foundation version3_later"),
    ("LGPL-2.1-or-later", "gpl_free lgpl_foundation version21_later gpl_hope gpl_implied gpl_details"),
    ("LGPL-2.1-or-later", "gpl_free lgpl_foundation version21_later"),
    ("GPL-3.0-or-later", "gpl_free gpl3_later gpl_hope gpl_implied gpl_details"),
    ("GPL-3.0-or-later", "gpl_free gpl3_later"),
    ("GPL-3.0-or-later", "gpl_free gpl_foundation version3_later"),
    ("GPL-2.0-or-later", "gpl_free gpl_foundation version2_later gpl_hope gpl_implied gpl_details"),
    ("GPL-2.0-or-later", "gpl_free gpl_foundation version2_later"),
    ("GPL-3.0-only", "gpl_free gpl_foundation version3"),
    ("GPL-2.0-only", "gpl_free gpl_foundation version2"),
    ("GPL-2.0-only", "gpl_free gpl2_foundation"),
    ("GPL-3.0-only", "gpl3_name"),
    ("GPL-3.0-only", "gpl3_preamble"),
    ("GPL-2.0-only", "gpl2_contrast"),
    ("LGPL-2.1-only", "lgpl21_contrast"),
    ("LGPL-3.0-only", "lgpl3_incorporates"),
    ("AGPL-3.0-only", "agpl3_preamble"),
    ("MPL-2.0", "mpl2 mpl2_copy"),
    ("MPL-2.0", "mpl2"),
    ("EPL-2.0", "epl2"),
    ("Zlib", "zlib_as_is zlib_liable zlib_grant"),
    ("BSL-1.0", "bsl1_grant"),
    ("BSL-1.0", "bsl1_name"),
    ("CC0-1.0", "cc0"),
    ("Unlicense", "unlicense unlicense_free"),
    ("Unlicense", "unlicense"),
    ("OFL-1.1", "ofl11"),
    ("WTFPL", "wtfpl"),
    ("LicenseRef-AllRightsReserved", "reserved"),
]
# Creative Commons licences, by short and long name.
CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CREATIVE_COMMONS_VERSIONS = {"4.0": "International", "3.0": "Unported"}
# A tag line names its licence itself. White space after its colon ends no sentence.
TAG = "SPDX-License-Identifier"
# A sentence ends at a stop before white space, at an empty line, or with the text; a line can be a sentence of its own.
SENTENCE_END = r"(?<=[.!?:;])[ \t\n\r]+|\n[ \t\r]*\n"
NOISE = r"[^a-z0-9.\"/-]+"
# Strokes and hyphens of their own, as comments begin with.
LONE_MARKS = r"( [/-]+)+ "
# Words of a hint are at least so long where a sentence has such words.
HINT_LETTERS = 7
# Stands for identifiers that a rule has taken, so that those on both sides do not become neighbours.
TAKEN = "-"


def plain(sentence: str) -> str:
    """What ``normalised`` makes of a sentence."""
    clean = re.sub(LONE_MARKS, " ", " " + re.sub(NOISE, " ", sentence.lower()) + " ")
    return re.sub(r"[ .]+$", "", clean.strip(" "))


def known_sentences() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Identifier of every known sentence, and the rules: those above, Creative Commons by name, and a tag for each licence."""
    sentences = {plain(s): name for name, texts in LICENSE_SENTENCES.items() for s in texts}
    rules = [(licence, ids.split(" ")) for licence, ids in LICENSE_RULES]
    for short, long in CREATIVE_COMMONS.items():
        for version, where in CREATIVE_COMMONS_VERSIONS.items():
            licence = f"CC-{short}-{version}"
            for text in (f"Licensed under CC {short} {version}", f"This work is licensed under a Creative Commons {long} {version} {where} License"):
                sentences[plain(text)] = licence.lower()
            rules.append((licence, [licence.lower()]))
    named = [n for n in dict.fromkeys(licence for licence, _ in rules) if not n.startswith("LicenseRef")]
    for licence in [*named, "MIT OR Apache-2.0", "Apache-2.0 OR MIT"]:
        tag = "tag " + licence.lower()
        sentences[plain(f"{TAG} {licence}")] = tag
        rules.append((licence, [tag]))
    return sentences, rules


SENTENCES, RULES = known_sentences()


def hint_of(sentences: dict[str, str]) -> str:
    """A pattern that each of the sentences matches: few words, chosen one by one, most sentences first.

    Texts without it hold no known sentence, so they are not cut. A sentence without letters and figures makes it match all.
    """
    chosen, left = [], list(sentences)
    while left:
        counts = Counter()
        for sentence in left:
            words = set(re.findall("[a-z0-9]+", sentence))
            if not words:
                return ""
            counts.update(w for w in words if len(w) >= min(HINT_LETTERS, max(map(len, words))))
        word = min(counts, key=lambda w: (-counts[w], w))
        chosen.append(word)
        left = [s for s in left if word not in s]
    return "|".join(chosen)


def normalised(lower: Column) -> Column:
    """Of a sentence in lower case: letters, digits, quotes, stops, strokes and hyphens stay, all else is one space; no stop at the end."""
    clean = F.concat(F.lit(" "), F.regexp_replace(lower, NOISE, " "), F.lit(" "))
    return F.regexp_replace(F.trim(F.regexp_replace(clean, LONE_MARKS, " ")), r"[ .]+$", "")


def identifiers(lower: Column, sentences: dict[str, str], hint: str) -> Column:
    """Identifiers of the known sentences of a text in lower case, in order.

    A sentence that is not known as a whole is read line by line, so that a
    heading or a list before a licence line does not hide it.
    """
    names, ids = F.array(*[F.lit(s) for s in sentences]), F.array(*[F.lit(i) for i in sentences.values()])

    def known(sentence: Column) -> Column:
        return F.try_element_at(ids, F.nullif(F.array_position(names, normalised(sentence)), F.lit(0)).cast("int"))

    def of(sentence: Column) -> Column:
        whole = known(sentence)
        by_line = F.transform(F.split(sentence, r"\n"), known)
        return F.when(whole.isNotNull() | ~sentence.contains("\n"), F.array(whole)).otherwise(by_line)

    tagged = F.regexp_replace(lower, f"{TAG.lower()}:[ \t]*", f"{TAG.lower()} ")
    cut = F.filter(F.split(tagged, SENTENCE_END), lambda s: s.rlike(hint))
    return F.array_compact(F.flatten(F.transform(cut, of)))


def after_rule(state: Column, rule: Column) -> Column:
    """The sequence and the licences found, once a rule was tried on them."""
    matches = state["left"].contains(rule["part"])
    return F.struct(
        F.replace(state["left"], rule["part"], F.lit(f",{TAKEN},")).alias("left"),
        F.when(matches, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"),
    )


def part_of(ids: list[str]) -> str:
    """A rule as a part of the sequence, which has every identifier between commas."""
    return "," + ",,".join(ids) + ","


def scan(
    docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None
) -> DataFrame:
    """``docs`` with ``sentence_ids``, ``licenses`` (in the order of the rules, each once) and ``unmatched_ids``.

    Columns of these names are replaced. A null or empty text has three empty
    lists. Every row is scanned whole and by itself, so repeated rows come out
    alike, and an empty table stays empty. Rules and sentences are parameters of
    fixed size; sentences are given as ``plain`` makes them, and identifiers
    without commas.
    """
    sentences, rules = SENTENCES if sentences is None else sentences, RULES if rules is None else rules
    nothing = F.array().cast("array<string>")
    if not sentences or not rules:
        raise ValueError("a scan needs sentences and rules")
    hint = hint_of(sentences)
    lower = F.lower(F.col("text").cast("string"))
    hinted = F.coalesce(lower.rlike(hint), F.lit(False))
    found = docs.withColumn("sentence_ids", F.when(hinted, identifiers(lower, sentences, hint)).otherwise(nothing))
    sequence = F.concat(F.lit(","), F.array_join("sentence_ids", ",,"), F.lit(","))
    tried = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(part_of(ids)).alias("part")) for licence, ids in rules])
    state = F.aggregate(tried, F.struct(sequence.alias("left"), nothing.alias("found")), after_rule)
    left = F.filter(F.split("_state.left", ","), lambda x: ~x.isin("", TAKEN))
    return (
        found.withColumn("_state", F.when(F.size("sentence_ids") > 0, state))
        .withColumn("licenses", F.coalesce(F.array_distinct("_state.found"), nothing))
        .withColumn("unmatched_ids", F.coalesce(left, nothing))
        .drop("_state")
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents; lists are printed with commas."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs).select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"),
        F.array_join("unmatched_ids", ",").alias("unmatched_ids"),
    )


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same scan for an engine without look-behind: sentence ends are marked, then cut."""
    clean = "rtrim(trim(regexp_replace(' ' || regexp_replace(lower({}), '[^a-z0-9.\"/-]+', ' ', 'g') || ' ', '( [/-]+)+ ', ' ', 'g')), '. ')"
    known = ", ".join(f"({quoted(s)}, {quoted(i)})" for s, i in SENTENCES.items())
    steps, last = [], "select doc_id, ids, case when ids = '' then '' else ',' || replace(ids, ',', ',,') || ',' end as rest, '' as found from joined"
    for licence, ids in RULES:
        part = quoted(part_of(ids))
        last = (
            f"select doc_id, ids, replace(rest, {part}, ',{TAKEN},') as rest, "
            f"case when contains(rest, {part}) then found || ',{licence}' else found end as found from ({last})"
        )
    steps.append(f"scanned as ({last})")
    return f"""
with known(sentence, id) as (values {known}),
texts as (
    select doc_id, regexp_replace(lower(text), '{TAG.lower()}:[ \\t]*', '{TAG.lower()} ', 'g') as text from documents
), cut as (
    select doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '([.!?:;])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'),
        '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(1))) as sentence,
        generate_subscripts(string_split(regexp_replace(regexp_replace(text, '([.!?:;])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'),
        '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(1)), 1) as place
    from texts
), lines as (
    select c.doc_id, place, unnest(case when w.id is not null then [c.sentence] else string_split(c.sentence, chr(10)) end) as line,
        generate_subscripts(case when w.id is not null then [c.sentence] else string_split(c.sentence, chr(10)) end, 1) as line_place
    from cut c left join known w on w.sentence = {clean.format("c.sentence")}
), joined as (
    select d.doc_id, coalesce(j.ids, '') as ids from documents d left join (
        select doc_id, string_agg(k.id, ',' order by place, line_place) as ids
        from lines l join known k on k.sentence = {clean.format("l.line")} group by doc_id
    ) j using (doc_id)
), {steps[0]}
select doc_id, ids as sentence_ids, array_to_string(list_filter(list_transform(
    range(1, len(string_split(found, ',')) + 1), lambda i: case when not list_contains(string_split(found, ',')[:i - 1], string_split(found, ',')[i])
    then string_split(found, ',')[i] end), lambda x: x is not null and x <> ''), ',') as licenses,
    array_to_string(list_filter(string_split(rest, ','), lambda x: x <> '' and x <> '{TAKEN}'), ',') as unmatched_ids
from scanned
"""
