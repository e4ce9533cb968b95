"""Licence recognition by sentences and rules, in DataFrame functions alone.

A text is cut into sentences, each sentence is normalised (ASCII lower case, everything but letters and
digits to single spaces), known sentences become identifiers, and the text's sequence of identifiers is
matched against ordered rules.  A rule holds where its identifiers stand in its order, with anything in
between; it takes them out of the sequence, so a longer rule leaves nothing for a shorter one that it
contains (the three clauses of BSD are not two clauses besides, and the notice at the end of a whole GPL
does not count once more).

Texts are cut in two ways: only blank lines and full stops ending sentences (hard-wrapped texts), and line
ends as well (notices on lines of their own).  The sequence is that of the first cut; identifiers that
only the second one finds follow it.  All of that happens inside the row: no group of rows is ever
gathered and nothing is shuffled.  Sentences are looked up by hash, so the work for a sentence does not
grow with the table; the tables are parameters.

Defined results: null and empty texts have no sentences and no licences; a sentence that occurs twice
is listed twice; repeated rows are each answered; a licence named again is listed once; extra columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of well-known licences and notices as published, by identifier.
PUBLISHED = {
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-keep": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "bsd-permit": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-advertising": ["All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the University of California, Berkeley and its contributors."],
    "bsd-endorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of the <organization> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "zlib-warranty": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain."],
    "unlicense-free": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "cc0-title": ["CC0 1.0 Universal"],
    "cc0-dedication": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."],
    "apache2-title": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "Apache License Version 2.0, January 2004"],
    "apache2-define": ["\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."],
    "apache2-grant": ["Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."],
    "apache2-comply": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "apache2-notice": ["Licensed under the Apache License, Version 2.0 (the \"License\");", "Licensed under the Apache License, Version 2.0"],
    "apache2-asis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache2-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "gnu-freedom": ["The licenses for most software are designed to take away your freedom to share and change it."],
    "gpl2-title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl3-title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "gpl3-copyleft": ["The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "lgpl21-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl3-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl3-terms": ["This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."],
    "agpl3-title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "agpl3-copyleft": ["The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."],
    "gpl2-grant": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl2-only": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License."],
    "gpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl21-grant": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gnu-warranty": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "mpl2-title": ["Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"],
    "mpl2-contributor": ["\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.", "means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."],
    "mpl2-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "mpl2-obtain": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "cc-by-4-terms": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-4-terms": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-4-terms": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}
#: What notices call a licence, by its name.
CALLED = {
    "MIT": ["the MIT license", "MIT"],
    "Apache-2.0": ["the Apache License 2.0", "the Apache License, Version 2.0", "Apache 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause license", "the Simplified BSD license"],
    "BSD-3-Clause": ["the BSD 3-Clause license", "the New BSD license"],
    "ISC": ["the ISC license"],
    "GPL-2.0": ["the GNU General Public License version 2", "the GNU GPL version 2", "the GPLv2"],
    "GPL-3.0": ["the GNU General Public License version 3", "the GNU GPL version 3", "the GPLv3"],
    "LGPL-2.1": ["the GNU Lesser General Public License version 2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License version 3"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "CC-BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "CC-BY-NC 4.0"],
    "CC0-1.0": ["CC0 1.0"],
    "Unlicense": ["the Unlicense"],
}
#: How such notices begin.
BEGINNINGS = ["Released under", "Licensed under", "Distributed under", "This software is released under", "This software is licensed under", "This work is licensed under", "This project is licensed under"]
#: Ordered rules.  Whole licences come first, then what they contain.
LONG_RULES = [
    ("MIT", ["mit-grant", "mit-keep", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("BSD-4-Clause", ["bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Apache-2.0", ["apache2-title", "apache2-define", "apache2-grant", "apache2-comply", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-title", "apache2-define", "apache2-grant"]),
    ("Apache-2.0", ["apache2-comply", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-comply"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("AGPL-3.0", ["agpl3-title", "agpl3-copyleft", "agpl3-grant", "gnu-warranty"]),
    ("AGPL-3.0", ["agpl3-title", "agpl3-copyleft"]),
    ("AGPL-3.0-or-later", ["agpl3-grant", "gnu-warranty"]),
    ("LGPL-3.0", ["lgpl3-title", "lgpl3-terms"]),
    ("LGPL-3.0-or-later", ["lgpl3-grant", "gnu-warranty"]),
    ("LGPL-2.1", ["lgpl21-title", "gnu-freedom", "lgpl21-grant", "gnu-warranty"]),
    ("LGPL-2.1", ["lgpl21-title", "gnu-freedom"]),
    ("LGPL-2.1-or-later", ["lgpl21-grant", "gnu-warranty"]),
    ("GPL-3.0", ["gpl3-title", "gpl3-copyleft", "gpl3-grant", "gnu-warranty"]),
    ("GPL-3.0", ["gpl3-title", "gpl3-copyleft"]),
    ("GPL-3.0-or-later", ["gpl3-grant", "gnu-warranty"]),
    ("GPL-2.0", ["gpl2-title", "gnu-freedom", "gpl2-grant", "gnu-warranty"]),
    ("GPL-2.0", ["gpl2-title", "gnu-freedom"]),
    ("GPL-2.0-or-later", ["gpl2-grant", "gnu-warranty"]),
    ("GPL-2.0", ["gpl2-only"]),
    ("MPL-2.0", ["mpl2-title", "mpl2-contributor", "mpl2-subject", "mpl2-obtain"]),
    ("MPL-2.0", ["mpl2-title", "mpl2-contributor"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-obtain"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-terms"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-terms"]),
    ("CC-BY-4.0", ["cc-by-4-terms"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC0-1.0", ["cc0-dedication"]),
    ("Unlicense", ["unlicense-grant", "unlicense-free"]),
    ("Unlicense", ["unlicense-grant"]),
]


def normal(sentence: str) -> str:
    """A sentence as it is looked up."""
    return " ".join(re.findall("[a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in sentence)))


def _sentences() -> dict[str, str]:
    """Normalised sentences with their identifiers: the published ones, notices and SPDX lines."""
    notices = {normal(f"{begin} {called}"): f"notice-{name.lower()}" for name, all_called in CALLED.items() for called in all_called for begin in BEGINNINGS}
    names = dict.fromkeys([*CALLED, *(name for name, _ in LONG_RULES)])
    spdx = {normal(f"SPDX-License-Identifier: {name}"): f"spdx-{name.lower()}" for name in names}
    return notices | spdx | {normal(s): key for key, texts in PUBLISHED.items() for s in texts}


SENTENCES = _sentences()
RULES = [*LONG_RULES, *((name, [f"notice-{name.lower()}"]) for name in CALLED), *((name, [f"spdx-{name.lower()}"]) for name in dict.fromkeys([*CALLED, *(n for n, _ in LONG_RULES)]))]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A sentence ends at . ! or ? before white space or the text's end, and at a line's end.
SENTENCE_END = "[.!?]+([ \\t\\r\\n]|\\z)|\\n"
#: A wrapped text keeps its sentences over single line ends.
WRAPPED_END = "[.!?]+([ \\t\\r\\n]|\\z)|\\n[ \\t\\r]*\\n"


def sentences(text: Column, wrapped: bool = False) -> Column:
    """The normalised sentences of a text, empty ones left out."""
    marked = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), WRAPPED_END if wrapped else SENTENCE_END, "|")
    plain = F.regexp_replace(F.regexp_replace(marked, "[^a-z0-9|]+", " "), " ?\\|+ ?", "|")
    return F.filter(F.split(plain, "\\|"), lambda s: F.trim(s) != "")


def identifiers(found: Column, known: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences, in order: looked up by hash, then by text."""
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    spark_hashes = [_xxhash(k) for k in known]
    held = F.filter(found, lambda s: F.xxhash64(F.trim(s)).isin(spark_hashes))
    return F.array_compact(F.transform(held, lambda s: F.try_element_at(table, F.trim(s))))


def _xxhash(text: str) -> int:
    """What xxhash64 gives for a string."""
    import xxhash

    n = xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (1 << 64) if n >= 1 << 63 else n


def _pattern(parts: list[str]) -> str:
    """Where the parts stand in order in a sequence written as ',a,,b,,c,'; what lies between is captured."""
    return "((?:,[^,]+,)*?)".join(f",{p}," for p in parts)


def _between(parts: list[str], sign: str) -> str:
    return "".join(f"{sign}{i}" for i in range(1, len(parts)))


def licences(ids: Column, rules: list[tuple[str, list[str]]] = RULES) -> Column:
    """The names of the rules that hold, in the rules' order; each takes what it matches."""
    table = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(_pattern(parts)).alias("pattern"), F.lit(_between(parts, "$")).alias("between")) for name, parts in rules))
    sequence = F.array_join(F.transform(ids, lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    none = F.array().cast("array<string>")
    start = F.struct(sequence.alias("left"), none.alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        left = F.regexp_replace(state["left"], rule["pattern"], rule["between"])
        return F.struct(left.alias("left"), F.when(left != state["left"], F.concat(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"))

    return F.when(F.size(ids) > 0, F.array_distinct(F.aggregate(table, start, apply, lambda s: s["names"]))).otherwise(none)


def scan(docs: DataFrame, known: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """doc_id with the number of sentences (of lines), the identifiers found and the licences named."""
    cut = docs.select("doc_id", sentences(F.col("text")).alias("lines"), identifiers(sentences(F.col("text"), True), known).alias("wrapped"))
    both = cut.select("doc_id", F.size("lines").cast("long").alias("n_sentences"), identifiers(F.col("lines"), known).alias("of_lines"), "wrapped")
    found = both.select("doc_id", "n_sentences", F.concat("wrapped", F.filter("of_lines", lambda x: ~F.array_contains(F.col("wrapped"), x))).alias("ids"))
    return found.select("doc_id", "n_sentences", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"), F.array_join(licences(F.col("ids"), rules), ",").alias("licenses"))


def _sql() -> str:
    quoted = lambda x: "'" + x + "'"
    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in SENTENCES.items())
    rules = ", ".join(f"({i}, {quoted(n)}, {quoted(_pattern(p))}, {quoted(_between(p, chr(92)))})" for i, (n, p) in enumerate(RULES, 1))
    return f"""
WITH RECURSIVE known(sentence, id) AS (VALUES {known}),
rules(i, name, pattern, between_parts) AS (VALUES {rules}),
lower_case AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
marked AS (SELECT doc_id, false AS wrapped, regexp_replace(t, '{SENTENCE_END}', '|', 'g') AS t FROM lower_case UNION ALL SELECT doc_id, true, regexp_replace(t, '{WRAPPED_END}', '|', 'g') FROM lower_case),
plain AS (SELECT doc_id, wrapped, regexp_replace(regexp_replace(t, '[^a-z0-9|]+', ' ', 'g'), ' ?\\|+ ?', '|', 'g') AS t FROM marked),
parts AS (SELECT doc_id, wrapped, unnest(string_split(t, '|')) AS s, generate_subscripts(string_split(t, '|'), 1) AS k FROM plain),
full_parts AS (SELECT doc_id, wrapped, trim(s) AS s, k FROM parts WHERE trim(s) <> ''),
counts AS (SELECT doc_id, count(*) AS n FROM full_parts WHERE NOT wrapped GROUP BY doc_id),
hits AS (SELECT doc_id, wrapped, k, id FROM full_parts JOIN known ON s = sentence),
used AS (SELECT * FROM hits h WHERE wrapped OR NOT EXISTS (SELECT 1 FROM hits w WHERE w.wrapped AND w.doc_id = h.doc_id AND w.id = h.id)),
found AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY wrapped DESC, k) AS ids, string_agg(',' || id || ',', '' ORDER BY wrapped DESC, k) AS seq FROM used GROUP BY doc_id),
steps AS (
  SELECT doc_id, 0 AS i, seq, NULL::VARCHAR AS name FROM found
  UNION ALL
  SELECT s.doc_id, r.i, regexp_replace(s.seq, r.pattern, r.between_parts, 'g'), CASE WHEN regexp_matches(s.seq, r.pattern) THEN r.name END FROM steps s JOIN rules r ON r.i = s.i + 1),
listed AS (SELECT doc_id, string_agg(name, ',' ORDER BY i) AS licenses FROM (SELECT doc_id, name, min(i) AS i FROM steps WHERE name IS NOT NULL GROUP BY doc_id, name) GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_sentences, coalesce(f.n, 0)::BIGINT AS n_known, coalesce(f.ids, '') AS sentence_ids, coalesce(l.licenses, '') AS licenses
FROM documents d LEFT JOIN counts c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""


#: The same in DuckDB's SQL.
OP6_SQL = _sql()


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    """Every document of the table."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
