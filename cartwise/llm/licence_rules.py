"""Licence scan by sentence rules.

A text is cut into sentences; each is normalised (lower case, runs of other characters than letters and
digits become one space) and looked up among known licence sentences. What remains of a text is the ordered
list of known sentence identifiers, and a rule is an ordered list of identifiers that must occur in it side
by side, unknown sentences between them left out. Everything is one projection of SQL functions over the
scan: no shuffle, and the tables of sentences and rules are literals of fixed size.

An SPDX tag states licences itself, so its expression is read by its grammar and its identifiers are licences as
they are written, exceptions included.

A notice may stand on a line of its own or be wrapped over comment lines, so two readings are matched: one
ends sentences at line ends, the other joins the lines of a paragraph first and drops comment leaders.

Defined cases: null and empty texts have no sentences and no licence; repeated rows give repeated results;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import text_or_empty

# Public licence notices, one sentence each.
SENTENCES = {
    "apache2-short": "Licensed under the Apache License, Version 2.0.",
    "apache2-head": 'Licensed under the Apache License, Version 2.0 (the "License"); '
    "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-copy-s": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache2-obtain": "You may obtain a copy of the License at",
    "apache2-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-url-s": "https://www.apache.org/licenses/LICENSE-2.0",
    "apache2-asis": "Unless required by applicable law or agreed to in writing, software distributed under the "
    'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express '
    "or implied.",
    "apache2-see": "See the License for the specific language governing permissions and limitations under the "
    "License.",
    "mit-short": "Released under the MIT License.",
    "mit-short-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
    "copies.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-head": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "gpl2-head": "This program is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
    "or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "mpl2-head": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ccbync4-short": "Licensed under CC BY-NC 4.0.",
    "ccby4-short": "Licensed under CC BY 4.0.",
    "ccby4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "isc-grant-2": "Permission to use, copy, modify, and distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-endorse-2": "Neither the name of the University nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "lgpl21-head": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
    "(at your option) any later version.",
    "lgpl3-head": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "agpl3-head": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.",
    "epl2-head": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense-head": "This is free and unencumbered software released into the public domain.",
    "zlib-head": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-short": "Distributed under the Boost Software License, Version 1.0.",
    "cc0-head": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
    "neighboring rights to this software to the public domain worldwide.",
    "ccbysa4-short": "Licensed under CC BY-SA 4.0.",
    "ccbysa4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl2-short": "This work is licensed under the GNU General Public License, version 2.",
    "bsd3-short": "Released under the BSD 3-Clause License.",
    "spdx-key": "SPDX-License-Identifier:",
}

# Rule, the licence that it proves, the sentences that must follow each other.
RULES = (
    ("apache2-notice", "Apache-2.0", ("apache2-short",)),
    ("apache2-header", "Apache-2.0", ("apache2-head", "apache2-copy", "apache2-asis", "apache2-see")),
    ("apache2-header-s", "Apache-2.0", ("apache2-head", "apache2-copy-s", "apache2-asis", "apache2-see")),
    ("apache2-file", "Apache-2.0", ("apache2-head", "apache2-obtain", "apache2-url", "apache2-asis", "apache2-see")),
    ("apache2-file-s", "Apache-2.0", ("apache2-head", "apache2-obtain", "apache2-url-s", "apache2-asis", "apache2-see")),
    ("mit-notice", "MIT", ("mit-short",)),
    ("mit-notice-2", "MIT", ("mit-short-2",)),
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("bsd3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("bsd2-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("bsd3-text-2", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-2")),
    ("bsd3-notice", "BSD-3-Clause", ("bsd3-short",)),
    ("isc-text", "ISC", ("isc-grant",)),
    ("isc-text-2", "ISC", ("isc-grant-2",)),
    ("epl2-header", "EPL-2.0", ("epl2-head",)),
    ("unlicense-text", "Unlicense", ("unlicense-head",)),
    ("zlib-text", "Zlib", ("zlib-head", "zlib-grant")),
    ("boost-notice", "BSL-1.0", ("boost-short",)),
    ("cc0-text", "CC0-1.0", ("cc0-head",)),
    ("ccbysa4-notice", "CC-BY-SA-4.0", ("ccbysa4-short",)),
    ("ccbysa4-text", "CC-BY-SA-4.0", ("ccbysa4-long",)),
    ("gpl3-notice", "GPL-3.0", ("gpl3-short",)),
    ("gpl3-header", "GPL-3.0-or-later", ("gpl3-head", "gpl-hope", "gpl-details")),
    ("gpl2-notice", "GPL-2.0", ("gpl2-short",)),
    ("lgpl21-header", "LGPL-2.1-or-later", ("lgpl21-head", "lgpl-hope", "lgpl-details")),
    ("lgpl3-header", "LGPL-3.0-or-later", ("lgpl3-head", "gpl-hope", "lgpl-details")),
    ("agpl3-header", "AGPL-3.0-or-later", ("agpl3-head", "gpl-hope", "agpl-details")),
    ("gpl2-header", "GPL-2.0-or-later", ("gpl2-head", "gpl-hope", "gpl-details")),
    ("mpl2-header", "MPL-2.0", ("mpl2-head",)),
    ("ccbync4-notice", "CC-BY-NC-4.0", ("ccbync4-short",)),
    ("ccby4-notice", "CC-BY-4.0", ("ccby4-short",)),
    ("ccby4-text", "CC-BY-4.0", ("ccby4-long",)),
)

# A rule that another one makes moot where that other one matched as well.
MOOT = (("bsd2-text", "bsd3-text"), ("bsd2-text", "bsd3-text-2"))

# A tag names its licences itself: identifiers joined by AND, OR and WITH, in brackets or not.
TAG = "SPDX-License-Identifier:[ \t]*([(]*[A-Za-z0-9.+-]+[)]*(?:[ \t]+(?:AND|OR|WITH)[ \t]+[(]*[A-Za-z0-9.+-]+[)]*)*)"
TAG_WORD = "[A-Za-z0-9.+-]+"
TAG_JOINS = ("AND", "OR", "WITH")

SENTENCE_END = "([.!?:;])[ \t\r\n]+"
LINE_JOIN = "\r?\n[ \t]*[#*/;%]*[ \t]*"
PARAGRAPH = "\r?\n[ \t]*[#*/;%]*[ \t]*\r?\n[ \t\r\n]*"
ITEM = "\n(?:[(]?[0-9a-z][.)]|[*•-])[ \t]+"
OTHER = "[^a-z0-9\n]+"


def normal_form(sentence: str) -> str:
    """What a known sentence looks like after normalisation (a sentence with inner ends keeps them joined)."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _pieces(text: str) -> list[str]:
    return [normal_form(p) for p in re.sub(SENTENCE_END, r"\1" + "\n", text).split("\n")]


def _known(sentences: dict[str, str]) -> dict[str, str]:
    """Normalised piece -> identifier. A sentence with an end inside is known by the pieces it is cut into:
    the last one carries the identifier, the others `identifier/1`, `/2`, ...; a piece that several sentences
    have keeps its first identifier."""
    known: dict[str, str] = {}
    for name, text in sentences.items():
        *heads, last = _pieces(text)
        for i, piece in enumerate(heads, 1):
            known.setdefault(piece, f"{name}/{i}")
        known.setdefault(last, name)
    return known


def _expanded(rule: tuple[str, ...], sentences: dict[str, str]) -> list[str]:
    known = _known(sentences)
    return [known[piece] for name in rule for piece in _pieces(sentences[name])]


def _sentence_ids(text: Column, known: Column) -> Column:
    cut = F.regexp_replace(text, SENTENCE_END, "$1\n")
    plain = F.regexp_replace(F.lower(F.regexp_replace(cut, ITEM, "\n")), OTHER, " ")
    ids = F.transform(F.split(plain, "\n"), lambda s: F.try_element_at(known, F.trim(s)))
    return F.filter(ids, lambda x: x.isNotNull())


def _is_not(rule: str) -> Callable[[Column], Column]:
    return lambda hit: hit["rule"] != rule


def scan_licences(
    docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES, moot: tuple[tuple[str, str], ...] | None = None
) -> DataFrame:
    """doc_id, sentence_ids (of the reading with more known sentences, the line reading at a tie), n_known,
    rules and licences, each sorted and joined by commas."""
    sentences = SENTENCES if sentences is None else sentences
    moot = MOOT if moot is None else moot
    known = F.create_map(*[F.lit(x) for pair in _known(sentences).items() for x in pair])
    text = text_or_empty()
    unwrapped = F.regexp_replace(F.regexp_replace(text, PARAGRAPH, "\u2029"), LINE_JOIN, " ")
    tagged = F.flatten(
        F.transform(F.regexp_extract_all(text, F.lit(TAG), 1), lambda t: F.regexp_extract_all(t, F.lit(f"({TAG_WORD})")))
    )
    read = docs.select(
        "doc_id",
        F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), F.filter(tagged, lambda t: ~t.isin(*TAG_JOINS)))
        .otherwise(F.array().cast("array<string>"))
        .alias("tagged"),
        _sentence_ids(text, known).alias("lines"),
        _sentence_ids(F.translate(unwrapped, "\u2029", "\n"), known).alias("joined"),
    )
    joined = lambda c: F.concat(F.lit(","), F.array_join(c, ","), F.lit(","))
    matched = read.withColumns({"a": joined("lines"), "b": joined("joined")})
    # One test per rule, not a lambda over a rule table: a lambda would work out `a` and `b` for each rule anew.
    tests = []
    for name, licence, parts in rules:
        ids = F.lit("," + ",".join(_expanded(parts, sentences)) + ",")
        hit = F.contains(F.col("a"), ids) | F.contains(F.col("b"), ids)
        tests.append(F.when(hit, F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence"))))
    matched = matched.withColumn("hits", F.filter(F.array(*tests), lambda r: r.isNotNull()))
    names = F.transform("hits", lambda r: r["rule"])
    for weaker, stronger in moot:
        others = F.filter("hits", _is_not(weaker))
        matched = matched.withColumn(
            "hits", F.when(F.array_contains(names, stronger), others).otherwise(F.col("hits"))
        )
    best = F.when(F.size("joined") > F.size("lines"), F.col("joined")).otherwise(F.col("lines"))
    return matched.select(
        "doc_id",
        F.array_join(best, ",").alias("sentence_ids"),
        F.size(best).cast("long").alias("n_known"),
        F.array_join(F.array_sort(names), ",").alias("rules"),
        F.array_join(F.array_sort(F.array_union(F.transform("hits", lambda r: r["licence"]), F.col("tagged"))), ",").alias(
            "licences"
        ),
    )


def oracle(table: str = "documents") -> str:
    """The same result in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = _known(SENTENCES)
    names = "[" + ", ".join(quote(k) for k in known) + "]"
    ids = "[" + ", ".join(quote(v) for v in known.values()) + "]"
    rules = ", ".join(
        f"({quote(name)}, {quote(licence)}, {quote(',' + ','.join(_expanded(parts, SENTENCES)) + ',')})"
        for name, licence, parts in RULES
    )
    moot = " AND ".join(
        f"NOT (rule = {quote(w)} AND list_contains(all_rules, {quote(s)}))" for w, s in MOOT
    )

    def e(pattern: str) -> str:
        escaped = pattern.replace("\r", "\\r").replace("\n", "\\n").replace("\t", "\\t")
        return quote(escaped)

    def ids_of(name: str, text: str) -> str:
        cut = f"regexp_replace({text}, {e(SENTENCE_END)}, '\\1' || chr(10), 'g')"
        items = f"regexp_replace({cut}, {e(ITEM)}, chr(10), 'g')"
        plain = f"regexp_replace(lower({items}), {e(OTHER)}, ' ', 'g')"
        return f"""{name}_s AS (SELECT r, unnest(l) AS s, generate_subscripts(l, 1) AS pos
              FROM (SELECT r, string_split({plain}, chr(10)) AS l FROM d)),
        {name} AS (SELECT r, list(i ORDER BY pos) AS ids FROM {name}_s JOIN known ON k = trim(s, ' ') GROUP BY r)"""

    sep = "chr(8233)"
    unwrapped = f"regexp_replace(regexp_replace(t, {e(PARAGRAPH)}, {sep}, 'g'), {e(LINE_JOIN)}, ' ', 'g')"
    unwrapped = f"replace({unwrapped}, {sep}, chr(10))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {table}),
        known AS (SELECT unnest({names}) AS k, unnest({ids}) AS i),
        rules(rule, licence, ids) AS (VALUES {rules}),
        {ids_of("lines", "t")},
        {ids_of("joined", unwrapped)},
        both_ AS (SELECT d.r, d.doc_id, coalesce(l.ids, []) AS l, coalesce(j.ids, []) AS j
            FROM d LEFT JOIN lines l ON l.r = d.r LEFT JOIN joined j ON j.r = d.r),
        hits AS (SELECT b.r, x.rule, x.licence, list(x.rule) OVER (PARTITION BY b.r) AS all_rules
            FROM both_ b JOIN rules x ON contains(',' || array_to_string(b.l, ',') || ',', x.ids)
                OR contains(',' || array_to_string(b.j, ',') || ',', x.ids)),
        found AS (SELECT r, string_agg(rule, ',' ORDER BY rule) AS rules FROM hits WHERE {moot} GROUP BY r),
        tags AS (SELECT r, unnest(regexp_extract_all(t, {e(TAG)}, 1)) AS tag FROM d),
        tagged AS (SELECT r, unnest(regexp_extract_all(tag, {e(TAG_WORD)})) AS licence FROM tags),
        proved AS (SELECT r, string_agg(licence, ',' ORDER BY licence) AS licences
            FROM (SELECT r, licence FROM hits WHERE {moot}
                UNION SELECT r, licence FROM tagged WHERE licence NOT IN ({', '.join(map(quote, TAG_JOINS))})) GROUP BY r)
    SELECT b.doc_id,
        array_to_string(CASE WHEN len(j) > len(l) THEN j ELSE l END, ',') AS sentence_ids,
        greatest(len(j), len(l))::BIGINT AS n_known,
        coalesce(f.rules, '') AS rules, coalesce(p.licences, '') AS licences
    FROM both_ b LEFT JOIN found f ON f.r = b.r LEFT JOIN proved p ON p.r = b.r"""
