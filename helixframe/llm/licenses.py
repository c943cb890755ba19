"""Operator 5: licence scans by sentence rules.

Texts are normalised with their line and sentence ends kept as boundaries; known licence sentences
are found between two boundaries, however their lines are wrapped, and the sequence of identifiers is
matched against ordered rules. Both tables are small and fixed,
so they travel inside the plan: one pass over the documents, no shuffle and no Python.

Null and empty texts have no sentences and no licences. Repeated sentences repeat their identifier;
matches of different rules are all reported, in the rules' order: of several, the first is the primary one.
Equal texts have equal results; texts are read whole, whatever their length; an empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import table

# Sentences of public licence texts and notices, normalised (lower case, words of letters and digits).
SENTENCES = [
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("apache-grant", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice-2", "licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("gpl3-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-see", "see the gnu general public license for more details"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-warranty", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("cc-by-notice", "licensed under cc by 4 0"),
    ("cc-by-sa-notice", "licensed under cc by sa 4 0"),
    ("cc0-notice", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights", "all rights reserved"),
    ("apache-copy", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("bsd-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-warranty", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("lgpl21-redistribute", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3-redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-hope", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl-see", "see the gnu lesser general public license for more details"),
    ("agpl-redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-see", "see the gnu affero general public license for more details"),
    ("epl2-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("bsl-grant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("zlib-warranty", "this software is provided as is without any express or implied warranty"),
    ("zlib-liability", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib-grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("mpl-copy", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
]
# Fixed values, by precedence: licence -> the identifiers that must follow one another, however much text lies between them.
RULES = {
    "Apache-2.0-header": ["apache-grant", "apache-copy", "apache-basis", "apache-see"],
    "Apache-2.0": ["apache-notice"],
    "MIT-text": ["mit-grant", "mit-condition", "mit-warranty"],
    "MIT": ["mit-notice"],
    "MIT-named": ["mit-notice-2"],
    "AGPL-3.0-or-later": ["agpl-redistribute", "gpl-hope", "agpl-see"],
    "LGPL-3.0-or-later": ["lgpl3-redistribute", "gpl-hope", "lgpl-see"],
    "LGPL-2.1-or-later": ["lgpl21-redistribute", "lgpl-hope", "lgpl-see"],
    "GPL-3.0-or-later": ["gpl-redistribute", "gpl-hope", "gpl-see"],
    "GPL-2.0-or-later": ["gpl2-redistribute", "gpl-hope", "gpl-see"],
    "GPL-3.0": ["gpl3-notice"],
    "BSD-3-Clause": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"],
    "BSD-2-Clause": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"],
    "ISC": ["isc-grant", "isc-warranty"],
    "BSL-1.0": ["bsl-grant"],
    "Zlib": ["zlib-warranty", "zlib-liability", "zlib-grant"],
    "EPL-2.0": ["epl2-notice"],
    "MPL-2.0-header": ["mpl-notice", "mpl-copy"],
    "MPL-2.0": ["mpl-notice"],
    "CC-BY-NC-4.0": ["cc-by-nc-notice"],
    "CC-BY-SA-4.0": ["cc-by-sa-notice"],
    "CC-BY-4.0": ["cc-by-notice"],
    "CC0-1.0": ["cc0-notice"],
    "Unlicense": ["unlicense"],
}
# Boundaries: line ends, sentence marks that white space follows, and list marks at the begin of a line.
_END = r"[.!?]+[ \t\r\n]+"
_LIST = r"(^|\n)[^a-z0-9\n]*([0-9]{1,2}|[a-z])[.)][ \t]+"


def hints(sentences: list[str], least: int = 6) -> list[str]:
    """Few words of at least so many letters, one of which every sentence holds: of those that most of the open sentences hold, the longest."""
    words, left = [], [set(s.split()) for s in sentences]
    while left:
        known = sorted({w for s in left for w in s if len(w) >= least})
        words.append(max(known, key=lambda w: (sum(w in s for s in left), len(w))))
        left = [s for s in left if words[-1] not in s]
    return words


#: A text without any of these words holds no known sentence: the cheap first test of a lower-cased text.
_HINT = "|".join(hints([s for _, s in SENTENCES]))


def normalised(text: Column) -> Column:
    """Words of letters and digits in lower case between single spaces, with boundaries as line ends."""
    cut = F.regexp_replace(F.regexp_replace(F.lower(text), _LIST, "\n"), _END, "\n")
    return F.regexp_replace(cut, "[^a-z0-9\n]+", " ")


def sentence_ids(text: Column) -> Column:
    """The known identifiers of a text's sentences, in order; of two that start together the longer one."""
    sentences = {s: name for name, s in SENTENCES}
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    wrapped = "|".join(s.replace(" ", "[ \n]+") for s in sorted(sentences, key=len, reverse=True))
    found = F.regexp_extract_all(normalised(text), F.lit(f"(?:^|\n) *({wrapped})(?= *(?:\n|$))"), F.lit(1))
    ids = F.transform(found, lambda s: F.element_at(known, F.regexp_replace(s, "[ \n]+", " ")))
    return F.when(F.lower(text).rlike(_HINT), ids).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: dict[str, list[str]] | None = None) -> DataFrame:
    """(key, sentence_ids, licenses, n_known): licences whose identifiers occur next to one another in the rule's order, by precedence."""
    ids = docs.select(key, sentence_ids(F.coalesce(F.col(text), F.lit(""))).alias("found"))
    sequence = F.concat(F.lit("|"), F.array_join("found", "|"), F.lit("|"))
    rows = ids.select(key, F.col("found").alias("sentence_ids"), F.size("found").cast("long").alias("n_known"), sequence.alias("sequence"))
    tests = [F.when(F.contains(F.col("sequence"), F.lit("|" + "|".join(parts) + "|")), F.lit(name)) for name, parts in (rules or RULES).items()]
    return rows.select(key, "sentence_ids", F.array_compact(F.array(*tests)).alias("licenses"), "n_known")


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("sentence_ids", "|").alias("sentence_ids"), F.array_join("licenses", "|").alias("licenses"), F.coalesce(F.get("licenses", F.lit(0)), F.lit("")).alias("primary_license"), "n_known")


def oracle_sql() -> str:
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    known = ", ".join(f"({q(s)}, {q(n)})" for n, s in SENTENCES)
    rules = ", ".join(f"({i}, {q(n)}, {q('|' + '|'.join(p) + '|')})" for i, (n, p) in enumerate(RULES.items()))
    return f"""
WITH known(sentence, id) AS (VALUES {known}), rules(place, license, pattern) AS (VALUES {rules}),
cut AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?]+)[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
s AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
w AS (SELECT doc_id, place, part, id FROM s LEFT JOIN known ON trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) = sentence),
c AS (SELECT doc_id, place, string_split(part, chr(10)) AS lines FROM w WHERE id IS NULL),
l AS (SELECT doc_id, place, unnest(lines) AS line, generate_subscripts(lines, 1) AS row FROM c),
f AS (SELECT doc_id, place, 0 AS row, id FROM w WHERE id IS NOT NULL
      UNION ALL SELECT doc_id, place, row, id FROM l JOIN known ON trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) = sentence),
g AS (SELECT doc_id, string_agg(id, '|' ORDER BY place, row) AS ids, count(*) AS n FROM f GROUP BY doc_id),
h AS (SELECT doc_id, string_agg(license, '|' ORDER BY rules.place) AS licenses, min_by(license, rules.place) AS first FROM g JOIN rules ON contains('|' || ids || '|', pattern) GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.ids, '') AS sentence_ids, coalesce(h.licenses, '') AS licenses, coalesce(h.first, '') AS primary_license, coalesce(g.n, 0) AS n_known
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN h ON d.doc_id = h.doc_id"""


ORACLE_SQL = oracle_sql()
