"""Licence scans by sentence rules.

A text is cut into sentences, which also end at lines without letters, around copyright lines and at SPDX tags;
sentences are normalised, and those of known licence texts get an
identifier; a sentence that is not known as a whole is tried line by line, an SPDX expression name by name. The identifiers of a text,
in order, are matched against ordered rules, each a run of identifiers: a rule that matches takes its
identifiers away, so that a longer text is not reported again by a shorter one. All in SQL functions;
texts without any of the words that licence sentences have cost one search.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence texts, grants or notices, each as published. Order is that of the rules.
TEXTS = {
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the "
        "names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-3.0-or-later": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "LGPL-2.1-or-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so."
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted."
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0."
    ),
    "PostgreSQL": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without "
        "fee, and without a written agreement is hereby granted, provided that the above copyright notice and this "
        "paragraph and the following two paragraphs appear in all copies."
    ),
    "NCSA": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal with the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "WTFPL": "You just do what the fuck you want to.",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
}
# The title lines with which licence files begin.
TITLES = {
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "MPL-2.0": "Mozilla Public License Version 2.0",
    "EPL-2.0": "Eclipse Public License - v 2.0",
    "CC0-1.0": "CC0 1.0 Universal",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003",
}
# Identifiers of SPDX tags besides the names above, as the public list spells them.
SPDX = (
    "GPL-3.0-only", "GPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "LGPL-2.1", "Apache-1.1", "Artistic-2.0",
    "BSD-4-Clause", "BSD-3-Clause-Clear", "CDDL-1.0", "CDDL-1.1", "CC-BY-3.0", "CC-BY-SA-3.0", "EPL-1.0", "EUPL-1.2", "MPL-1.1",
    "MS-PL", "MS-RL", "Python-2.0", "PSF-2.0", "Ruby", "Vim", "W3C", "X11", "curl", "Libpng", "OpenSSL", "AFL-3.0", "BlueOak-1.0.0",
)
# Names that a notice like "licensed under the ..." gives a licence.
NAMES = {
    "MIT": ("MIT License", "MIT license terms", "terms of the MIT License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-3.0": (
        "GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL, version 3", "GPL-3.0", "GPLv3",
    ),
    "GPL-2.0": (
        "GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL, version 2", "GPL-2.0", "GPLv2",
    ),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause"),
    "ISC": ("ISC License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}

#: A mark after a word ends a sentence; one at the head of a line is a comment sign.
SPLIT = r"([^ \t\r\n\f;][.!?:;])[ \t\r\n\f]+"
#: A line that begins with a copyright sign and a year or sign, a line break before a line without letters, and an SPDX tag.
OWNER = r"(?im)^[^A-Za-z0-9\n]*(copyright|©|\(c\))[^A-Za-z\n]*(\(c\)|©|[0-9]{4})[^\n]*$"
EMPTY = r"\n[^A-Za-z0-9\n]*\n"
TAG = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+([ \t]+(AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)"
#: What parts the names of an SPDX expression.
NAMED = "[ \t()]+((AND|OR|WITH|and|or|with)[ \t(]+)?"
OTHER = "[^a-z0-9]+"
#: Ways to begin a notice; all are read as "under".
LEAD = (
    "^(this (work|software|project|program|file|code|document|text) is )?"
    "(licensed|released|distributed|published|available) under (the )?"
)
#: A sentence that names whoever holds the copyright.
HOLDER = "^neither the names? of .* nor the names of (its|their|the|any) contributors"
HELD = "neither the name of the copyright holder nor the names of its contributors"
#: Every known sentence has one of these, before and after normalising.
CUES = "licen[cs]|copyright|permitted|permission|redistribut|free software|unencumbered|under|spdx|cc0|you want to"


def normal(sentence: str) -> str:
    return re.sub(HOLDER, HELD, re.sub(LEAD, "under ", re.sub(OTHER, " ", sentence.lower()).strip()))


def _sentences(text: str) -> list[str]:
    return [normal(s) for s in re.sub(SPLIT, "\\1\x01", text).split("\x01")]


def rules() -> list[tuple[str, list[str]]]:
    """Licence and its normalised sentences, in the order in which rules are tried."""
    notices = [(name, [normal(f"licensed under {spelt}")]) for name, spellings in NAMES.items() for spelt in spellings]
    titles = [(name, [normal(title)]) for name, title in TITLES.items()]
    tags = [(name, [normal(f"spdx {name}")]) for name in dict.fromkeys([*TEXTS, *NAMES, *SPDX])]
    return [(name, _sentences(text)) for name, text in TEXTS.items()] + notices + titles + tags


def numbered() -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Identifier of each known sentence, and name and identifier run of each rule."""
    known = {}
    for _, run in rules():
        for sentence in run:
            known.setdefault(sentence, f"<s{len(known) + 1}>")
    return known, [(name, "".join(known[s] for s in run)) for name, run in rules()]


def _normal(sentence: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(sentence), OTHER, " "))
    return F.regexp_replace(F.regexp_replace(plain, LEAD, "under "), HOLDER, HELD)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentences``, the identifiers of known licence sentences in order, and ``licences``, found names.

    Names are in the order of the rules, each once, joined by commas. A null or empty text has none;
    whole texts are read. Columns of these names are replaced, others kept; repeated rows get equal
    results, and an empty table stays empty.
    """
    known, runs = numbered()
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    of = lambda s: F.element_at(table, _normal(s))
    lines = lambda s: F.array_join(F.transform(F.split(s, "\n"), of), "")
    names_of = lambda s: F.transform(F.split(F.substring(s, 6, 1 << 30), NAMED), lambda n: of(F.concat(F.lit("spdx "), n)))
    parts = lambda s: F.when(s.startswith("spdx "), F.array_join(names_of(s), "")).otherwise(lines(s))
    whole = lambda s: F.coalesce(of(s), parts(s))
    marked = F.regexp_replace(F.regexp_replace(own, OWNER, "\x01$0\x01"), EMPTY, "\x01\n")
    marked = F.regexp_replace(marked, TAG, "\x01spdx $1\x01")
    cut = F.split(F.regexp_replace(marked, SPLIT, "$1\x01"), "\x01")
    found = F.when(F.lower(own).rlike(CUES), F.array_join(F.transform(cut, whole), "")).otherwise("")
    steps = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(r).alias("run")) for n, r in runs))
    start = F.struct(F.col("sentences").alias("rest"), F.array().cast("array<string>").alias("names"))

    def step(state, rule):
        hit = F.contains(state["rest"], rule["run"])
        names = F.when(hit, F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"])
        return F.struct(F.replace(state["rest"], rule["run"], F.lit(" ")).alias("rest"), names.alias("names"))

    names = F.aggregate(steps, start, step, lambda state: F.array_join(state["names"], ","))
    rows = df.withColumn("sentences", found)
    return rows.withColumn("licences", F.when(F.col("sentences") == "", "").otherwise(names))


def scan_sql(table: str, doc_id: str = "doc_id", text: str = "text") -> str:
    """The same scan as SQL for DuckDB: ``doc_id, sentences, licences``."""
    known, runs = numbered()
    values = ", ".join(f"('{s}', '{i}')" for s, i in known.items())
    normal_sql = f"regexp_replace(trim(regexp_replace(lower(s), '{OTHER}', ' ', 'g')), '{LEAD}', 'under ')"
    normal_sql = f"regexp_replace({normal_sql}, '{HOLDER}', '{HELD}')"
    marked = f"regexp_replace(regexp_replace(text, '{OWNER}', chr(1) || '\\0' || chr(1), 'g'), '{EMPTY}', chr(1) || chr(10), 'g')"
    marked = f"regexp_replace({marked}, '{TAG}', chr(1) || 'spdx \\1' || chr(1), 'g')"
    parts = f"""CASE WHEN starts_with(s, 'spdx ') THEN list_transform(string_split_regex(s[6:], '{NAMED}'), lambda n: 'spdx ' || n)
        ELSE string_split(s, chr(10)) END"""
    rest = "SELECT doc_id, sentences, sentences AS rest, CAST([] AS VARCHAR[]) AS names FROM f"
    for name, run in runs:
        rest = (
            f"SELECT doc_id, sentences, replace(rest, '{run}', ' ') AS rest, CASE WHEN contains(rest, '{run}') "
            f"AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM ({rest})"
        )
    return f"""
    WITH known AS (SELECT * FROM (VALUES {values}) AS v(sentence, id)),
    t AS (SELECT {doc_id} AS doc_id, row_number() OVER () AS r, coalesce({text}, '') AS text FROM {table}),
    l AS (SELECT doc_id, r, string_split(regexp_replace({marked}, '{SPLIT}', '\\1' || chr(1), 'g'), chr(1)) AS l FROM t),
    p AS (SELECT r, unnest(l) AS s, unnest(range(len(l))) AS i FROM l),
    w AS (SELECT r, i, s, id FROM p LEFT JOIN known ON sentence = {normal_sql}),
    n AS (SELECT r, i, unnest({parts}) AS s, unnest(range(len({parts}))) AS j
        FROM w WHERE id IS NULL),
    k AS (SELECT r, i, 0 AS j, id FROM w WHERE id IS NOT NULL
        UNION ALL SELECT r, i, j, id FROM n JOIN known ON sentence = {normal_sql}),
    a AS (SELECT r, string_agg(id, '' ORDER BY i, j) AS sentences FROM k GROUP BY r),
    f AS (SELECT doc_id, coalesce(sentences, '') AS sentences FROM t LEFT JOIN a USING (r))
    SELECT doc_id, sentences, array_to_string(names, ',') AS licences FROM ({rest})
    """
