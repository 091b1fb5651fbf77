import pytest
from compare import connect, spark_rows, sql_rows

from vacantia.llm import licenses, registry

SF = "/root/testdata/sf0.01"


def found(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.licences for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_query_agrees_with_sql(spark):
    columns, rows = spark_rows(registry.QUERIES["op4_licenses"](spark, SF))
    assert (columns, rows) == sql_rows(connect(SF), registry.SQL["op4_licenses"])
    assert any("Apache-2.0" in row[columns.index("licences")] for row in rows)


def test_every_known_sentence_has_a_cue():
    import re

    assert all(re.search(licenses.CUES, sentence) for sentence in licenses.numbered()[0])


@pytest.mark.parametrize("name", sorted(licenses.TEXTS))
def test_each_text_is_its_own_licence_however_wrapped(spark, name):
    import textwrap

    text = licenses.TEXTS[name]
    wrapped = "\n".join(f" * {line}" for line in textwrap.wrap(text, 60)).replace(" * ", "", 1)
    assert found(spark, f"Some prose. {text} More prose.", f"/* {wrapped}\n */", text.upper()) == [name, name, name]


AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
# Licence, what stands above its text in an ordinary file, and how its text goes on.
FILES = [
    ("MIT", "MIT License\n\nCopyright (c) 2024 A. B. Person\n\n", f"\n\n{AS_IS}\n"),
    ("MIT", "The MIT License (MIT)\nCopyright © 2019-2024 Some Co\n", f"\n\n{AS_IS}\n"),
    ("ISC", "ISC License\n\nCopyright (c) 2020, Person <p@h.example>\n\n", f"\n\n{AS_IS}\n"),
    ("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2018, P\nAll rights reserved.\n\n", f"\n\n{AS_IS}\n"),
    ("BSD-3-Clause", "Copyright 2018 P\n", f"\n\n{AS_IS}\n"),
    ("0BSD", "Copyright (C) 2006 by Rob <r@h.example>\n\n", f"\n\n{AS_IS}"),
    ("Zlib", "zlib License\n\n(C) 1995-2022 J and M\n\nThis software is provided 'as-is'.\n\n", "\n\n1. The origin must not be misrepresented."),
    ("BSL-1.0", "Boost Software License\n\n", f"\n\n{AS_IS}\n"),
    ("Unlicense", "", "\n\nAnyone is free to copy it.\n"),
    ("PostgreSQL", "PostgreSQL License\n\nPortions Copyright (c) 1996-2024, The Group\n\n", f"\n\n{AS_IS}\n"),
    ("MIT-0", "MIT No Attribution\n\nCopyright 2020 P\n\n", f"\n\n{AS_IS}\n"),
    ("NCSA", "Copyright (c) 2003 U\n\n", "\n\n* Redistributions of source code"),
]


@pytest.mark.parametrize("name, above, below", FILES)
def test_whole_files_with_headings_copyright_lines_and_comment_signs(spark, name, above, below):
    import textwrap

    file = above + "\n".join(textwrap.wrap(licenses.TEXTS[name], 70)) + below
    comments = ["\n".join(f"{sign} {line}".rstrip() for line in file.split("\n")) for sign in ("#", " *", "//", ";;")]
    texts = [file, *comments, f"some prose that does not end\n\n{file}", file.replace("\n", "\r\n")]
    assert found(spark, *texts) == [name] * len(texts)


def test_numbered_conditions_and_names_of_holders(spark):
    first, *rest = licenses.TEXTS["BSD-3-Clause"].replace("met: ", "met:|").replace("disclaimer. ", "disclaimer.|").replace("distribution. ", "distribution.|").split("|")
    rest[-1] = rest[-1].replace("the copyright holder nor the names of its", "Some Co., Ltd nor the names of any")
    file = "Copyright (c) 2020 X\n\n" + first + "\n\n" + "\n\n".join(f"{i + 1}. {r}" for i, r in enumerate(rest))
    assert found(spark, file) == ["BSD-3-Clause"]


def test_tags_and_titles(spark):
    texts = [
        "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: GPL-2.0-only\n#include <x>", "# spdx-license-identifier: (MIT OR Apache-2.0)\nimport x",
        "/* SPDX-License-Identifier: EPL-2.0 OR GPL-2.0-or-later WITH Classpath */", "SPDX-License-Identifier: Unheard-Of", "SPDX-License-Identifier:",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 F\n",
        "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n",
        "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions",
    ]
    want = ["MIT", "GPL-2.0-only", "MIT,Apache-2.0", "GPL-2.0-or-later,EPL-2.0", "", "", "GPL-3.0", "Apache-2.0", "MPL-2.0"]
    assert found(spark, *texts) == want


def test_files_agree_with_sql(spark, tmp_path):
    import duckdb

    texts = [a + licenses.TEXTS[n] + b for n, a, b in FILES] + ["SPDX-License-Identifier: (MIT OR Apache-2.0) AND Zlib", None, "", "\n\n\n", "© 2020\n\nx"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view d as select * from '{tmp_path}/d/*.parquet'")
    rows = {r[0]: r[1:] for r in con.execute(licenses.scan_sql("d")).fetchall()}
    assert {r.doc_id: (r.sentences, r.licences) for r in licenses.scan(df).collect()} == rows


def test_repeated_rows_get_equal_results(spark):
    assert found(spark, *["Released under the MIT License."] * 3) == ["MIT"] * 3


def test_notices_lines_and_order(spark):
    texts = [
        "prose without an end\nReleased under the MIT License.\nmore", "This work is licensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0. " + licenses.TEXTS["MIT"], "the license of this is unknown",
        "Released under the MIT License. Released under the MIT License.", "x" * 100_000 + "\nReleased under the MIT License.",
    ]
    assert found(spark, *texts) == ["MIT", "CC-BY-NC-4.0", "MIT,Apache-2.0", "", "MIT", "MIT"]


def test_nulls_empty_and_clashing_columns(spark):
    assert found(spark, None, "", "\x01") == ["", "", ""]
    df = spark.createDataFrame([("Released under the MIT License.", 5, 6)], "text string, sentences int, licences int")
    assert licenses.scan(df).first().licences == "MIT"
    assert licenses.scan(df.where("false")).count() == 0
