import random

import duckdb

from tickflow.llm.licenses import RULES, SENTENCES, license_scan
from tickflow.llm.queries import LLM_ORACLES


def scan(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.licenses for r in license_scan(docs).orderBy("doc_id").collect()]


def test_every_rule(spark):
    texts = ["\n\n".join(SENTENCES[name] for name in names) for _, names in RULES]
    assert scan(spark, *texts) == [licence for licence, _ in RULES]


def test_wrapped_and_unfinished(spark):
    mit = SENTENCES["mit-grant"].replace(" this software", "\nthis software")
    assert scan(
        spark,
        f"Some title\n\n{mit}\n{SENTENCES['mit-include']}",
        "prose without an end\nReleased under the MIT License.\nmore",
        "LICENSED UNDER  CC BY-NC 4.0!\nThis work is licensed under the GNU General Public "
        "License, version 3.",
        "the apache license, version 2.0, is not licensed under anything",
        None,
        "",
    ) == ["MIT", "MIT", "CC-BY-NC-4.0,GPL-3.0-only", "", "", ""]


HAND_MADE = [
    ("# SPDX-License-Identifier: GPL-2.0-only\nimport os", "GPL-2.0-only"),
    ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */", "MIT OR Apache-2.0"),
    ("<!-- SPDX-License-Identifier: LGPL-2.1-or-later -->\nMIT", "LGPL-2.1-or-later"),
    (
        " * This library is free software; you can redistribute it and/or\n * modify it under the terms "
        "of the GNU Lesser General Public\n * License as published by the Free Software Foundation; "
        "either\n * version 2.1 of the License, or (at your option) any later version.\n *\n * This "
        "library is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of\n * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the "
        "GNU\n * Lesser General Public License for more details.",
        "LGPL-2.1-or-later",
    ),
    (
        "This program is free software; you can redistribute it and/or modify it\nunder the terms of the "
        "GNU General Public License version 2 as published\nby the Free Software Foundation.\n\nThis "
        "program is distributed in the hope that it will be useful, but WITHOUT\nANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or\nFITNESS FOR A PARTICULAR PURPOSE.  See the GNU "
        "General Public License for\nmore details.",
        "GPL-2.0-only",
    ),
    (
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. As a special exception, the copyright holders of "
        "this library give you permission to link this library with independent modules to produce an "
        "executable, regardless of the license terms of these independent modules, and to copy and "
        "distribute the resulting executable under terms of your choice, provided that you also meet, for "
        "each linked independent module, the terms and conditions of the license of that module.",
        "GPL-2.0-or-later WITH Classpath-exception-2.0",
    ),
    (
        "ISC License\n\nCopyright (c) 2020 A. N. Other\n\nPermission to use, copy, modify, and/or "
        "distribute this software for any\npurpose with or without fee is hereby granted, provided that "
        "the above\ncopyright notice and this permission notice appear in all copies.",
        "ISC",
    ),
    ("                                 Apache License\n                           Version 2.0, January 2004\n"
     "                        http://www.apache.org/licenses/\n", ""),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", "Unlicense"),
    ("some prose. Distributed under the Boost Software License, Version 1.0. (See the file)", "BSL-1.0"),
    ("The GNU General Public License is long; the MIT License is short.", ""),
    ("MIT\nISC License Manager", ""),
]


def test_hand_made_notices(spark):
    assert scan(spark, *(t for t, _ in HAND_MADE)) == [licence for _, licence in HAND_MADE]


def test_sql_agrees_on_notices(spark, tmp_path):
    """The query's SQL on notices, awkward texts and shuffled sentences."""
    rng = random.Random(8)
    texts = [t for t, _ in HAND_MADE] + [None, "", "x" * 100_000, "MIT", "\n\n"]
    texts += ["\n".join(rng.choices(list(SENTENCES.values()), k=rng.randint(1, 5))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    columns = "doc_id, sentence_ids, licenses, n_licenses"
    want = sorted(con.execute(f"SELECT {columns} FROM ({LLM_ORACLES['op3_license_scan']})").fetchall())
    got = license_scan(docs).select(*columns.split(", ")).collect()
    assert sorted(map(tuple, got)) == want and sum(n for *_, n in want) > 60


def test_order_matters(spark):
    parts = [SENTENCES[x] for x in ("bsd-endorse", "bsd-redistribution")]
    assert scan(spark, " ".join(parts), " ".join(parts[::-1])) == ["BSD-2-Clause", "BSD-3-Clause"]


def test_edges(edge, empty):
    found = license_scan(edge).collect()
    assert len(found) == edge.count()
    assert {(r.sentence_ids, r.licenses, r.n_licenses) for r in found} == {("", "", 0)}
    assert license_scan(empty).count() == 0
