"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised and looked up among known licence
sentences, and the sequence of the identifiers found is matched against ordered
rules. Rules come longest first, and a match uses up its identifiers. The tables are
fixed and small, so the whole scan is one pass without a shuffle. A known sentence that
follows unfinished prose on its own line is not found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.text import ascii_lower, or_empty

# Published licence notices, sentence by sentence, and what their
# sequences mean.
SENTENCES: dict[str, str] = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute": "This program is free software: you can redistribute it and/or modify it "
    "under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "mit-released": "Released under the MIT License.",
    "mit-notice": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    'this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-include": "The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met:",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors "
    "may be used to endorse or promote products derived from this software without specific "
    "prior written permission.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or "
    "neighboring rights to this work.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "gpl2-later": "This program is free software; you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation; either "
    "version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl3-only": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
    "lgpl21-later": "This library is free software; you can redistribute it and/or modify it under "
    "the terms of the GNU Lesser General Public License as published by the Free Software "
    "Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-later": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "agpl3-later": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "classpath": "As a special exception, the copyright holders of this library give you permission "
    "to link this library with independent modules to produce an executable, regardless of the "
    "license terms of these independent modules, and to copy and distribute the resulting "
    "executable under terms of your choice, provided that you also meet, for each linked "
    "independent module, the terms and conditions of the license of that module.",
    "gcc-exception": "Under Section 7 of GPL version 3, you are granted additional permissions "
    "described in the GCC Runtime Library Exception, version 3.1, as published by the Free Software "
    "Foundation.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose "
    "with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies.",
    "isc-older": "Permission to use, copy, modify, and distribute this software for any purpose with "
    "or without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose "
    "with or without fee is hereby granted.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-free": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
    "this software, either in source code form or as a compiled binary, for any purpose, commercial "
    "or non-commercial, and by any means.",
    "epl2": "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License 2.0 which is available at",
    "epl2-older": "This program and the accompanying materials are made available under the terms of "
    "the Eclipse Public License v2.0 which accompanies this distribution.",
    "epl1": "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License v1.0 which accompanies this distribution, and is available at",
    "bsl1": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions:",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "mit-title": "The MIT License (MIT)",
    "bsd3-title": "BSD 3-Clause License",
    "bsd2-title": "BSD 2-Clause License",
    "isc-title": "ISC License",
    "apache-under": "This project is licensed under the Apache License 2.0.",
    "mit-under": "This project is licensed under the MIT License.",
    "gpl-under": "This project is licensed under the GNU General Public License v3.0.",
}
#: Identifiers that may follow the tag of a machine-readable licence line.
SPDX = (
    *("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause"),
    *("BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0"),
    *("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    *("ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    *("MIT", "MPL-2.0", "Unlicense", "WTFPL", "Zlib", "MIT OR Apache-2.0", "Apache-2.0 OR MIT"),
    *("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0 WITH Linux-syscall-note"),
)
SENTENCES |= {f"spdx-{x}": f"SPDX-License-Identifier: {x}" for x in SPDX}
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl-redistribute", "gpl-hope", "gpl-details")),
    ("MIT", ("mit-grant", "mit-include")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-endorse")),
    ("GPL-3.0-or-later", ("gpl-redistribute",)),
    ("BSD-2-Clause", ("bsd-redistribution",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("MPL-2.0", ("mpl2",)),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ("gpl2-later", "gpl-hope", "gpl-details", "classpath")),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ("gpl2-later", "classpath")),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ("gpl2-only", "gpl-hope", "gpl-details", "classpath")),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ("gpl2-only", "classpath")),
    ("GPL-3.0-or-later WITH GCC-exception-3.1", ("gpl-redistribute", "gpl-hope", "gpl-details", "gcc-exception")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-details")),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-3.0-only", ("gpl3-only", "gpl-hope", "gpl-details")),
    ("GPL-3.0-only", ("gpl3-only",)),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-hope", "lgpl-details")),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later", "gpl-hope", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-hope", "agpl-details")),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-older",)),
    ("0BSD", ("0bsd-grant",)),
    ("Unlicense", ("unlicense", "unlicense-free")),
    ("Unlicense", ("unlicense",)),
    ("EPL-2.0", ("epl2",)),
    ("EPL-2.0", ("epl2-older",)),
    ("EPL-1.0", ("epl1",)),
    ("BSL-1.0", ("bsl1",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("WTFPL", ("wtfpl",)),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("EPL-2.0", ("epl2-title",)),
    ("MIT", ("mit-title", "mit-grant", "mit-include")),
    ("MIT", ("mit-title",)),
    ("BSD-3-Clause", ("bsd3-title", "bsd-redistribution", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd3-title",)),
    ("BSD-2-Clause", ("bsd2-title", "bsd-redistribution")),
    ("BSD-2-Clause", ("bsd2-title",)),
    ("ISC", ("isc-title", "isc-grant")),
    ("ISC", ("isc-title",)),
    ("Apache-2.0", ("apache-under",)),
    ("MIT", ("mit-under",)),
    ("GPL-3.0", ("gpl-under",)),
    *[(x, (f"spdx-{x}",)) for x in SPDX],
]

#: What ends a sentence: a mark before white space, or an empty line.
ENDS = r"([.!?;:])[\x20\x09-\x0D]+|\n[\x20\x09\x0D]*\n"
#: The same where every line ends a sentence, for notices after unfinished prose.
LINE_ENDS = r"([.!?;:])[\x20\x09-\x0D]+|\n"


def normal(sentence: Column) -> Column:
    """Lower-case ASCII letters and digits, one space between runs of them."""
    return F.trim(F.regexp_replace(ascii_lower(sentence), "[^a-z0-9]+", " "))


def _plain(sentence: str) -> str:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def _parts(sentence: str) -> list[str]:
    """A known sentence as the cutter sees it: a mark inside it ends a part."""
    for mark in ".!?;:":
        sentence = sentence.replace(mark + " ", mark + "\n")
    return [_plain(part) for part in sentence.split("\n") if _plain(part)]


def known_sentences() -> dict[str, str]:
    """Normalised sentence (or part of one) to identifier; parts are numbered.

    Sentences that share a part share its identifier, the first one's.
    """
    known: dict[str, str] = {}
    for name, sentence in SENTENCES.items():
        parts = _parts(sentence)
        for i, part in enumerate(parts):
            known.setdefault(part, name if len(parts) == 1 else f"{name}/{i}")
    return known


def rule_sequences() -> list[tuple[str, list[str]]]:
    """Rules over the identifiers of ``known_sentences``, longest first."""
    known = known_sentences()
    rules = [
        (licence, [known[part] for name in names for part in _parts(SENTENCES[name])])
        for licence, names in RULES
    ]
    return sorted(rules, key=lambda rule: -len(rule[1]))


def _identifiers(text: Column, ends: str) -> Column:
    """The known sentences' identifiers in order, each between bars: ``|a||b|``."""
    cut = F.split(F.regexp_replace(text, ends, "$1\u0001"), "\u0001")
    known = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    names = F.transform(cut, lambda s: F.try_element_at(known, normal(s)))
    barred = F.transform(
        F.array_compact(names), lambda name: F.concat(F.lit("|"), name, F.lit("|"))
    )
    return F.array_join(barred, "")


def _matches(identifiers: Column) -> Column:
    """The licences of the rules that match, in order; a match uses up its identifiers."""
    rules = F.array(
        *[
            F.struct(F.lit("".join(f"|{n}|" for n in names)).alias("seq"), F.lit(licence).alias("lic"))
            for licence, names in rule_sequences()
        ]
    )
    start = F.struct(identifiers.alias("rest"), F.array().cast("array<string>").alias("found"))

    def use(left: Column, rule: Column) -> Column:
        more = F.concat(left["found"], F.array(rule["lic"]))
        return F.struct(
            F.replace(left["rest"], rule["seq"], F.lit("-")).alias("rest"),
            F.when(F.contains(left["rest"], rule["seq"]), more).otherwise(left["found"]).alias("found"),
        )

    return F.aggregate(rules, start, use)["found"]


def license_scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, sentence_ids, licenses, n_licenses.

    Sentences are cut twice: across line breaks, as in wrapped licence texts, and with
    every line as a sentence; ``sentence_ids`` holds the identifiers of the cut that
    finds more (across lines where they tie) and ``licenses`` what either one matches,
    sorted and joined by commas. Null and empty texts have neither (empty strings).
    Repeated rows are scanned alike; an empty table gives an empty result; other columns
    are not read.
    """
    text = or_empty(text_col)
    cut = docs.select(
        F.col(id_col).alias("doc_id"),
        _identifiers(text, ENDS).alias("_wrapped"),
        _identifiers(text, LINE_ENDS).alias("_lines"),
    )
    either = F.concat(_matches(F.col("_wrapped")), _matches(F.col("_lines")))
    none = (F.col("_wrapped") == "") & (F.col("_lines") == "")
    licences = F.when(none, F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(either))
    )
    more = F.length("_lines") > F.length("_wrapped")
    names = F.when(more, F.col("_lines")).otherwise(F.col("_wrapped"))
    return cut.select(
        "doc_id",
        F.replace(F.btrim(names, F.lit("|")), F.lit("||"), F.lit(",")).alias("sentence_ids"),
        F.array_join(licences, ",").alias("licenses"),
        F.size(licences).cast("long").alias("n_licenses"),
    )
