"""Licence recognition by sentence rules, in DataFrame functions alone.

A text is normalised (lower case, runs of other than letters and digits to one space) with its boundaries marked: a
sentence ends at ``.``, ``!``, ``?`` or ``;`` before white space or the text's end, so version numbers stay whole, and at a
blank line. A single line feed may be the end of a title or a wrapped sentence's: a known sentence may begin and end there, and
may have line feeds in it. Known sentences are mapped to their identifiers, from the left, the longest first. Unknown sentences stand
between the known ones; a list marker (``1.``, ``2)``, ``(a)``, ``iv.``, bullets) is none. A rule is an ordered sequence of identifiers; a
licence is found where the known identifiers of consecutive sentences contain its sequence. Longer rules come first: a sentence
that a longer rule has used is not used again.

A blank line before an address does not end a sentence. The dictionaries are small constants written into the plan. Null and
empty texts have no sentences. Equal rows are scanned each on their own. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier -> sentence, as published in the licence or in its usual notice.
SENTENCES: dict[str, str] = {
    "mit-release": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-name": "The MIT License (MIT)",
    "mit-title": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "apache-2-release": "Released under the Apache License, Version 2.0",
    "apache-2-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-2-licensed-notice": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-2-compliance": "you may not use this file except in compliance with the License",
    "apache-2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl-2-licensed": "Licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-no-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-licensed": "Licensed under CC BY 4.0",
    "cc-by-sa-licensed": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-licensed": "Licensed under CC BY-NC 4.0",
    "cc0-dedicated": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc0-deed": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of their rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "bsd-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    "apache-2-title": "Apache License Version 2.0, January 2004",
    "apache-2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl-2-kernel": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "library-no-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "mpl-2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc-name": "ISC License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense-released": "This is free and unencumbered software released into the public domain",
    "epl-2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl-1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}
#: (licence, ordered sentence identifiers)
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-2-licensed-notice", "apache-2-compliance", "apache-2-copy"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice"]),
    ("MIT", ["mit-name", "mit-grant", "mit-notice"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-no-warranty"]),
    ("Apache-2.0", ["apache-2-licensed-notice"]),
    ("Apache-2.0", ["apache-2-licensed"]),
    ("Apache-2.0", ["apache-2-release"]),
    ("MIT", ["mit-release"]),
    ("MIT", ["mit-licensed"]),
    ("GPL-3.0-only", ["gpl-3-work"]),
    ("GPL-3.0-only", ["gpl-3-licensed"]),
    ("GPL-2.0-only", ["gpl-2-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("CC-BY-4.0", ["cc-by-licensed"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-licensed"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-licensed"]),
    ("CC0-1.0", ["cc0-dedicated"]),
    ("CC0-1.0", ["cc0-deed"]),
    ("Apache-2.0", ["apache-2-title"]),
    ("GPL-2.0-only", ["gpl-2-kernel"]),
    ("MPL-2.0", ["mpl-2-form"]),
    ("ISC", ["isc-name", "isc-grant"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-and"]),
    ("0BSD", ["0bsd-grant"]),
    ("Unlicense", ["unlicense-released"]),
    ("EPL-2.0", ["epl-2-terms"]),
    ("EPL-1.0", ["epl-1-terms"]),
    ("BSL-1.0", ["bsl-title"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
]
#: (licence, what is licensed, licence's name, version) of the header that the Free Software Foundation recommends.
HEADERS: list[tuple[str, str, str, str]] = [
    ("GPL-2.0-or-later", "program", "General Public License", "2"),
    ("GPL-3.0-or-later", "program", "General Public License", "3"),
    ("LGPL-2.0-or-later", "library", "Library General Public License", "2"),
    ("LGPL-2.1-or-later", "library", "Lesser General Public License", "2.1"),
    ("LGPL-2.1-or-later", "program", "Lesser General Public License", "2.1"),
    ("LGPL-3.0-or-later", "library", "Lesser General Public License", "3"),
    ("LGPL-3.0-or-later", "program", "Lesser General Public License", "3"),
    ("AGPL-3.0-or-later", "program", "Affero General Public License", "3"),
]
HEADER = "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version"
#: Licence -> its usual names in notices of one sentence.
NAMES: dict[str, list[str]] = {
    "MIT": ["the MIT License", "the terms of the MIT License", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "the terms of the Apache License, Version 2.0", "Apache 2.0"],
    "GPL-2.0-only": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "the GPLv2"],
    "GPL-3.0-only": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "the GPLv3"],
    "LGPL-2.1-only": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the LGPLv2.1"],
    "LGPL-3.0-only": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the LGPLv3"],
    "AGPL-3.0-only": ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the AGPLv3"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the MPL 2.0"],
    "ISC": ["the ISC License"],
    "EPL-2.0": ["the Eclipse Public License 2.0"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "Unlicense": ["the Unlicense"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
NOTICES = [
    "Released under {}",
    "Licensed under {}",
    "Distributed under {}",
    "This project is licensed under {}",
    "This software is licensed under {}",
    "This work is licensed under {}",
    "This code is licensed under {}",
    "This project is released under {}",
    "This software is released under {}",
]
#: Elements of Creative Commons names; a licence's elements in this order, its name joins their words.
ELEMENTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
COMMONS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
COMMONS_VERSIONS = ["4.0 International", "3.0 Unported"]

#: Every sentence of ``SENTENCES`` but a few has one of these (``hint`` adds a word of those); texts without are not normalised.
HINT = "(?i)licen[sc]e|permi|redistribut|copyright|warrant"

_MARKER = "(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})"
#: (pattern, replacement) in order, on lower-case texts: ``E`` is an end, ``L`` a line feed or what may be in a sentence like one.
_BOUNDARIES = [
    (rf"(?dm)^([^a-z0-9\n]*{_MARKER})\)(?=[ \t-\r])", "$1. "),
    (rf"([:.!?;])([ \t-\r]+[^a-z0-9\n]{{0,3}}{_MARKER})[.)](?=[ \t-\r])", "$1 L $2. "),
    (r"[.!?;](?=[ \t-\r]|\z)", " E "),
    (r"\n[^a-z0-9E\n]*\n(?![^a-z0-9]{0,80}https?://)", " E "),
    (r"\n", " L "),
    ("[^a-z0-9EL]+", " "),
]
#: What is between two sentences that follow each other.
_NO_SENTENCE = rf"^[EL ]*({_MARKER} E[EL ]*)?\z"


def bounded(text: Column) -> Column:
    """The text's normalised words with ``E`` and ``L`` between them."""
    text = F.lower(text)
    for pattern, by in _BOUNDARIES:
        text = F.regexp_replace(text, pattern, by)
    return F.concat(F.lit("E "), F.trim(text), F.lit(" E"))


def plain(sentence: str) -> str:
    """The words of a constant as ``bounded`` writes them."""
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in sentence.lower()).split())


def _headers() -> Iterator[tuple[str, str, str]]:
    """(licence, identifier, sentence) that follow from ``HEADERS``, ``NOTICES`` with ``NAMES``, and ``COMMONS``."""
    for licence, what, name, version in HEADERS:
        yield licence, f"{licence.lower()}-{what}", HEADER.format(what=what, name=name, version=version)
    for licence, names in NAMES.items():
        for sentence in (notice.format(name) for name in names for notice in NOTICES):
            yield licence, plain(sentence).replace(" ", "-"), sentence
    for code in COMMONS:
        words = "-".join(ELEMENTS[e] for e in code.split("-"))
        for version in COMMONS_VERSIONS:
            licence = f"CC-{code}-{version.split()[0]}"
            for article in ("a", "the"):
                for start in ("Licensed", "This work is licensed"):
                    yield licence, f"{licence.lower()}-{start.split()[0].lower()}-{article}", f"{start} under {article} Creative Commons {words} {version} License"


def _add_headers() -> None:
    """What ``SENTENCES`` has already keeps its identifier; notices without a hint word, as of CC names, are left out."""
    texts = set(map(plain, SENTENCES.values()))
    for licence, name, sentence in _headers():
        if plain(sentence) not in texts and re.search(HINT, sentence):
            texts.add(plain(sentence))
            SENTENCES[name] = sentence
            RULES.append((licence, [name]))


_add_headers()


def hint(sentences: dict[str, str]) -> str:
    """A pattern that is in every text with a sentence: ``HINT``, and the longest words of the sentences without."""
    others = {max(plain(s).split(), key=len) for s in sentences.values() if plain(s) and not re.search(HINT, plain(s))}
    return "|".join([HINT, *sorted(others)])


def _words_pattern(sentence: str) -> str:
    """Of a sentence in ``bounded`` text: line feeds between its words, ends where it has its own."""
    parts = [plain(part).replace(" ", " (?:L )*+") for part in re.split(r"[.!?;](?=[ \t-\r])", sentence)]
    return " (?:[EL] )*+".join(part for part in parts if part)


def alternatives(sentences: list[str]) -> str:
    """Of sentences in their order, those of one first word together, so that other words are passed at once."""
    groups: dict[str, list[str]] = {}
    for sentence in sentences:
        first, _, rest = _words_pattern(sentence).partition(" ")
        groups.setdefault(first, []).append(f" {rest}" if rest else "")
    return "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in groups.items())


def scan(documents: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Per row: doc_id, sentence_ids (of the known sentences, in order) and licences (distinct, sorted).

    The known sentences are written as ``|id|``, a gap of unknown ones as ``~``, so that a rule is a substring.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = F.create_map(*[F.lit(x) for name, text in sentences.items() for x in (plain(text), name)])
    longest = sorted((text for text in set(sentences.values()) if plain(text)), key=lambda text: (-len(plain(text)), text))
    any_known = "(?<=[EL] )(?:" + alternatives(longest) + ")(?= [EL])"
    ordered = sorted(rules, key=lambda rule: -len(rule[1]))
    patterns = F.array(*[F.struct(F.lit("".join(f"|{i}|" for i in ids)).alias("pattern"), F.lit(licence).alias("licence")) for licence, ids in ordered])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = F.when(text.rlike(hint(sentences)), F.split(F.regexp_replace(bounded(text), any_known, "\n$0\n"), "\n")).otherwise(F.array().cast("array<string>"))
    names = F.transform(parts, lambda s: F.coalesce(F.try_element_at(known, F.regexp_replace(s, " [EL](?= )", "")), F.when(s.rlike(_NO_SENTENCE), "").otherwise("~")))
    ids = F.filter(names, lambda s: s != "")
    found = documents.select("doc_id", ids.alias("ids"))
    written = F.array_join(F.transform("ids", lambda i: F.when(i == "~", i).otherwise(F.concat(F.lit("|"), i, F.lit("|")))), "")
    start = F.struct(written.alias("left"), F.array().cast("array<string>").alias("licences"))
    matched = F.aggregate(
        patterns,
        start,
        lambda state, rule: F.when(
            F.contains(state["left"], rule["pattern"]),
            F.struct(F.replace(state["left"], rule["pattern"], F.lit("~")).alias("left"), F.concat(state["licences"], F.array(rule["licence"])).alias("licences")),
        ).otherwise(state),
        lambda state: F.array_sort(F.array_distinct(state["licences"])),
    )
    return found.select("doc_id", F.filter("ids", lambda i: i != "~").alias("sentence_ids"), matched.alias("licences"))
