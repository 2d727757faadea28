import random
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logloom.llm import html_text, license_scan, line_dedup, quality_classifier, quality_rules, sql, toxicity
from logloom.llm.words import ALNUM, NOT_WHITE, chunks, split_words

from . import brute
from .conftest import prose


def test_words_are_those_of_the_patterns():
    for text in ["", None, "Ab c\x1cd e\x85f \x0b g", "x1-Y_2 \x7f É漢", "a" * 10_000]:
        assert split_words(text, NOT_WHITE, False) == [w.encode() for w in brute.WORD.findall(text or "")]
        assert split_words(text, ALNUM, True) == [w.encode() for w in brute.ALNUM.findall(brute.fold(text))]


def test_grams_stay_inside_a_document_and_chunks_do_not_matter():
    texts = ["a b c", None, "a b", "c a b c", "", "A B C"]
    seen = {}
    for chunk in chunks(pa.array(texts), NOT_WHITE, True):
        at, grams = chunk.grams(3)
        seen |= {(chunk.first + int(chunk.doc_of_word()[i]), int(i)): int(h) for i, h in zip(at, grams)}
    assert [d for d, _ in seen] == [0, 3, 3, 5]
    values = list(seen.values())
    assert values[0] == values[2] == values[3] != values[1]


@pytest.mark.parametrize("ratio,least", [(0.1, 2), (0.5, 1), (0.1, 10)])
def test_boilerplate_lines(documents, ratio, least):
    rows = documents.select("doc_id", "source", "text").orderBy("doc_id").collect()
    expected = brute.without_boilerplate([(r["source"], r["text"]) for r in rows], ratio, least)
    for bound in (100_000, -1):  # by a broadcast, by a shuffle
        got = line_dedup.without_boilerplate(documents, ratio=ratio, least_pages=least, broadcast_rows=bound)
        assert got.columns == documents.columns
        assert [r["text"] for r in got.orderBy("doc_id").collect()] == expected


def test_quality_counts(documents):
    got = {r["doc_id"]: r for r in quality_rules.judge(documents).collect()}
    for row in documents.select("doc_id", "text").collect():
        found = got[row["doc_id"]]
        counts = brute.counts(row["text"])
        assert (found["n_words"], found["word_chars"], found["n_symbols"], found["n_dup_lines"], found["n_repeat_words"]) == counts
        assert found["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert found["kept"] == (not found["base_failed"] and found["quality"] >= 0.5)


def test_expectation_maximisation(spark):
    """Against the same iteration in plain Python; votes that stand against the others are outvoted."""
    rng = random.Random(3)
    votes = []
    for _ in range(400):
        good = rng.random() < 0.8
        votes.append([0 if rng.random() < 0.1 else (1 if (rng.random() < a) == good else -1) for a in (0.95, 0.9, 0.85, 0.9)])
    rows = spark.createDataFrame([(v, 1) for v in votes], "votes array<tinyint>, n long").groupBy("votes").sum("n").withColumnRenamed("sum(n)", "n")
    model = quality_rules.fit(rows, 4, 5)
    prior, good, bad = 0.8, [0.98] * 4, [0.3] * 4

    def posterior(v):
        p, q = prior, 1 - prior
        for x, g, b in zip(v, good, bad):
            p, q = p * {1: g, -1: 1 - g, 0: 1}[x], q * {1: 1 - b, -1: b, 0: 1}[x]
        return p / (p + q)

    for _ in range(5):
        ps = [posterior(v) for v in votes]
        rate = lambda hits, n, belief: min(max((hits + 5 * belief) / (n + 5), 0.05), 0.995)
        good = [rate(sum(p for p, v in zip(ps, votes) if v[k] == 1), sum(p for p, v in zip(ps, votes) if v[k]), 0.98) for k in range(4)]
        bad = [rate(sum(1 - p for p, v in zip(ps, votes) if v[k] == -1), sum(1 - p for p, v in zip(ps, votes) if v[k]), 0.3) for k in range(4)]
        prior = min(max((sum(ps) + 1) / (len(votes) + 2), 0.01), 0.99)
    assert abs(model.prior - prior) < 1e-9
    assert np.allclose(model.right_good, good) and np.allclose(model.right_bad, bad)
    scored = spark.createDataFrame([(v,) for v in votes[:20]], "votes array<tinyint>").select("votes", model.posterior().alias("p")).collect()
    assert np.allclose([r["p"] for r in scored], [posterior(v) for v in votes[:20]])


LICENCES = [
    ("Intro.\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("licensed UNDER the apache license version 2.0", ["Apache-2.0"]),
    ("Not licensed under the Apache License, Version 2.0 at all", []),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', ["Apache-2.0"]),
    ("Released under the MIT License.\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "MIT"]),
    (license_scan.SENTENCES["bsd-redistribution"] + "\n" + license_scan.SENTENCES["bsd-source"] + ".\n" + license_scan.SENTENCES["bsd-binary"] + ".", ["BSD-2-Clause"]),
    (license_scan.SENTENCES["bsd-redistribution"] + "\n" + license_scan.SENTENCES["bsd-source"] + ". Other words. " + license_scan.SENTENCES["bsd-binary"] + ".", []),
    (None, []), ("", []), ("licence", []), ("...", []),
]


def test_licences(spark):
    rows = [(i, text, "x") for i, (text, _) in enumerate(LICENCES)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, licences string")).orderBy("doc_id").collect()
    assert [r["licences"] for r in got] == [expected for _, expected in LICENCES]


MIT = """MIT License

Copyright (c) 2020 A. Uthor

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
BSD = """Copyright (c) 2020, A. Uthor
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
BSD_3 = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n'
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law
"""
CC0 = "To the extent possible under law, the author has\nwaived all copyright and related or neighboring rights\nto this work."
BSD_IDS = ["bsd-redistribution", "bsd-source", "bsd-binary"]
PUBLISHED = [
    (MIT, ["mit-title", "mit-grant", "mit-notice"], ["MIT"]),
    (BSD + AS_IS, BSD_IDS, ["BSD-2-Clause"]),
    (BSD + BSD_3 + AS_IS, [*BSD_IDS, "bsd-endorse"], ["BSD-3-Clause"]),
    (GPL, ["gpl-free", "gpl-no-warranty"], ["GPL-3.0-or-later"]),
    (APACHE, ["apache-2-licensed-notice", "apache-2-compliance", "apache-2-copy"], ["Apache-2.0"]),
    (CC0, ["cc0-dedicated"], ["CC0-1.0"]),
    ("Licensed under the\n\nMIT License, they say", [], []),
    ("Licensed under the MIT License\nCopyright 2020 A. Uthor", ["mit-licensed"], ["MIT"]),
]


def test_licences_as_published(spark):
    """Wrapped, as comments, with other markers, on one line, with other line ends; the sentences' order stays."""
    forms = [
        lambda text: text,
        lambda text: "Some words.\n\n" + "".join(f" * {line}\n" for line in text.splitlines()) + "\nMore words",
        lambda text: text.replace("1. R", "(a) R").replace("2. R", "(b) R").replace("3. N", "c) N"),
        lambda text: text.replace("1. R", "* R").replace("2. R", "- R").replace("3. N", "\u2022 N"),
        lambda text: text.replace("\n", "\r\n"),
    ]
    rows = [(i, form(text), k) for i, form in enumerate(forms) for k, (text, _, _) in enumerate(PUBLISHED)]
    rows += [(9, " ".join(PUBLISHED[k][0].split()), k) for k in (1, 2, 3)]
    got = license_scan.scan(spark.createDataFrame([(f"{i} {k}", text) for i, text, k in rows], "doc_id string, text string")).collect()
    assert {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in got} == {f"{i} {k}": PUBLISHED[k][1:] for i, _, k in rows}


GPL_2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY.
"""
ISC = """ISC License

Copyright (c) 2020, A. Uthor

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
APACHE_HEAD = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.
"""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at

https://www.eclipse.org/legal/epl-2.0/
"""
MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
UNLICENSE = "This is free and unencumbered software released into the\npublic domain.\n"
MORE = [
    (GPL_2, ["gpl-2.0-or-later-program", "gpl-no-warranty"], ["GPL-2.0-or-later"]),
    (GPL_2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1"), ["lgpl-2.1-or-later-library", "library-no-warranty"], ["LGPL-2.1-or-later"]),
    (GPL_2.replace("software;", "software:").replace("Foundation;", "Foundation,").replace("General", "Affero General").replace("version 2", "version 3"), ["agpl-3.0-or-later-program", "gpl-no-warranty"], ["AGPL-3.0-or-later"]),
    (ISC, ["isc-name", "isc-grant", "isc-as-is"], ["ISC"]),
    (MPL, ["mpl-2-form"], ["MPL-2.0"]),
    (APACHE_HEAD, ["apache-2-title"], ["Apache-2.0"]),
    (EPL, ["epl-2-terms"], ["EPL-2.0"]),
    (MIT.split("THE SOFTWARE IS")[0] + MIT_END, ["mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"], ["MIT"]),
    (MIT_END, ["mit-as-is", "mit-liability"], []),
    (UNLICENSE, ["unlicense-released"], ["Unlicense"]),
    ("This project is licensed\nunder the MIT License - see LICENSE", [], []),
    ("This project is licensed under the MIT License.\nSee LICENSE.", ["this-project-is-licensed-under-the-mit-license"], ["MIT"]),
    ("This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License.", ["cc-by-nc-sa-4.0-this-a"], ["CC-BY-NC-SA-4.0"]),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", ["0bsd-grant"], ["0BSD"]),
]
WRAPPED = [
    lambda text: text,
    lambda text: "Some words.\n\n" + "".join(f" * {line}\n" for line in text.splitlines()) + "\nMore words",
    lambda text: text.replace("\n", "\r\n"),
]


def test_more_licences_as_published(spark):
    rows = [(f"{i} {k}", form(text)) for i, form in enumerate(WRAPPED) for k, (text, _, _) in enumerate(MORE)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in got} == {i: MORE[int(i.split()[1])][1:] for i, _ in rows}


def test_sql_has_the_boundaries_of_the_code(spark):
    """Wrapped texts, list markers and odd joints of them, addresses after blank lines."""
    texts = [form(text) for form in WRAPPED for text, _, _ in [*PUBLISHED, *MORE]] + [text for text, _ in LICENCES]
    parts = ["Licensed under the MIT License", "Released under the MIT License", "ISC License", "MIT", "x", "1.", "(a)", "iv)", "2)", "\n", "\n\n", "\n \n", ". ", "; ", ": ", " ", "E", "L", "http://a.b/c", "\u2028", "é", "?!", "\n" * 90]
    rng = random.Random(7)
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(2, 14))) for _ in range(1500)]
    texts += [" ".join(rng.sample(texts[:50], 3)) for _ in range(50)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_scan.scan(rows).select("doc_id", F.array_join("sentence_ids", ","), F.array_join("licences", ",")).collect()
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())}))
    expected = connection.sql(sql.license_scan_sql()).fetchall()
    assert sum(1 for row in expected if row[2]) > 200
    assert sorted(map(tuple, got)) == sorted(expected)


def test_marks_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    rng = random.Random(3)
    words = prose(9, 60, 60)
    rows = [(" ".join(rng.choices(words, k=12) + [f"{rng.choice(words)} grobian {rng.choice(words)}"] * (k % 3 == 0)), int(k % 3 == 0)) for k in range(90)]
    sample = spark.createDataFrame(rows, "text string, label int").repartition(2)
    found = []
    for at_once in (10**9, 1):
        monkeypatch.setattr(toxicity, "CONTEXTS_AT_ONCE", at_once)
        found.append(toxicity.marking_units(sample))
    assert found[0] == found[1] and "grobian" in found[0][0]


def test_own_sentences(spark):
    rows = [(1, "Intro.\nFree for all\nuses. Even at night."), (2, "free for all"), (3, None)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"free": "Free for all uses. Even at night"}, [("Own", ["free"])])
    assert [r["licences"] for r in got.orderBy("doc_id").collect()] == [["Own"], [], []]


def test_scan_of_all_kinds_of_texts(documents, no_documents):
    assert license_scan.scan(documents).where("size(licences) > 0").count() == 1
    assert license_scan.scan(no_documents).count() == 0
    assert line_dedup.without_boilerplate(no_documents).count() == 0
    assert quality_rules.judge(no_documents).count() == 0


PAGES = [
    ("<article><h1>A &amp; B</h1><p>One  two\nthree<p>Four<br>five</article><footer>no</footer>", "A & B\n\nOne two three\n\nFour five"),
    ("<nav><a href='x'>menu</a></nav><article><p>Text<div class='ad'>buy</div><p>more</p><section class=\"comments\"><p>reader</p></section></article>", "Text\n\nmore"),
    ("<body><div id=cookie-notice>We use cookies on this page</div><div><p>" + "The story goes on for a while here. " * 4 + "<p>Short.</div><form>name <input></form></body>",
     ("The story goes on for a while here. " * 4).strip() + "\n\nShort."),
    ("<script>var t='</p>'</script><style>p{}</style><!-- <p>no</p> --><p>only", "only"),
    ("plain", "plain"), (None, ""), ("", ""), ("<p></p>", ""), ("<", "<"), ("<p>caf&eacute; &#x6f22;&nbsp;x</p>", "café 漢 x"),
]


def test_main_text(spark):
    rows = [(i if i else None, f"http://h/{i}", page, "x", 1) for i, (page, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = {r["url"]: r for r in html_text.extract(pages).collect()}
    for i, (_, expected) in enumerate(PAGES):
        found = got[f"http://h/{i}"]
        assert found["text"] == expected and found["n_chars"] == len(expected) and found["page_id"] == (i or None)
    assert html_text.extract(pages.limit(0)).count() == 0


STORY = "The story goes on for a while here. " * 6
NOT_ASIDE = [
    ('<div class="content has-sidebar"><article><p>Story</article></div>', "Story"),
    ('<article><pre>x = 1 <span class="hljs-comment"># note</span></pre><span class="comment">y</span></article>', "x = 1 # note\n\ny"),
    ('<article><div class="post-header">A</div><div class="related-work">B</div><div class="widget-area">C</div></article>', "A\n\nB\n\nC"),
    ('<div class="widget"><article><p>Story</article></div>', "Story"),
    (f'<div class="header"><p>{STORY}</div><div class="ad">buy</div>', STORY.strip()),
    (f'<form id="page"><p>{STORY}</form>', STORY.strip()),
    (f'<p>{STORY}<div class="comments"><p>{STORY}<p>{STORY}</div>', STORY.strip()),
    (f'<p class="notice">Cookies<div>{STORY}</div>', STORY.strip()),
    ("<head><title>t</title><body><p>Story", "Story"),
    ('<article><table><tr><td class="ad">buy<div>now<td>Story</table></article>', "Story"),
    ("<article><figure><figcaption>Figure 1</figcaption></figure><svg><text>a</text><text>b</text></svg> c<noscript>d</noscript><p>so <math><mi>x</mi><mo>=</mo></math>y</article>",
     "Figure 1\n\na b c\n\nd\n\nso x=y"),
    ('<article class="post comments-open"><p>Story</article>', "Story"),
    (f'<main><p>{STORY}</p></main><div class="related"><article>teaser</article></div>', STORY.strip()),
]


@pytest.mark.parametrize("page,expected", NOT_ASIDE)
def test_what_is_set_aside(page, expected):
    assert html_text.main_text(page) == expected


LINK = "<p><a href=x>link</a>"
WHOLE = [
    (f"<div><p>{STORY}<p>{STORY}</div><article>teaser</article>", f"{STORY.strip()}\n\n{STORY.strip()}\n\nteaser"),
    (f"<article><p>{STORY}{LINK * 3}</article>", "\n\n".join([STORY.strip()] + ["link"] * 3)),
    (f"<article>{LINK * 4}<p>{STORY}{LINK * 4}<p>End.</article><p>out", "\n\n".join(["link"] * 4 + [STORY.strip()] + ["link"] * 4 + ["End."])),
    (f"<article>{LINK}</article>", "link"),
    (f"<p>{STORY}<div class=ad><p>a<p>b<p>c</div><p>End.", f"{STORY.strip()}\n\nEnd."),
    (f"<p>Start.{LINK * 3}<p>{STORY}{LINK * 3}<p>End.", "\n\n".join(["Start."] + ["link"] * 3 + [STORY.strip()] + ["link"] * 3 + ["End."])),
    (f"<p>Site{LINK * 9}<h1>T</h1><p>{STORY}{LINK * 9}<p>Imprint", "\n\n".join(["link"] * 2 + ["T", STORY.strip()])),
]


@pytest.mark.parametrize("page,expected", WHOLE)
def test_main_text_is_whole(page, expected):
    assert html_text.main_text(page) == expected


def test_long_page_takes_linear_time():
    page = "<div>" * 2_000 + "<p>word word word</p>" * 40_000
    assert html_text.main_text(page).count("word") == 120_000


@pytest.mark.parametrize(
    "page", ["<a " * 100_000, "</p <" * 100_000, '<a ">"' * 100_000, '<div class="' * 100_000, "<div " + "a" * 300_000 + ">", "<!" * 100_000, "<!--" * 100_000, "<p>" * 50_000, "<li><div>" * 20_000, "<div ='" * 100_000 + ">"]
)
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text("<p>before</p>" + page)
    assert time.process_time() - began < 2


@pytest.mark.parametrize(
    "page,expected",
    [
        ("<p>one</p> tail <a href", "one\n\ntail <a href"),
        ("<p>one <b x='y>two</b> three</p>", "one two three"),
        ("<p>one</p><p>5 <a\" or so</p><p>six</p>", "one\n\n5 <a\" or so\n\nsix"),
        ("<p>one</p>end <x <!-- never closed", "one\n\nend <x"),
        ('<p title="a > b">one</p>', "one"),
    ],
)
def test_unclosed_markup(page, expected):
    assert html_text.main_text(page) == expected


def test_isotonic():
    assert quality_classifier.isotonic(np.array([1.0, 3.0, 2.0, 4.0]), np.ones(4)).tolist() == [1, 2.5, 2.5, 4]
    assert quality_classifier.isotonic(np.array([3.0, 1.0]), np.array([1.0, 3.0])).tolist() == [1.5, 1.5]


def junk_and_prose(spark, n=240):
    rows = [(i, " ".join(prose(i, 40 + i % 50)) if i % 3 else " ".join(w + "%%%" for w in prose(i, 60)), int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_quality_classifier_learns(spark, documents, no_documents):
    rows = junk_and_prose(spark)
    got = quality_classifier.classify(rows, rows.where("doc_id % 4 > 0").select("doc_id", "label")).join(rows, "doc_id").collect()
    assert all((r["score"] >= 0.3) == bool(r["label"]) for r in got if r["doc_id"] % 4 == 0)
    scores = quality_classifier.classify(documents, rows.select("doc_id", "label")).collect()
    assert len(scores) == documents.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert {r["score"] for r in quality_classifier.classify(documents, rows.limit(0).select("doc_id", "label")).collect()} == {0.495}
    assert quality_classifier.classify(no_documents, rows.select("doc_id", "label")).count() == 0


def test_kernel_is_that_of_gapped_subsequences():
    """Against enumeration, and closer for an insult with a letter more than for another word."""

    def subsequences(word):
        return [(word[i] + word[j] + word[k], toxicity.DECAY ** (k - i + 1)) for i in range(len(word)) for j in range(i + 1, len(word)) for k in range(j + 1, min(len(word), i + toxicity.SPAN))]

    def kernel(a, b):
        one, two = subsequences(a), subsequences(b)
        norm = np.sqrt(sum(w * w for _, w in one) * sum(w * w for _, w in two))
        return sum(x * y for s, x in one for t, y in two if s == t) / norm

    words = ["idiot", "idxiot", "idioot", "table", "trash"]
    got = toxicity.features(words, toxicity.landmark_table(["idiot", "trash"]))
    assert np.allclose(got, [[kernel(a, b) for b in ("idiot", "trash")] for a in words], atol=1e-6)
    assert got[1, 0] > 0.4 and got[2, 0] > 0.6 and got[3, 0] < 0.2


def test_units():
    assert toxicity.units_of("You i.d.i.o.t, i d i o t! An id-iot") == ["you", "idiot", "idiot", "an", "idiot"]
    assert toxicity.units_of("") == [] and all(len(u) <= toxicity.LONGEST_UNIT for u in toxicity.units_of("ab" * 500))


def insults(spark, n=600):
    rng, rows = random.Random(5), []
    for i in range(n):
        words = prose(1000 + i, 60)
        toxic = i % 3 == 0
        for _ in range(2 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(["blockhead", "nitwit", "dimwit"])
        rows.append((i, " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words)), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_toxicity_learns_and_tolerates_inserted_letters(spark, documents, no_documents):
    rows = insults(spark)
    labels = rows.where("doc_id % 4 > 0").select("doc_id", "label")
    got = toxicity.classify(rows, labels).join(rows, "doc_id").collect()
    held = [r for r in got if r["doc_id"] % 4 == 0]
    assert sum((r["score"] >= 0.5) == bool(r["label"]) for r in held) >= 0.95 * len(held)
    model = toxicity.fit(rows, labels)
    margins = dict(zip(("nitwit", "nitwiit", "blockhhead", "window"), model.margins(["nitwit", "nitwiit", "blockhhead", "window"])))
    assert min(margins["nitwiit"], margins["blockhhead"]) > 0 > margins["window"]
    kept = toxicity.without_toxic(rows.withColumnRenamed("label", "score"), labels)
    assert kept.columns == ["doc_id", "text", "score"] and 0.9 * 400 <= kept.count() <= 1.1 * 400
    scores = toxicity.classify(documents, labels).collect()
    assert len(scores) == documents.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert {r["score"] for r in toxicity.classify(documents, labels.where("label = 1")).collect()} == {0.0}
    assert toxicity.classify(no_documents, labels).count() == 0


def test_sentences_of_clean_documents_are_counted_by_the_named_numbers(spark, monkeypatch):
    rows = spark.createDataFrame([(" ".join(f"word{chr(97 + i)}{chr(97 + k)} here." for i in range(20) for k in range(5)), 0)], "text string, label int")
    assert toxicity.labelled_sentences(rows, {})[2].sum() == toxicity.MARKED_SENTENCES + toxicity.OTHER_SENTENCES == 10
    monkeypatch.setattr(toxicity, "MARKED_SENTENCES", 3)
    monkeypatch.setattr(toxicity, "OTHER_STRIDE", 60)
    assert toxicity.labelled_sentences(rows, {})[2].sum() == 3 + 2


def test_length_does_not_hide_insults(spark):
    rows, words = [], [w for w in dict.fromkeys(prose(40, 60_000, 4_000)) if len(w) > 2]
    rng = random.Random(41)
    for i in range(300):
        text = rng.sample(words, rng.choice((20, 200, 1500)))
        if i % 3 == 0:
            for insult in rng.sample(["idiot", "moron", "loser", "scumbag", "clown"], 3):
                text[rng.randrange(len(text))] = insult
        rows.append((i, " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(text)), int(i % 3 == 0)))
    documents = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(documents, documents.select("doc_id", "label"))
    for n in (20, 200, 2_300):
        clean = rng.sample(words, n)
        toxic = clean[:10] + ["idiot"] + clean[10:15] + ["moron", "loser"] + clean[15:]
        assert model.scores([" ".join(toxic)])[0] >= 0.5 > model.scores([" ".join(clean)])[0]


def test_share_of_labels_sets_the_constant():
    """A sample with as many of both kinds gives what the labels in full would."""
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(4_000, 1)), np.repeat([1.0, 0.0], [400, 3_600])
    x[:400] += 1.5
    even = np.concatenate([np.arange(400), 400 + np.arange(400)])
    full, weighed = toxicity._logistic(x, y, 0.1), toxicity._logistic(x[even], y[even], 0.1)
    assert np.abs(full - weighed).max() < 0.35 < np.abs(full - toxicity._logistic(x[even], y[even], 0.5)).max()
