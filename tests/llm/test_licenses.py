import re

import pytest

from tonality.llm import licenses as L

from .helpers import docs_of, edge_docs, empty_docs

TEXTS = [
    "Released under the MIT License.",
    "mit-license MIT\nLICENSE; the mit license (mit license)",
    "GNU General Public License and Apache  License, Version 2.0",
    "xmit license mit licenses general public  licence",
    "SPDX-License-Identifier: MIT OR GPL-3.0-only\ncode",
    "// SPDX-License-Identifier: (Apache-2.0 AND BSD-3-Clause) */",
    "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0",
    "SPDX-License-Identifier: MIT AND",
    "Ünder the MIT License, mit license",
    "mit license mit license",
]


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}.items():
        p = phrase.split()
        hit = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += hit
        labels |= {label} if hit else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = L.scan_licenses(docs_of(spark, rows)).collect()
    expected = sorted(((d, *brute(t)) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == expected
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    by = {r.doc_id: r for r in got}
    assert (by[104].labels, by[104].score, by[104].permission) == ("gpl,mit", 1.0, 1.0)
    assert (by[105].labels, by[105].permission) == ("apache,bsd", 1.0)
    assert (by[106].labels, by[106].permission) == ("gpl", 0.6)
    assert by[107].bad_expressions == ["MIT AND"] and by[107].score == 0
    assert L.scan_licenses(empty_docs(spark)).count() == 0


@pytest.mark.parametrize(
    "expression, labels, permission",
    [
        ("MIT", {"mit"}, 1.0),
        ("GPL-2.0-or-later", {"gpl"}, 0.3),
        ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 0.3),
        ("GPL-3.0 OR MIT AND CC-BY-NC-4.0", {"gpl", "mit", "cc-by-nc"}, 0.3),
        ("(GPL-3.0 OR MIT) AND CC-BY-NC-4.0", {"gpl", "mit", "cc-by-nc"}, 0.1),
        ("AGPL-3.0 with Some-exception or LGPL-2.1+", {"agpl", "lgpl"}, 0.6),
        ("LicenseRef-x", {"licenseref-x"}, 0.5),
    ],
)
def test_expressions(expression, labels, permission):
    assert L.evaluate(expression) == (frozenset(labels), permission)


@pytest.mark.parametrize("expression", ["", "AND", "MIT OR", "(MIT", "MIT)", "MIT GPL-3.0", "MIT WITH", "(MIT) (MIT)", "MIT WITH (X)", "?"])
def test_malformed_expressions(expression):
    assert L.evaluate(expression) is None


@pytest.mark.parametrize(
    "text, labels, permission, bad",
    [
        ("<!-- SPDX-License-Identifier: MIT -->", "mit", 1.0, []),
        ("<!--SPDX-License-Identifier: MIT-->", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT Copyright 2020 Someone", "mit", 1.0, []),
        ('{"SPDX-License-Identifier": "GPL-3.0-only OR MIT", "x": 1}', "gpl,mit", 1.0, []),
        ("(see 'SPDX-License-Identifier: (MIT OR ISC)')", "isc,mit", 1.0, []),
        ("a SPDX-License-Identifier: MIT. b SPDX-License-Identifier: GPL-2.0 */ c", "gpl,mit", 0.3, []),
        ("SPDX-License-Identifier: MIT OR -->", "", None, ["MIT OR -->"]),
        ("SPDX-License-Identifier: (MIT x", "", None, ["(MIT x"]),
        ("SPDX-License-Identifier: MIT and more text follows", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT or later versions apply", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT and (see below)", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT with care", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT and", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT And ISC", "mit", 1.0, []),
        ("SPDX-License-Identifier: MIT or isc or so", "isc,mit", 1.0, []),
        ("SPDX-License-Identifier: see below", "", None, ["see"]),
        ("SPDX-License-Identifier: MIT OR Foo-1.0 x", "", None, ["MIT OR Foo-1.0"]),
        ("SPDX-License-Identifier: gpl-2.0 WITH care", "", None, ["gpl-2.0 WITH care"]),
    ],
)
def test_tags_with_something_after_the_expression(text, labels, permission, bad):
    row = L.scan(text, L.build_automaton(), L.word_table())
    assert (row["labels"], row["permission"], row["bad_expressions"]) == (labels, permission, bad)
    assert row["score"] == (0.0 if bad else 1.0)


@pytest.mark.parametrize("text", ["SPDX-License-Identifier: NOASSERTION", "SPDX-License-Identifier: NONE", "License: MIT"])
def test_no_licence_is_stated(text):
    row = L.scan(text, L.build_automaton(), L.word_table())
    assert (row["labels"], row["score"], row["permission"], row["bad_expressions"]) == ("", 0.0, None, [])


def test_known_ids():
    known = "MIT ISC 0BSD GPL-2.0 GPL-3.0-or-later LGPL-2.1+ BSD-3-Clause BSD-2-Clause-Patent Apache-2.0 CC-BY-NC-SA-4.0 CC0-1.0 MPL-2.0 "
    known += "LicenseRef-own DocumentRef-a:LicenseRef-b Zlib MIT-0 EUPL-1.2 Python-2.0 PHP-3.01"
    assert all(map(L.is_licence, known.split()))
    assert not any(map(L.is_licence, "more see later GPL BSD Apache mit-or-so 2.0 licenseref- unknown-1.0".split()))
