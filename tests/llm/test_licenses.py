import itertools
import random

import pytest

from logsift.llm import licenses as L
from tests.llm.helpers import LONG, ODD_ROWS, odd_docs, words

PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]


def expansions(items):
    """All wordings of a template; None stands for any word."""
    choices = []
    for item in items:
        if isinstance(item, list):
            choices.append([()] + list(expansions(item)))
        elif isinstance(item, int):
            choices.append([(None,) * k for k in range(item + 1)])
        else:
            choices.append([(item,)])
    return [sum(c, ()) for c in itertools.product(*choices)]


def places(text, templates):
    """(start, label) of every template place, by trying all wordings."""
    w = words(text)
    out = set()
    for label, template in templates:
        for wording in expansions(L.parse(template)):
            n = len(wording)
            for k in range(len(w) - n + 1 if n else 0):
                if all(a is None or a == b for a, b in zip(wording, w[k:k + n])):
                    out.add((k, label, template))
    return out


TEXTS = [
    "Released under the MIT License.", "This software is licensed under the terms of the MIT license", "under mit license",
    "Licensed under the Apache License, Version 2.0.", "licensed under the apache license 2.0 and apache license", "apache license version 3",
    "This work is licensed under the GNU General Public License, version 3.", "gnu general public license as published by version 2",
    "GNU General Public License as published by the Free Software Foundation, either version 2", "Licensed under CC BY-NC 4.0.",
    "cc by nc sa nd x", "creative commons attribution license", "SPDX-License-Identifier: Apache-2.0", "copyright 2020 a b c all rights reserved",
    "copyright 1 2 3 4 5 6 7 all rights reserved", "mit mit license license", "the mit. license general public, license", "mit", "license",
    None, "", LONG + " mit license", "copyright all rights reserved copyright x all rights reserved",
]


def test_against_all_wordings(spark):
    rng = random.Random(5)
    vocabulary = "mit license apache general public gnu version 2 3 0 the under licensed cc by nc sa".split()
    texts = TEXTS + [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    small = [t for t in L.TEMPLATES if len(expansions(L.parse(t[1]))) < 3000]
    assert len(small) == len(L.TEMPLATES)
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in L.scan_licenses(odd_docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        if text is not None and len(text) > 10_000:
            assert got[i].n_base == 1 and got[i].first_word == 60_000 and got[i].base_labels == "mit"
            continue
        base = sorted((k, label) for k, label, _ in places(text, [(b, a) for a, b in PHRASES]))
        found = places(text, L.TEMPLATES)
        r = got[i]
        assert r.n_words == len(words(text)) and r.n_base == len(base)
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({b for _, b in base}))
        assert r.labels == ",".join(sorted({b for _, b in base} | {b for _, b, _ in found}))
        assert r.n_templates == len({(k, t) for k, _, t in found})
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(base or found)


def test_mandatory_wording_must_match_exactly(spark):
    template = [("x", "alpha <<optional>>beta <<optional>>gamma<</optional>><</optional>> <<any 2>> omega")]
    texts = ["alpha omega", "alpha beta omega", "alpha beta gamma omega", "alpha gamma omega", "alpha u v omega", "alpha u v w omega",
             "alpha beta u v omega", "alpha", "omega alpha", "alpha beta gamma u v w omega"]
    got = {r.doc_id: r.labels for r in L.scan_licenses(odd_docs(spark, list(enumerate(texts))), templates=template).collect()}
    assert [got[i] for i in range(len(texts))] == ["x", "x", "x", "x", "x", "", "x", "", "", ""]
    for bad in ("<<optional>> a", "a <</optional>>"):
        with pytest.raises((ValueError, IndexError)):
            L.parse(bad)


def plainest(template):
    """A wording of a template: optional regions left out, one word where any may stand."""
    out = []
    for item in L.parse(template):
        if not isinstance(item, list):
            out += ["someone"] if isinstance(item, int) else [item]
    return out


def test_whole_notices_and_no_changed_ones(spark):
    """Every notice is found; with any mandatory word changed, dropped or doubled it is not."""
    rows, want = [], {}
    for label, template in L.NOTICES:
        w = plainest(template)
        free = {k for k, x in enumerate(w) if x == "someone"}
        rows.append((label, 0, "Copyright (c) 2020 A. B. " + " ".join(w).upper() + ". END"))
        for k in range(len(w)):
            if k not in free:
                rows.append((label, 1, " ".join([*w[:k], "altogether", *w[k + 1:]])))
                rows.append((label, 1, " ".join([*w[:k], *w[k + 1:]])))
                rows.append((label, 1, " ".join([*w[:k], "not", *w[k:]])) if k else (label, 1, " ".join(w[:-1])))
    got = {r.doc_id: r.labels.split(",") for r in L.scan_licenses(odd_docs(spark, [(k, t) for k, (_, _, t) in enumerate(rows)])).collect()}
    for k, (label, changed, text) in enumerate(rows):
        # A neighbour of a replaceable region may be dropped or doubled only where the region takes it up.
        assert (label in got[k]) != bool(changed) or (changed and wording(label, text)), (label, text)
    want = {label for label, _ in L.NOTICES}
    assert want <= {x for k, (_, changed, _) in enumerate(rows) if not changed for x in got[k]}


def wording(label, text):
    """Whether the changed text is still a wording of the template, by its regular expression."""
    import re

    def pattern(items):
        out = ""
        for item in items:
            if isinstance(item, list):
                out += f"(?:{pattern(item)})?"
            elif isinstance(item, int):
                out += rf"(?:\S+ ){{0,{item}}}"
            else:
                out += re.escape(item) + " "
        return out

    return re.search(r"(?:^| )" + pattern(L.parse(dict(L.NOTICES)[label])), text + " ") is not None


def test_longer_copyright_lines(spark):
    texts = ["Copyright (c) 2001, 2004 The Regents of the University of California. All rights reserved.",
             "copyright " + "x " * 24 + "all rights reserved", "copyright " + "x " * 25 + "all rights reserved"]
    got = {r.doc_id: r.labels for r in L.scan_licenses(odd_docs(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(3)] == ["all-rights-reserved", "all-rights-reserved", ""]


def test_odd_rows(spark):
    assert L.scan_licenses(odd_docs(spark)).count() == len(ODD_ROWS)
    assert L.scan_licenses(odd_docs(spark, [])).count() == 0
