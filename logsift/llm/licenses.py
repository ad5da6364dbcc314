"""License scans by template-markup matching.

A template is a license notice with markup: ``<<optional>> ... <</optional>>``
around wording that may be missing, ``<<any n>>`` for up to n replaceable words.
Everything else is mandatory. A template is compiled to a non-deterministic
automaton over words and then to a table (state x word -> state); words outside
all templates share one column. A chunk's words are mapped to columns once, and
all places where a template may begin are advanced together, one table look-up
a step, until every one is accepted or has died. A place is accepted only if
its mandatory wording stands there exactly. Besides short references by name
there are whole notices: a text that changes a condition or the disclaimer of
one does not get its label.

The three base phrases are templates without markup, run in the same way.

Defined cases: null and wordless texts have no place, no label and score 0;
matches never cross texts; overlapping places all count; repeated rows are
scanned one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logsift.llm.common import Sent, Words, chunks, lookup, text_bytes

# Fixed values of the contract: phrase -> label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met <<optional>>1<</optional>> redistributions of source code must retain the above copyright notice this list "
    "of conditions and the following disclaimer <<optional>>2<</optional>> redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution ")
_BSD_ENDORSEMENT = (
    "<<optional>>3<</optional>> neither the name of <<any 4>> nor the names of <<any 1>> contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission ")
_BSD_DISCLAIMER = (
    "this software is provided by <<any 5>> as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any 5>> be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute "
    "goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in "
    "contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if "
    "advised of the possibility of such damage")

# Whole notices, with the regions that may be replaced or left out.
NOTICES = (
    ("mit-notice",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "<<optional>>the software<</optional>> to deal in the software without restriction including without limitation the rights to use "
     "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
     "furnished to do so subject to the following conditions the above copyright notice and this permission notice "
     "<<optional>>including the next paragraph<</optional>> shall be included in all copies or substantial portions of the software the "
     "software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement in no event shall <<any 6>> be liable for any claim damages "
     "or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or "
     "the use or other dealings in the software"),
    ("bsd-2-clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER),
    ("apache-2.0-notice",
     "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may "
     "obtain a copy of the license at <<optional>>http<</optional>> <<optional>>https<</optional>> www apache org licenses license 2.0 "
     "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied see the license for the specific language governing "
     "permissions and limitations under the license"),
    ("gpl-notice",
     "this <<any 1>> is free software you can redistribute it and or modify it under the terms of the gnu <<optional>>lesser<</optional>> "
     "general public license as published by the free software foundation either version <<any 2>> of the license or at your option any "
     "later version this <<any 1>> is distributed in the hope that it will be useful but without any warranty without even the implied "
     "warranty of merchantability or fitness for a particular purpose see the gnu <<optional>>lesser<</optional>> general public license "
     "for more details <<optional>>you should have received a copy of the gnu <<optional>>lesser<</optional>> general public license "
     "along with this <<any 1>> if not see<</optional>>"),
    ("mpl-2.0-notice",
     "this source code form is subject to the terms of the mozilla public license <<optional>>v<</optional>> 2.0 if a copy of the mpl was "
     "not distributed with this file you can obtain one at <<optional>>http<</optional>> <<optional>>https<</optional>> mozilla org mpl 2.0"),
)

# References by name, and the whole notices.
TEMPLATES = (
    ("mit", "<<optional>>this <<any 1>> is<</optional>> <<optional>>released<</optional>> <<optional>>licensed<</optional>> "
            "under <<optional>>the<</optional>> <<optional>>terms of the<</optional>> mit license"),
    ("apache-2.0", "licensed under the apache license <<optional>>version<</optional>> 2.0"),
    ("gpl-2.0", "gnu general public license <<optional>>as published by the free software foundation either<</optional>> "
                "version 2"),
    ("gpl-3.0", "gnu general public license <<optional>>as published by the free software foundation either<</optional>> "
                "version 3"),
    ("lgpl", "gnu lesser general public license <<optional>>as published by the free software foundation either<</optional>> "
             "<<optional>>version <<any 1>><</optional>>"),
    ("mpl-2.0", "<<optional>>this source code form is<</optional>> subject to the terms of the mozilla public license "
                "<<optional>>v<</optional>> 2.0"),
    ("cc-by-nc", "<<optional>>licensed under<</optional>> <<optional>>a<</optional>> <<optional>>creative commons<</optional>> "
                 "cc by nc <<optional>>sa<</optional>> <<optional>>nd<</optional>> <<any 2>>"),
    ("cc-by", "creative commons attribution <<optional>>share alike<</optional>> <<optional>>4.0 international<</optional>> "
              "license"),
    ("spdx", "spdx license identifier <<any 3>>"),
    ("all-rights-reserved", "copyright <<any 24>> all rights reserved"),
    *NOTICES,
)

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_TOKEN = re.compile(r"<<optional>>|<</optional>>|<<any (\d+)>>|[^<\s]+")


@dataclass
class Automaton:
    """``table[state, column]``: the next state, 0 if none; state 1 is the start."""

    label: str
    words: list[str]
    table: np.ndarray
    final: np.ndarray


def parse(template: str) -> list:
    """Nested items: a word, an int (up to so many words), or a list (optional)."""
    stack: list[list] = [[]]
    for m in _TOKEN.finditer(template):
        if m.group() == "<<optional>>":
            stack.append([])
        elif m.group() == "<</optional>>":
            inner = stack.pop()
            if not stack:
                raise ValueError("a region is closed that was not opened")
            stack[-1].append(inner)
        elif m.group(1):
            stack[-1].append(int(m.group(1)))
        else:
            stack[-1].extend(_WORD.findall(m.group().lower()))
    if len(stack) > 1:
        raise ValueError("an optional region is not closed")
    return stack[0]


def compile_template(label: str, template: str) -> Automaton:
    """The deterministic automaton of a template."""
    steps: list[dict] = [{}]  # word (None: any) -> set of states
    skips: list[set] = [set()]

    def fresh() -> int:
        steps.append({})
        skips.append(set())
        return len(steps) - 1

    def build(items: list, at: int) -> int:
        for item in items:
            if isinstance(item, list):
                end = build(item, at)
                after = fresh()
                skips[end].add(after)
                skips[at].add(after)
                at = after
            elif isinstance(item, int):
                after = fresh()
                skips[at].add(after)
                for _ in range(item):
                    nxt = fresh()
                    steps[at].setdefault(None, set()).add(nxt)
                    skips[nxt].add(after)
                    at = nxt
                skips[at].add(after)
                at = after
            else:
                nxt = fresh()
                steps[at].setdefault(item, set()).add(nxt)
                at = nxt
        return at

    end = build(parse(template), 0)
    words = sorted({w for s in steps for w in s if w is not None})

    def closure(states: set) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in skips[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    start = closure({0})
    number, todo, rows = {frozenset(): 0, start: 1}, [start], {}
    while todo:
        states = todo.pop()
        row = []
        for word in (None, *words):
            reached = set()
            for s in states:
                reached |= steps[s].get(None, set())
                if word is not None:
                    reached |= steps[s].get(word, set())
            target = closure(reached)
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows[number[states]] = row
    table = np.zeros((len(number), len(words) + 1), np.int32)
    for state, row in rows.items():
        table[state] = row
    final = np.zeros(len(number), bool)
    for states, k in number.items():
        final[k] = end in states
    return Automaton(label, words, table, final)


class Scanner:
    """All automata over one common alphabet."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.base = [compile_template(label, phrase) for phrase, label in base]
        self.templates = [compile_template(label, text) for label, text in templates]
        every = self.base + self.templates
        words = sorted({w for a in every for w in a.words})
        self.alphabet = pa.array([w.encode() for w in words], pa.large_binary())
        place = {w: k + 1 for k, w in enumerate(words)}
        for a in every:
            # Columns of the common alphabet: 0 and unknown words as "any other word".
            wide = np.repeat(a.table[:, :1], len(words) + 1, axis=1)
            for k, w in enumerate(a.words):
                wide[:, place[w]] = a.table[:, k + 1]
            a.table = wide

    def run(self, automaton: Automaton, column: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, words) of every place; the longest acceptance of each start.
        ``left``: words from each place to the end of its text."""
        at = np.flatnonzero(automaton.table[1, column] > 0)
        state = np.ones(len(at), np.int64)
        length = np.zeros(len(at), np.int64)
        active, step = np.arange(len(at)), 0
        while len(active):
            active = active[left[at[active]] > step]
            state[active] = automaton.table[state[active], column[at[active] + step]]
            active = active[state[active] > 0]
            step += 1
            length[active[automaton.final[state[active]]]] = step
        good = length > 0
        return at[good], length[good]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (share of the words inside a match), n_templates."""
    scanner = Sent(docs.sparkSession, Scanner(templates))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner.value
        for part in chunks(batches, text_col):
            words = Words(*text_bytes(part.column(text_col)))
            n, first = part.num_rows, words.first()
            column = (lookup(words.values, found.alphabet) + 1)[words.code] if len(words.code) else np.zeros(0, np.int64)
            place = np.arange(len(column))
            left = first[1:][words.doc] - place
            edge = np.zeros(len(column) + 1, np.int64)
            n_base, n_templates = np.zeros(n, np.int64), np.zeros(n, np.int64)
            low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base_labels: dict[int, set] = {}
            labels: dict[int, set] = {}
            for k, automaton in enumerate(found.base + found.templates):
                at, length = found.run(automaton, column, left)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                doc = words.doc[at]
                many = np.bincount(doc, minlength=n)
                if k < len(found.base):
                    n_base += many
                    np.minimum.at(low, doc, at - first[doc])
                    np.maximum.at(high, doc, at - first[doc])
                else:
                    n_templates += many
                for d in np.flatnonzero(many).tolist():
                    labels.setdefault(d, set()).add(automaton.label)
                    if k < len(found.base):
                        base_labels.setdefault(d, set()).add(automaton.label)
            covered = np.bincount(words.doc[np.cumsum(edge[:-1]) > 0], minlength=n)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(words.count.astype(np.int64)), pa.array(n_base),
                 pa.array(low, mask=n_base == 0), pa.array(high, mask=n_base == 0),
                 *[pa.array([",".join(sorted(x[d])) if d in x else "" for d in range(n)], pa.string()) for x in (base_labels, labels)],
                 pa.array(covered / np.maximum(words.count, 1)), pa.array(n_templates)],
                names=[id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_templates"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double, n_templates long")
