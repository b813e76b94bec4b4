"""License scans: template markup compiled into automata over words.

A template is mandatory wording with marked regions: `<<opt>>...<</opt>>` may be absent
(regions may nest), `<<var;max=N>>` stands for any 0 to N words. A text has the label of a
template if its words, from some place on, run the automaton of the template to its end:
the mandatory words must all be there, in order and unchanged. Templates start with at least
two mandatory words, by which their places are found; the automaton runs only there.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from articlemill.llm.common import bytes_of, extended, pieces
from articlemill.llm.plain_words import plain_words

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label and template. Several templates may have one label.
TEMPLATES = [
    ("apache-2.0", "apache license <<opt>>version<</opt>> 2 0"),
    ("apache-2.0", """you may not use <<opt>>this<</opt>> <<var;max=2>> except in compliance with the
        <<opt>>apache<</opt>> license"""),
    ("gpl-2.0", """gnu general public license <<opt>>as published by the free software foundation<</opt>>
        <<opt>>either<</opt>> <<opt>>version<</opt>> <<opt>>v<</opt>> 2"""),
    ("gpl-3.0", """gnu general public license <<opt>>as published by the free software foundation<</opt>>
        <<opt>>either<</opt>> <<opt>>version<</opt>> <<opt>>v<</opt>> 3"""),
    ("gpl-or-later", """gnu general public license <<var;max=12>> or <<opt>>at your option<</opt>> any later version"""),
    ("apache-2.0", "apache license v2"),
    ("gpl-2.0", "gnu general public license <<opt>>version<</opt>> v2"),
    ("gpl-3.0", "gnu general public license <<opt>>version<</opt>> v3"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("mit-reference", "released under the mit license"),
    ("mit-grant", """permission is hereby granted free of charge to any person obtaining a copy of
        <<opt>>this software and associated documentation files<</opt>> <<var;max=4>> to deal in
        <<var;max=3>> without restriction"""),
    ("bsd", """redistribution and use in source and binary forms with or without modification
        <<opt>>are permitted<</opt>> provided that the following conditions are met"""),
    ("isc", """permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose
        with or without fee is hereby granted"""),
    ("all-rights-reserved", "copyright c <<var;max=8>> all rights reserved"),
]

BSD_START = """redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met <<var;max=1>> redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer <<var;max=1>> redistributions in binary form must reproduce the above copyright notice this
    list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution """
BSD_NAMES = """<<var;max=1>> neither the name of <<var;max=12>> nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission """
BSD_END = """this software is provided by <<var;max=12>> as is and any express or implied warranties including but not limited to the
    implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var;max=12>> be liable for
    any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute
    goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in
    contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if
    advised of the possibility of such damage"""

#: Whole notices, conditions and disclaimers included, with their names of holders and numbers of clauses left open.
NOTICES = [
    ("mit-notice", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to use copy
        modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice
        <<opt>>including the next paragraph<</opt>> shall be included in all copies or substantial portions of the software the software
        is provided as is without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall <<var;max=12>> be liable for any claim
        damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the
        software or the use or other dealings in the software"""),
    ("isc-notice", """permission to use copy modify and <<opt>>or<</opt>> distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided
        as is and <<var;max=6>> all warranties with regard to this software including all implied warranties of merchantability and
        fitness in no event shall <<var;max=12>> be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
        arising out of or in connection with the use or performance of this software"""),
    ("bsd-2-notice", BSD_START + BSD_END),
    ("bsd-3-notice", BSD_START + BSD_NAMES + BSD_END),
    ("apache-2.0-notice", """licensed under the apache license version 2 0 the license you may not use this file except in compliance
        with the license you may obtain a copy of the license at <<var;max=1>> www apache org licenses license 2 0 <<opt>>txt<</opt>>
        unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is
        basis without warranties or conditions of any kind either express or implied see the license for the specific language governing
        permissions and limitations under the license"""),
    ("gpl-notice", """this program is free software you can redistribute it and or modify it under the terms of the gnu general public
        license as published by the free software foundation either version <<var;max=1>> of the license or at your option any later
        version this program is distributed in the hope that it will be useful but without any warranty without even the implied
        warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"""),
]
TEMPLATES += NOTICES

MARK = re.compile(r"<<(opt)>>|<<(/opt)>>|<<var;max=(\d+)>>|([^<]+)")


@dataclass(frozen=True)
class Automaton:
    """States 0 to n. `words[s]` is the word that leads from s to s + 1, or None for any word.

    `free[s]` are the states reached from s without a word, s itself among them.
    """

    label: str
    anchor: bytes  #: the mandatory words at the start, each with a blank on both sides
    words: tuple[bytes | None, ...]
    free: tuple[frozenset[int], ...]

    def accepts(self, words: list[bytes], begin: int) -> bool:
        """True if a run over the words from `begin` on reaches the last state."""
        states, last = self.free[0], len(self.words)
        while states:
            if last in states:
                return True
            if begin == len(words):
                return False
            word = words[begin]
            states = frozenset(t for s in states if s < last and self.words[s] in (None, word) for t in self.free[s + 1])
            begin += 1
        return False


def compile_template(label: str, template: str) -> Automaton:
    words: list[bytes | None] = []
    skips: list[tuple[int, int]] = []
    open_regions: list[int] = []
    start = 0
    for opens, closes, longest, literal in MARK.findall(template):
        if literal:
            if not open_regions and not skips:
                start = len(words) + len(plain_words(literal.encode()))
            words += plain_words(literal.encode())
        elif opens:
            open_regions.append(len(words))
        elif closes:
            skips.append((open_regions.pop(), len(words)))
        else:
            at = len(words)
            words += [None] * int(longest)
            skips += [(i, len(words)) for i in range(at, len(words))]
        if (opens or longest) and not start:
            raise ValueError(f"starts with no mandatory words: {template!r}")
    if open_regions or start < 2:
        raise ValueError(f"not a template: {template!r}")
    free = [{s} for s in range(len(words) + 1)]
    for s in reversed(range(len(words) + 1)):
        for begin, end in skips:
            if begin == s:
                free[s] |= free[end]
    return Automaton(label, b" " + b" ".join(words[:start]) + b" ", tuple(words), tuple(map(frozenset, free)))


@functools.lru_cache(maxsize=8)
def automata(templates: tuple[tuple[str, str], ...]) -> tuple[Automaton, ...]:
    return tuple(compile_template(label, template) for label, template in templates)


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers where a phrase (with blanks around) stands in words joined by blanks (and around)."""
    found, seen, words = [], 0, 0
    at = joined.find(phrase)
    while at >= 0:
        words += joined.count(b" ", seen, at)
        seen = at
        found.append(words)
        at = joined.find(phrase, at + 1)
    return found


@dataclass(frozen=True)
class Scan:
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: list[str]
    labels: list[str]
    score: float


def scan_text(text: bytes | None, phrases: dict[str, str], templates: tuple[tuple[str, str], ...]) -> Scan:
    words = plain_words(text)
    joined = b" " + b" ".join(words) + b" "
    base: dict[str, list[int]] = {}
    for phrase, label in phrases.items():
        if at := places(joined, b" " + phrase.encode() + b" "):
            base[label] = sorted(base.get(label, []) + at)
    accepted = set()
    for automaton in automata(templates):
        if automaton.label not in accepted and any(automaton.accepts(words, at) for at in places(joined, automaton.anchor)):
            accepted.add(automaton.label)
    all_places = sorted(p for at in base.values() for p in at)
    first, last = (all_places[0], all_places[-1]) if all_places else (None, None)
    score = 1.0 if accepted else 0.5 if base else 0.0
    return Scan(len(words), len(all_places), first, last, sorted(base), sorted({*base, *accepted}), score)


def with_licenses(
    df: DataFrame, text: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES
) -> DataFrame:
    """The columns but `text`, with what the scan of each whole text finds. One scan, no shuffle.

    `n_base` counts the places of all phrases, `first_word` and `last_word` are their smallest and
    largest start; labels are sorted and joined by commas. `score` is 1 where a template is accepted, 0.5 where
    only a phrase stands, else 0. A null text counts as empty; columns of these names are replaced.
    """
    added = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    names = [part.split()[0] for part in added.split(", ")]
    kept = [c for c in df.columns if c != text and c not in names]
    rows = df.select(*[f"`{c}`" for c in kept], f"`{text}`")
    fixed = tuple(map(tuple, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found = [scan_text(t, phrases, fixed) for t in bytes_of(piece, text)]
            columns = [pa.array([getattr(s, n) for s in found], pa.int64()) for n in names[:4]]
            columns += [pa.array([",".join(getattr(s, n)) for s in found], pa.string()) for n in names[4:6]]
            columns.append(pa.array([s.score for s in found], pa.float64()))
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *columns], [*kept, *names])

    return rows.mapInArrow(run, extended(rows.drop(text), added))
