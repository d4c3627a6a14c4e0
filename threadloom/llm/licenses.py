"""License scans: base phrases, and templates with optional and replaceable regions compiled into token automata.

A template is a line of words with two kinds of markup: [..] holds optional words, and {n} stands for up to n words of
any kind. It is compiled into an automaton over words; a text is accepted where the automaton reaches its end, so all
mandatory words must stand there in order, with nothing between them but what the markup allows. A text may
hold any number of licenses; each accepted template gives its label.

Words are runs of ASCII letters and digits and of any characters beyond ASCII, A-Z in lower case. Defined results: null
and empty texts have no word, no place and no label, and a score of 0; rows are judged one by one, so repeated rows get
equal results and an empty table an empty one; other columns are not read; texts are used whole, whatever their length.
The score is 1 with an accepted template, otherwise 0.5 with a base phrase, otherwise 0.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame

from threadloom.llm.common import map_rows

BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# The mandatory wording of public license notices, and the whole texts of the MIT, BSD and ISC licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license [,] version 2 0"),
    ("gpl-3.0", "licensed under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 3"),
    ("gpl-2.0", "licensed under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 2"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl-notice", "under the terms of the gnu lesser general public license {6} as published by the free software foundation"),
    ("lgpl-notice", "under the terms of the gnu library general public license {6} as published by the free software foundation"),
    ("mit-notice", "[is] released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [the software] to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
        "[including the next paragraph] shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {8} "
        "be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software "
        "or the use or other dealings in the software",
    ),
    (
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "[1] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "[2] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or "
        "other materials provided with the distribution [3] [neither the name of {12} nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission] this software is provided by {10} as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {10} be liable "
        "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services "
        "loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
        "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc-text",
        "permission to use copy modify {2} distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and "
        "this permission notice appear in all copies the software is provided as is and {6} disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall {6} be liable for any special direct indirect or consequential damages or any damages whatsoever "
        "resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use "
        "or performance of this software",
    ),
    ("mpl-2.0", "subject to the terms of the mozilla public license [,] v 2 0"),
    ("cc-by-nc-4.0", "licensed under [a] [creative commons] cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under [a] [creative commons] cc by sa 4 0"),
    ("cc-by-4.0", "licensed under [a] [creative commons] cc by 4 0"),
    ("cc-notice", "licensed under a creative commons {6} license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
)

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class Automaton:
    """States 0 to n; edges by word, edges by any word, and edges that read nothing."""

    def __init__(self, template: str):
        self.words: dict[int, dict[bytes, set[int]]] = defaultdict(dict)
        self.any: dict[int, set[int]] = defaultdict(set)
        self.free: dict[int, set[int]] = defaultdict(set)
        self.states, start = 1, None
        for part in template.replace("[", " [ ").replace("]", " ] ").split():
            here = self.states - 1
            if part == "[":
                start = here
            elif part == "]":
                self.free[start].add(here)
                start = None
            elif part[0] == "{":
                states = [here, *(self._state() for _ in range(int(part[1:-1])))]
                end = self._state()
                for a, b in zip(states, states[1:]):
                    self.any[a].add(b)
                for a in states:
                    self.free[a].add(end)
            else:
                for word in tokens(part):
                    self.words[here].setdefault(word, set()).add(next_state := self._state())
                    here = next_state
        self.end = self.states - 1
        self.first = {w for s in self._closure({0}) for w in self.words[s]}

    def _state(self) -> int:
        self.states += 1
        return self.states - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return seen

    def accepts(self, words: list[bytes], start: int) -> int:
        """Length of the shortest match that begins at start, 0 if there is none."""
        states = self._closure({0})
        for at in range(start, len(words)):
            word = words[at]
            states = self._closure({t for s in states for t in (*self.words[s].get(word, ()), *self.any[s])})
            if self.end in states:
                return at + 1 - start
            if not states:
                return 0
        return 0


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple[str, str], ...]):
    """Automata by the words they can begin with."""
    by_word: dict[bytes, list[tuple[str, Automaton]]] = defaultdict(list)
    for label, template in templates:
        automaton = Automaton(template)
        for word in automaton.first:
            by_word[word].append((label, automaton))
    return by_word


def scan_words(words: list[bytes], phrases=BASE_PHRASES, templates=TEMPLATES):
    """Base places [(start, label)] in order, and template matches [(start, length, label)]."""
    starts: dict[bytes, list[tuple[list[bytes], str]]] = defaultdict(list)
    for phrase, label in phrases:
        parts = phrase.encode().split()
        starts[parts[0]].append((parts, label))
    automata = compiled(templates)
    present = set(words)
    places, matches = [], []
    if not (present & starts.keys() or present & automata.keys()):
        return places, matches
    for i, word in enumerate(words):
        for parts, label in starts.get(word, ()):
            if words[i : i + len(parts)] == parts:
                places.append((i, label))
        for label, automaton in automata.get(word, ()):
            if length := automaton.accepts(words, i):
                matches.append((i, length, label))
    return places, matches


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    phrases: tuple[tuple[str, str], ...] = BASE_PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels array, labels array, matches array, score) per row."""

    def run(rows):
        for key, text in rows:
            words = tokens(text)
            places, matches = scan_words(words, phrases, templates)
            base = sorted({label for _, label in places})
            labels = sorted({*base, *(label for _, _, label in matches)})
            spans = [{"start": s, "length": n, "label": label} for s, n, label in matches]
            score = 1.0 if matches else 0.5 if places else 0.0
            yield key, len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, base, labels, spans, score

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>,"
        " labels array<string>, matches array<struct<start:long,length:long,label:string>>, score double"
    )
    return map_rows(docs.select(id_col, text_col), run, schema)
