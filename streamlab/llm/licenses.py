"""License scans: templates with optional and replaceable regions, compiled to token automata.

A template is text with the marks ``[[optional words]]`` and ``{{n}}`` (up to n words of any kind).
It is compiled to an automaton over words; a text matches at a word if the automaton, started there,
reaches its end, so every word outside the marks must be there, in order, and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import text_chunks

#: What counts as a word, after A-Z is lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Wordings that several templates share.
_AS_IS = (
    "this software is provided by {{12}} as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for "
    "any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of "
    "liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the "
    "use of this software even if advised of the possibility of such damage"
)
_REDISTRIBUTION = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_GRANT = (
    "[[copyright {{16}}]] permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
    "whom the software is furnished to do so "
)
_NO_LIABILITY = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
    "of merchantability fitness for a particular purpose and noninfringement in no event shall the {{6}} be liable for any claim "
    "damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
    "software or the use or other dealings in the software"
)
_FEE_OR_NOT = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
_AUTHOR_DISCLAIMS = (
    "the software is provided as is and {{12}} disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall {{12}} be liable for any special direct indirect or consequential "
    "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or "
    "other tortious action arising out of or in connection with the use or performance of this software"
)
_HOPE = (
    "{{4}} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose see the gnu "
)
#: Templates of whole licenses, of notices and of names, and their labels. Fixed values of public wordings.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license [[, ]]version 2.0",
        "[[the]] apache license [[, ]]version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in "
        "compliance with the license [[you may obtain a copy of the license at {{12}}]] unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an "
        "as is basis without warranties or conditions of any kind either express or implied [[see the license for the "
        "specific language governing permissions and limitations under the license]]",
    ],
    "mit": [
        "released under the [[terms of the]] mit license",
        "licensed under the [[terms of the]] mit license",
        "[[the mit license]] [[mit]] " + _GRANT + "subject to the following conditions the above copyright notice and this "
        "permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software "
        + _NO_LIABILITY,
    ],
    "mit-0": ["[[mit no attribution]] " + _GRANT + _NO_LIABILITY],
    "gpl-2.0-or-later": [
        "gnu general public license as published by the free software foundation either version 2 of the license "
        "or [[at your option]] any later version [[" + _HOPE + "general public license for more details]]",
        "gnu general public license [[, ]]version 2 or [[any]] later",
    ],
    "gpl-3.0-or-later": [
        "gnu general public license as published by the free software foundation either version 3 of the license "
        "or [[at your option]] any later version [[" + _HOPE + "general public license for more details]]",
        "gnu general public license [[, ]]version 3 or [[any]] later",
    ],
    "gpl-3.0": ["gnu general public license [[, ]]version 3", "gnu general public license v3"],
    "gpl-2.0": ["gnu general public license [[, ]]version 2", "gnu general public license v2"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license"],
    "lgpl-2.1-or-later": [
        "gnu lesser general public license as published by the free software foundation either version 2.1 of the license or "
        "[[at your option]] any later version [[" + _HOPE + "lesser general public license for more details]]",
    ],
    "lgpl-3.0-or-later": [
        "gnu lesser general public license as published by the free software foundation either version 3 of the license or "
        "[[at your option]] any later version [[" + _HOPE + "lesser general public license for more details]]",
    ],
    "agpl": ["gnu affero general public license"],
    "agpl-3.0-or-later": [
        "gnu affero general public license as published by the free software foundation either version 3 of the license or "
        "[[at your option]] any later version [[" + _HOPE + "affero general public license for more details]]",
    ],
    "cc-by-4.0": ["cc by 4.0", "creative commons attribution 4.0 [[international]] [[public]] license"],
    "cc-by-3.0": ["cc by 3.0", "creative commons attribution 3.0 [[unported]] license"],
    "cc-by-sa-4.0": ["cc by sa 4.0", "creative commons attribution sharealike 4.0 [[international]] [[public]] license"],
    "cc-by-nc-4.0": ["cc by nc 4.0", "creative commons attribution noncommercial 4.0 [[international]] [[public]] license"],
    "cc-by-nd-4.0": ["cc by nd 4.0", "creative commons attribution noderivatives 4.0 [[international]] [[public]] license"],
    "cc0-1.0": ["cc0 1.0 [[universal]]", "creative commons zero v1.0 universal"],
    "bsd": ["[[the]] bsd license"],
    "bsd-2-clause": ["bsd 2 clause [[simplified]] license", _REDISTRIBUTION + _AS_IS],
    "bsd-3-clause": [
        "bsd 3 clause [[new or revised]] license",
        _REDISTRIBUTION + "[[3]] neither the name of {{16}} nor the names of {{6}} may be used to endorse or promote products "
        "derived from this software without specific prior written permission " + _AS_IS,
    ],
    "isc": [
        "isc license",
        _FEE_OR_NOT + "provided that the above copyright notice and this permission notice appear in all copies " + _AUTHOR_DISCLAIMS,
    ],
    "0bsd": ["bsd zero clause license", _FEE_OR_NOT + _AUTHOR_DISCLAIMS],
    "zlib": [
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for "
        "any damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
        "including commercial applications and to alter it and redistribute it freely subject to the following restrictions [[1]] "
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use "
        "this software in a product an acknowledgment in the product documentation would be appreciated but is not required [[2]] "
        "altered source versions must be plainly marked as such and must not be misrepresented as being the original software [[3]] "
        "this notice may not be removed or altered from any source distribution",
    ],
    "bsl-1.0": [
        "boost software license [[, ]]version 1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and "
        "to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all "
        "subject to the following the copyright notices in the software and this entire statement including the above license grant "
        "this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all "
        "derivative works of the software unless such copies or derivative works are solely in the form of machine executable object "
        "code generated by a source language processor the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement in "
        "no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether "
        "in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2.0 [[if a copy of the mpl was not distributed "
        "with this file you can obtain one at {{8}}]]",
        "mozilla public license [[, ]]version 2.0",
    ],
    "epl-2.0": ["eclipse public license [[, ]][[version]] [[v]] 2.0"],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
        "sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non "
        "commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate "
        "any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at "
        "large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law the software is provided as is without "
        "warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ],
    "wtfpl": ["do what the fuck you want to public license"],
}

MARK = re.compile(r"\[\[(.*?)\]\]|\{\{(\d+)\}\}", re.S)


class Part(NamedTuple):
    """``words`` (then ``gap`` is 0) or up to ``gap`` words of any kind."""

    words: tuple[str, ...]
    gap: int = 0


def words_of(text: str) -> list[str]:
    """Words after A-Z alone is lower-cased; other letters stay as they are."""
    return WORD.findall(text.translate(LOWER))


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Automaton:
    """States are numbered; ``steps[s]`` maps a word to next states, ``any_step[s]`` takes every word."""

    def __init__(self, template: str):
        self.steps: list[dict[str, set[int]]] = [{}]
        self.any_step: list[set[int]] = [set()]
        self.free: list[set[int]] = [set()]
        self.end = self._sequence(template, 0)
        self.start = self._closure({0})
        closed = [self._closure({s}) for s in range(len(self.steps))]
        self.moves = [{w: frozenset().union(*(closed[t] for t in to)) for w, to in step.items()} for step in self.steps]
        self.any_moves = [frozenset().union(*(closed[t] for t in to)) if to else frozenset() for to in self.any_step]
        self.first = {w for s in self.start for w in self.steps[s]}

    def _state(self) -> int:
        self.steps.append({})
        self.any_step.append(set())
        self.free.append(set())
        return len(self.steps) - 1

    def _sequence(self, text: str, state: int) -> int:
        at = 0
        for m in MARK.finditer(text):
            state = self._words(text[at : m.start()], state)
            if m[2]:
                inner = state
                for _ in range(int(m[2])):
                    after = self._state()
                    self.any_step[inner].add(after)
                    inner = after
                    self.free[state].add(after)
                # Any of the states between may go on with what follows the region.
                last = self._state()
                for s in {state, *self.free[state]}:
                    self.free[s].add(last)
                state = last
            else:
                end = self._sequence(m[1], state)
                last = self._state()
                self.free[end].add(last)
                self.free[state].add(last)
                state = last
            at = m.end()
        return self._words(text[at:], state)

    def _words(self, text: str, state: int) -> int:
        for w in words_of(text):
            after = self._state()
            self.steps[state].setdefault(w, set()).add(after)
            state = after
        return state

    def _closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def match(self, words: list[str], at: int) -> int:
        """The number of words of the longest match that starts at ``at``; 0 if there is none."""
        states, best = self.start, 0
        for n in range(at, len(words)):
            word, following = words[n], set()
            for s in states:
                following |= self.moves[s].get(word, frozenset())
                following |= self.any_moves[s]
            if not following:
                break
            if self.end in following:
                best = n + 1 - at
            states = frozenset(following)
        return best


class Found(NamedTuple):
    label: str
    base: bool
    start: int
    length: int


class Scanner:
    """All phrases and templates; a text is walked only from words that can begin one."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES):
        self.automata = [(label, True, Automaton(text)) for text, label in phrases.items()]
        self.automata += [(label, False, Automaton(t)) for label, ts in templates.items() for t in ts]
        self.by_first: dict[str, list[tuple[str, bool, Automaton]]] = {}
        for entry in self.automata:
            for word in entry[2].first:
                self.by_first.setdefault(word, []).append(entry)
        # A word that every match has; a text without any of these cannot match.
        needed = {max(self._mandatory(t), key=lambda w: (w in RARE, len(w))) for t in [*phrases, *(t for ts in templates.values() for t in ts)]}
        self.needed = re.compile("|".join(sorted(map(re.escape, needed))))

    @staticmethod
    def _mandatory(template: str) -> list[str]:
        return words_of(MARK.sub(" ", template))

    def scan(self, text: str) -> list[Found]:
        lowered = text.translate(LOWER)
        if not self.needed.search(lowered):
            return []
        words = WORD.findall(lowered)
        found = []
        for at, word in enumerate(words):
            for label, base, automaton in self.by_first.get(word, ()):
                if n := automaton.match(words, at):
                    found.append(Found(label, base, at, n))
        return found


#: Words that are rare outside of licenses; each phrase has one.
RARE = {"license", "apache", "cc", "cc0", "mit", "gnu", "bsd", "isc", "mozilla", "creative", "redistribution", "permission", "unencumbered", "boost", "eclipse", "misrepresented"}
IS_WORD = np.zeros(256, bool)
IS_WORD[128:] = True
for _c in range(128):
    IS_WORD[_c] = chr(_c).isalnum()


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its words, and every match with label, start and length in words.

    A null text is empty: no words, no match. Repeated rows and null ids each give their own row. Other
    columns are left out. One pass, no shuffle.
    """
    kind = df.schema[id_col].dataType.simpleString()
    match = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for rows, data, offsets in text_chunks(batches, "text"):
            inside = IS_WORD[data]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            starts = offsets[:-1][np.diff(offsets) > 0]
            begins[starts] = inside[starts]
            total = np.concatenate(([0], np.cumsum(begins)))
            found = [[f._asdict() for f in scanner.scan(t or "")] for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(total[offsets[1:]] - total[offsets[:-1]]), pa.array(found, pa.list_(match))],
                ["doc_id", "n_words", "matches"],
            )

    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(
        run, f"doc_id {kind}, n_words long, matches array<struct<label string, base boolean, start bigint, length bigint>>"
    )


def op1_licenses(df: DataFrame) -> DataFrame:
    """Digest columns. The score grows with the longest match: words / (words + 4); 0 without a match."""
    base = F.filter("matches", lambda m: m["base"])
    longest = F.array_max(F.transform("matches", lambda m: m["length"]))
    label = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")
    return (
        scan_licenses(df)
        .withColumn("base", base)
        .select(
            "doc_id",
            "n_words",
            F.size("base").cast("long").alias("n_base"),
            F.array_min(F.transform("base", lambda m: m["start"])).alias("first_word"),
            F.array_max(F.transform("base", lambda m: m["start"])).alias("last_word"),
            label("base").alias("base_labels"),
            label("matches").alias("labels"),
            F.coalesce(longest / (longest + F.lit(4.0)), F.lit(0.0)).alias("score"),
        )
    )
