"""License scan by template markup compiled to token automata.

A template is text with two kinds of markup:

* ``<<optional>> ... <</optional>>``: words that may be missing (may be nested);
* ``<<var:name:least-most>>``: ``least`` to ``most`` words of any kind.

All other words are mandatory and must stand in the text exactly, in order.
``compile_template`` turns a template into a nondeterministic automaton over
words, which is run at every place where the template's rarest fixed run of
words can start. A text is accepted where the automaton reaches its end.

Words are runs of letters, digits and characters beyond ASCII; A-Z is lowered.
Defined cases: a null or wordless text has no places, no labels and score 0;
empty tables give empty results; repeated rows are scanned one by one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from panelcraft.llm.common import map_rows

#: Phrases whose every place counts, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: (label, weight of an accepted text, template). The wordings of public licenses.
TEMPLATES = (
    (
        "mit-text",
        0.99,
        """<<optional>>the mit license<</optional>> <<optional>>copyright <<optional>>c<</optional>>
        <<var:year:0-4>> <<var:holder:0-12>> <<optional>>all rights reserved<</optional>> <</optional>>
        permission is hereby granted free of charge to any person obtaining a copy of
        <<var:work:1-8>> and associated documentation files the software to deal in the software
        without restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions the above copyright notice
        and this permission notice <<optional>>including the next paragraph<</optional>> shall be
        included in all copies or substantial portions of the software the software is provided as is
        without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall the
        authors or copyright holders be liable for any claim damages or other liability whether in an
        action of contract tort or otherwise arising from out of or in connection with the software or
        the use or other dealings in the software""",
    ),
    (
        "isc-text",
        0.99,
        """permission to use copy modify and <<optional>>or<</optional>> distribute this software for
        any purpose with or without fee is hereby granted provided that the above copyright notice and
        this permission notice appear in all copies the software is provided as is and
        <<var:author:1-8>> <<optional>>disclaims<</optional>> <<optional>>disclaim<</optional>> all
        warranties with regard to this software including all implied warranties of merchantability
        and fitness in no event shall <<var:author:1-8>> be liable for any special direct indirect or
        consequential damages or any damages whatsoever resulting from loss of use data or profits
        whether in an action of contract negligence or other tortious action arising out of or in
        connection with the use or performance of this software""",
    ),
    (
        "bsd-text",
        0.99,
        """redistribution and use in source and binary forms with or without modification are
        permitted provided that the following conditions are met <<optional>>1<</optional>>
        redistributions of source code must retain the above copyright notice this list of conditions
        and the following disclaimer <<optional>>2<</optional>> redistributions in binary form must
        reproduce the above copyright notice this list of conditions and the following disclaimer in
        the documentation and or other materials provided with the distribution <<optional>>
        <<optional>>3<</optional>> neither the name of <<var:holder:1-12>> nor the names of
        <<optional>>its<</optional>> <<optional>>the<</optional>> contributors may be used to endorse
        or promote products derived from this software without specific prior written permission
        <</optional>> this software is provided by <<var:holder:1-12>> as is and any express or implied
        warranties including but not limited to the implied warranties of merchantability and fitness
        for a particular purpose are disclaimed in no event shall <<var:holder:1-12>> be liable for any
        direct indirect incidental special exemplary or consequential damages including but not limited
        to procurement of substitute goods or services loss of use data or profits or business
        interruption however caused and on any theory of liability whether in contract strict liability
        or tort including negligence or otherwise arising in any way out of the use of this software
        even if advised of the possibility of such damage""",
    ),
    (
        "apache-2-text",
        0.99,
        """licensed under the apache license version 2 0 the license you may not use
        <<var:subject:1-6>> except in compliance with the license you may obtain a copy of the license
        at <<optional>>http<</optional>> <<optional>>https<</optional>> www apache org licenses
        license 2 0 unless required by applicable law or agreed to in writing software distributed
        under the license is distributed on an as is basis without warranties or conditions of any kind
        either express or implied see the license for the specific language governing permissions and
        limitations under the license""",
    ),
    ("mit", 0.8, "<<var:verb:1-1>> under the mit license"),
    ("apache-2", 0.8, "under the apache license version 2 <<optional>>0<</optional>>"),
    ("cc-by-nc", 0.8, "licensed under cc by nc <<optional>>sa<</optional>> <<var:version:0-2>>"),
    ("cc-by", 0.8, "licensed under <<optional>>a<</optional>> cc by 4 0"),
    ("cc-by-sa", 0.8, "licensed under <<optional>>a<</optional>> cc by sa <<var:version:0-2>>"),
    (
        "gpl",
        0.8,
        """licensed under the gnu <<optional>>lesser<</optional>> <<optional>>affero<</optional>>
        general public license <<optional>>version <<var:version:1-1>><</optional>>""",
    ),
    (
        "gpl-text",
        0.99,
        """<<var:subject:1-4>> is free software you can redistribute it and or modify it under the
        terms of the gnu <<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public
        license as published by the free software foundation""",
    ),
    ("mpl-2", 0.8, "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", 0.8, "under the <<optional>><<var:kind:1-3>><</optional>> bsd license"),
    ("proprietary", 0.4, "<<optional>>copyright<</optional>> all rights reserved"),
)
#: The weight of a phrase of PHRASES alone.
PHRASE_WEIGHT = 0.5

_MARKUP = re.compile(r"<<(/?optional|var:[a-z]+:[0-9]+-[0-9]+)>>")
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_TO_WORDS = bytes.maketrans(
    _SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123))
)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered."""
    return (text or "").encode().translate(_TO_WORDS).split()


@dataclass
class Automaton:
    """Words over states 0..end; ``steps[s]`` is the word read there, None for any word."""

    label: str
    weight: float
    steps: list[bytes | None] = field(default_factory=list)
    skips: dict[int, list[int]] = field(default_factory=dict)
    anchor: bytes = b""
    least_before: int = 0
    most_before: int = 0

    @property
    def end(self) -> int:
        return len(self.steps)

    def closure(self, states: set[int]) -> set[int]:
        left = list(states)
        while left:
            for t in self.skips.get(left.pop(), ()):
                if t not in states:
                    states.add(t)
                    left.append(t)
        return states

    def accepts_at(self, words: list[bytes], start: int) -> int:
        """End of the longest accepted stretch that begins at ``start``, or -1."""
        states, last = self.closure({0}), -1
        for i in range(start, len(words) + 1):
            if self.end in states:
                last = i
            if i == len(words):
                break
            word = words[i]
            ahead = {
                s + 1 for s in states if s < self.end and self.steps[s] in (None, word)
            }
            if not ahead:
                break
            states = self.closure(ahead)
        return last


def compile_template(label: str, weight: float, template: str) -> Automaton:
    """The automaton of a template; its anchor is its longest run of mandatory words."""
    made, open_at = Automaton(label, weight), []
    runs: list[tuple[int, list[bytes]]] = [(0, [])]
    last = 0
    for mark in [*_MARKUP.finditer(template), None]:
        fixed = words_of(template[last : mark.start() if mark else len(template)])
        made.steps += fixed
        if not open_at and fixed:
            runs[-1][1].extend(fixed)
        if mark is None:
            break
        last = mark.end()
        if mark[1] == "optional":
            open_at.append(made.end)
        elif mark[1] == "/optional":
            made.skips.setdefault(open_at.pop(), []).append(made.end)
        else:
            least, most = map(int, mark[1].split(":")[2].split("-"))
            made.steps += [None] * most
            for k in range(made.end - most + least, made.end):
                made.skips.setdefault(k, []).append(made.end)
        runs.append((made.end, []))
    if open_at:
        raise ValueError(f"{label}: an optional region is not closed")
    state, run = max(runs, key=lambda r: (len(r[1]), -r[0]))
    if not run:
        raise ValueError(f"{label}: no mandatory words")
    made.anchor = b" " + b" ".join(run) + b" "
    made.most_before = state
    made.least_before = _shortest(made, state)
    return made


def _shortest(made: Automaton, state: int) -> int:
    """Fewest words that lead from the start to ``state``."""
    best = {0: 0}
    for s in range(state + 1):
        if s in best:
            for t in made.skips.get(s, ()):
                best[t] = min(best.get(t, best[s]), best[s])
            best[s + 1] = min(best.get(s + 1, best[s] + 1), best[s] + 1)
    return best[state]


@functools.lru_cache(maxsize=4)
def compiled(templates: tuple) -> tuple[Automaton, ...]:
    return tuple(compile_template(*t) for t in templates)


def places(line: bytes, wanted: bytes) -> Iterator[int]:
    """Word numbers where ``wanted`` (with spaces around) stands in the spaced line."""
    at, before, number = line.find(wanted), 0, 0
    while at >= 0:
        number += line.count(b" ", before, at)  # only what lies between two places is counted
        yield number
        at, before = line.find(wanted, at + 1), at


def scan(text: str | None, templates: tuple = TEMPLATES) -> tuple:
    """(number of words, phrase places, accepted stretches, labels, score) of one document.

    Words are numbered from 0 and ends are exclusive; the score is one minus the product of the doubts left by each label.
    """
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    base = [
        (at, at + len(p.split()), label)
        for p, label in PHRASES.items()
        for at in places(line, b" " + p.encode() + b" ")
    ]
    accepted: set[tuple[str, int, int]] = set()
    doubt: dict[str, float] = {label: 1 - PHRASE_WEIGHT for _, _, label in base}
    for made in compiled(templates):
        for at in places(line, made.anchor):
            for start in range(max(0, at - made.most_before), at - made.least_before + 1):
                end = made.accepts_at(words, start)
                if end > at:
                    accepted.add((made.label, start, end))
                    doubt[made.label] = min(doubt.get(made.label, 1.0), 1 - made.weight)
                    break
    left = 1.0
    for label in sorted(doubt):
        left *= doubt[label]
    return (
        len(words),
        [{"start": s, "end": e, "label": label} for s, e, label in sorted(base)],
        [{"label": label, "start": s, "end": e} for label, s, e in sorted(accepted)],
        sorted(doubt),
        round(1 - left, 6),
    )


def license_scan(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """doc_id, n_words, base (start, end, label), accepted (label, start, end), labels, score."""
    schema = (
        "n_words long, base array<struct<start:long,`end`:long,label:string>>, "
        "accepted array<struct<label:string,start:long,`end`:long>>, "
        "labels array<string>, score double"
    )
    return map_rows(
        docs, ["doc_id"], ["text"], lambda texts: [scan(t, templates) for t in texts], schema
    )
