"""License scans by matching template markup.

A template is wording with three kinds of regions, in the manner of license-list
templates: ``<<optional>> ... <</optional>>`` may be left out, ``<<replace N>>`` stands
for up to N words of the licensor's own, and ``<<any a b>>`` for one word of those
named. Each template is compiled into an automaton over words. A license is accepted
where its wording, as it stands from the beginning of a line or sentence to the end
of one, is the template's: all mandatory words exactly, nothing between or beside
them. Where the wording occurs within other wording ("not licensed under ...",
"... except for sale"), its label goes to ``embedded`` instead. ``n_covered`` counts the words of
accepted regions, so what a text says besides them is known as well. Besides,
plain phrases are counted wherever their words stand consecutively.

Words are the runs of ``[0-9a-z]`` and non-ASCII characters after A-Z is lower-cased
(worked on as UTF-8, where every byte of a non-ASCII character is over 0x7F). A
sentence ends at ``.``, ``!`` or ``?`` before a blank, a quote, a bracket or the end; a line
at ``\\n``.

Defined results: a null or empty text has no words, no labels and score 0. The
score is 1 where a template accepts, else 0.5 where a phrase or embedded wording
occurs, else 0. Rows repeat as in the input; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
_UNDER = "<<optional>> this <<replace 3>> is <</optional>> <<any licensed released distributed>> under <<optional>> <<optional>> the <</optional>> terms of <</optional>>"
# The licenses' own wording, as published.
_MIT = """
    permission is hereby granted free of charge to any person obtaining a copy of <<replace 8>> the software to deal in the
    software without restriction including without limitation the rights to use copy modify merge publish distribute
    sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject
    to the following conditions the above copyright notice and this permission notice <<optional>> including the next
    paragraph <</optional>> shall be included in all copies or substantial portions of the software the software is
    provided as is without warranty of any kind express or implied including but not limited to the warranties of
    merchantability fitness for a particular purpose and noninfringement in no event shall <<replace 12>> be liable for any
    claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
    with the software or the use or other dealings in the software"""
_ISC = """
    permission to use copy modify and <<optional>> or <</optional>> distribute this software for any purpose with or without
    fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the
    software is provided as is and <<replace 8>> disclaims all warranties with regard to this software including all implied
    warranties of merchantability and fitness in no event shall <<replace 8>> be liable for any special direct indirect or
    consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of
    contract negligence or other tortious action arising out of or in connection with the use or performance of this software"""
_BSD_CONDITIONS = """
    redistribution and use in source and binary forms with or without modification are permitted provided that the following
    conditions are met <<replace 1>> redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer <<replace 1>> redistributions in binary form must reproduce the above copyright
    notice this list of conditions and the following disclaimer in the documentation and or other materials provided with
    the distribution"""
_BSD_NAMES = """
    <<replace 1>> neither the name of <<replace 10>> nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission"""
_BSD_DISCLAIMER = """
    this software is provided by <<replace 12>> as is and any express or implied warranties including but not limited to the
    implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall
    <<replace 12>> be liable for any direct indirect incidental special exemplary or consequential damages including but not
    limited to procurement of substitute goods or services loss of use data or profits or business interruption however
    caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
    arising in any way out of the use of this software even if advised of the possibility of such damage"""
_APACHE = """
    licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
    license you may obtain a copy of the license at <<any http https>> www apache org licenses license 2 0 unless required
    by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
    without warranties or conditions of any kind either express or implied see the license for the specific language
    governing permissions and limitations under the license"""
_GPL = """
    this <<replace 3>> is free software you can redistribute it and or modify it under the terms of the gnu general public
    license as published by the free software foundation either version {} of the license or at your option any later
    version this <<replace 3>> is distributed in the hope that it will be useful but without any warranty without even the
    implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more
    details <<optional>> you should have received a copy of the gnu general public license along with this <<replace 3>> if
    not see <<any http https>> www gnu org licenses <</optional>>"""


def _creative_commons() -> dict[str, list[str]]:
    """A label of its own for each of the six sets of conditions."""
    spelled = {"": "", "nc": "noncommercial", "sa": "sharealike", "nd": "<<any noderivatives noderivs>>"}
    out = {}
    for nc, last in product(("", "nc"), ("", "sa", "nd")):
        short, long = (" ".join(x for x in parts if x) for parts in (("cc by", nc, last), ("creative commons attribution", spelled[nc], spelled[last])))
        name = "-".join(["cc-by", *filter(None, (nc, last)), "4.0"])
        out[name] = [f"{_UNDER} <<optional>> <<any a the>> <</optional>> {words} 4 0 <<optional>> international <</optional>> <<optional>> license <</optional>>" for words in (short, long)]
    return out


#: Labels of the method's own, each with its templates.
TEMPLATES = {
    "mit-text": [_MIT],
    "isc-text": [_ISC],
    "bsd-2-text": [_BSD_CONDITIONS + _BSD_DISCLAIMER],
    "bsd-3-text": [_BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER],
    "apache-2.0-header": [_APACHE],
    "gpl-2-or-later-header": [_GPL.format("2")],
    "gpl-3-or-later-header": [_GPL.format("3")],
    "apache-2.0": [f"{_UNDER} the apache license version 2 0 <<optional>> the license <</optional>>"],
    "gpl-2": [f"{_UNDER} the gnu general public license version 2 <<optional>> 0 <</optional>>"],
    "gpl-3": [f"{_UNDER} the gnu general public license version 3 <<optional>> 0 <</optional>>"],
    "mit-notice": [f"{_UNDER} the mit license"],
    **_creative_commons(),
}
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Upper case becomes lower case, what is in no word becomes a blank.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))
_MARK = re.compile(r"<<(optional|/optional|replace (\d+)|any ([^>]+))>>|(\S+)")
_BREAK = re.compile(rb"""\n|[.!?](?=[\s"'()\[\]]|$)""")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text."""
    return text.translate(_TABLE).split()


def breaks_of(text: bytes) -> set[int]:
    """How many words stand before each place where a line or sentence begins or ends."""
    out, begin, n = {0}, 0, 0
    for found in _BREAK.finditer(text):
        n += len(words_of(text[begin : found.start()]))
        out.add(n)
        begin = found.end()
    out.add(n + len(words_of(text[begin:])))
    return out


class Automaton:
    """States with edges by word, by any word and by none; the last state accepts."""

    def __init__(self, template: str) -> None:
        self.word: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.empty: list[list[int]] = [[]]
        begun: list[int] = []
        mandatory: list[str] = []
        for mark, most, choice, word in _MARK.findall(template):
            here = len(self.word) - 1
            if word or choice:
                words = [word] if word else choice.split()
                self.word[here] = dict.fromkeys((w.encode() for w in words), self._state())
                mandatory += [word] if word and not begun else []
            elif mark == "optional":
                begun.append(here)
                self.empty[here].append(self._state())
            elif mark == "/optional":
                self.empty[here].append(end := self._state())
                self.empty[begun.pop()].append(end)
            else:
                states = [here]
                for _ in range(int(most)):
                    self.any[states[-1]] = self._state()
                    states.append(len(self.word) - 1)
                end = self._state()
                for state in states:
                    self.empty[state].append(end)
        if begun:
            raise ValueError("optional region without end")
        self.last = len(self.word) - 1
        #: The longest word that all matches contain.
        self.needed = max((w.encode() for w in mandatory), key=len, default=b"")
        first = self._closure({0})
        #: Words with which a match can begin, if that isn't any word.
        self.begins = {w for s in first for w in self.word[s]}
        if self.last in first or any(self.any[s] is not None for s in first):
            raise ValueError("a template has to begin with words of its own")

    def _state(self) -> int:
        self.word.append({})
        self.any.append(None)
        self.empty.append([])
        return len(self.word) - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in states:
                    states.add(nxt)
                    todo.append(nxt)
        return states

    def ends(self, words: list[bytes], at: int) -> Iterator[int]:
        """Where the matches that begin at word ``at`` end."""
        states = self._closure({0})
        while states:
            if self.last in states:
                yield at
            if at == len(words):
                return
            word, nxt = words[at], set()
            for s in states:
                if word in self.word[s]:
                    nxt.add(self.word[s][word])
                if self.any[s] is not None:
                    nxt.add(self.any[s])
            states, at = self._closure(nxt), at + 1


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES) -> None:
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.templates = [(label, Automaton(t)) for label, own in templates.items() for t in own]
        self.begins = {p[0] for p, _ in self.phrases}.union(*(a.begins for _, a in self.templates))
        #: For each phrase and template a word that all of its matches contain: texts with none of them need no scan.
        needed = [max(p, key=len) for p, _ in self.phrases] + [a.needed for _, a in self.templates]
        self.needed = None if b"" in needed else set(needed)

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, embedded, n_covered."""
        words = words_of(text)
        n_base, first, last = 0, None, None
        base, own, embedded = set(), set(), set()
        covered: list[tuple[int, int]] = []
        if self.needed is None or not self.needed.isdisjoint(there := set(words)):
            breaks = breaks_of(text)
            possible = [(label, a) for label, a in self.templates if not a.needed or a.needed in there]
            for at, word in enumerate(words):
                if word not in self.begins:
                    continue
                for phrase, label in self.phrases:
                    if phrase[0] == word and words[at : at + len(phrase)] == phrase:
                        n_base, last = n_base + 1, at
                        first = at if first is None else first
                        base.add(label)
                for label, automaton in possible:
                    if word not in automaton.begins:
                        continue
                    ends = list(automaton.ends(words, at))
                    whole = [e for e in ends if e in breaks] if at in breaks else []
                    if whole:
                        own.add(label)
                        covered.append((at, whole[-1]))
                    elif ends and not any(begin <= at and ends[-1] <= end for begin, end in covered):
                        embedded.add(label)
        n_covered, upto = 0, 0
        for begin, end in sorted(covered):
            n_covered += max(0, end - max(begin, upto))
            upto = max(upto, end)
        score = 1.0 if own else 0.5 if base or embedded else 0.0
        return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | own)), score, ",".join(sorted(embedded)), n_covered


_FIELDS = [
    ("n_words", "long", pa.int64()),
    ("n_base", "long", pa.int64()),
    ("first_word", "long", pa.int64()),
    ("last_word", "long", pa.int64()),
    ("base_labels", "string", pa.string()),
    ("labels", "string", pa.string()),
    ("score", "double", pa.float64()),
    ("embedded", "string", pa.string()),
    ("n_covered", "long", pa.int64()),
]


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, embedded, n_covered per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            found = [scanner.scan(body) for body in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), *(pa.array([x[i] for x in found], kind) for i, (_, _, kind) in enumerate(_FIELDS))], ["doc_id", *(n for n, _, _ in _FIELDS)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} {t}" for n, t, _ in _FIELDS))
