"""Licence scans with template markup.

A template is mandatory wording with regions: <<optional>> ... <<end>> may be
left out, <<any N>> stands for up to N words of any kind. It is compiled into an
automaton over words and accepts a place of a text whose mandatory words stand
there exactly. Plain phrases are templates without regions.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import normal_words

#: Phrases that must be reported wherever their words stand, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
_MIT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions
the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or
substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited
to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<any 12>> be liable for any claim
damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the
use or other dealings in the software"""
_BSD = """
redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
<<any 1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
<<any 1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
documentation and or other materials provided with the distribution <<optional>><<any 1>> neither the name of <<any 12>> nor the names of
<<any 12>> may be used to endorse or promote products derived from this software without specific prior written permission<<end>>
this software is provided by <<any 12>> as is and any express or implied warranties including but not limited to the implied warranties of
merchantability and fitness for a particular purpose are disclaimed in no event shall <<any 12>> be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits
or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or
otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
_APACHE_NOTICE = """
licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy
of the license at <<any 8>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an
as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing
permissions and limitations under the license"""
_GPL_NOTICE = """
this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free
software foundation either version <<any 2>> of the license or at your option any later version this program is distributed in the hope that it
will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
general public license for more details"""
#: Wording of licences and notices, from their first to their last word, and the labels that they add.
TEMPLATES = (
    ("<<optional>>released<<end>><<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> mit license", "mit-notice"),
    ("licensed under the apache license <<optional>>version<<end>> 2 0", "apache-2.0"),
    ("<<optional>>licensed under<<end>> the <<optional>>gnu<<end>> general public license <<any 3>> version 3", "gpl-3.0"),
    ("the <<optional>>gnu<<end>> general public license <<any 3>> version 2", "gpl-2.0"),
    ("licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> <<optional>>cc<<end>> by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> <<optional>>cc<<end>> by 4 0", "cc-by-4.0"),
    ("licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> <<optional>>cc<<end>> by sa 4 0", "cc-by-sa-4.0"),
    ("spdx license identifier <<any 4>>", "spdx"),
    (_MIT, "mit-text"),
    (_BSD, "bsd"),
    (_APACHE_NOTICE, "apache-2.0-notice"),
    (_GPL_NOTICE, "gpl-notice"),
)
#: A part of a template's wording has a score from this share and number of mandatory words on.
PART, PART_WORDS = 0.5, 3
_MARK = re.compile(r"<<(optional|end|any \d+)>>")


class Automaton(NamedTuple):
    """States with their word moves, any-word moves and free moves; the last state accepts."""

    label: str
    words: list[dict[str, int]]
    any_word: list[int]
    free: list[tuple[int, ...]]
    #: Mandatory words up to each state, of those in all.
    progress: list[float]
    #: Words that a match can begin with, a word that every match has, and one that every part with a score has.
    begins: frozenset[str]
    rarest: str
    early: str
    n_mandatory: int

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def accepts_at(self, words: list[str], start: int) -> tuple[bool, float]:
        """Whether a match starts there, and the largest share of the mandatory words that was met."""
        states, best, last = self.closure({0}), 0.0, len(self.words) - 1
        for at in range(start, len(words)):
            word, after = words[at], set()
            for state in states:
                if word in self.words[state]:
                    after.add(self.words[state][word])
                if self.any_word[state] >= 0:
                    after.add(self.any_word[state])
            states = self.closure(after)
            if not states:
                return False, best
            best = max(best, *(self.progress[s] for s in states))
            if last in states:
                return True, 1.0
        return last in states, best


def _least(n: int) -> int:
    """The number of mandatory words, of n, from which on a part has a score."""
    return min(n, max(PART_WORDS, math.ceil(PART * n)))


def compile_template(markup: str, label: str) -> Automaton:
    """The automaton of a template; its mandatory wording must not be empty."""
    words, any_word, free, met, opened = [{}], [-1], [()], [0], []

    def state(mandatory: int) -> int:
        words.append({})
        any_word.append(-1)
        free.append(())
        met.append(mandatory)
        return len(words) - 1

    mandatory = []
    for place, part in enumerate(_MARK.split(markup)):
        at = len(words) - 1
        if place % 2 == 0:
            for raw in normal_words(part):
                word, here = raw.decode(), len(words) - 1
                words[here][word] = state(met[-1] + (not opened))
                if not opened:
                    mandatory.append(word)
        elif part == "optional":
            opened.append(at)
        elif part == "end":
            free[opened.pop()] += (at,)
        else:
            for _ in range(int(part.split()[1])):
                here = len(words) - 1
                any_word[here] = state(met[-1])
            for skipped in range(at, len(words) - 1):
                free[skipped] += (len(words) - 1,)
    if opened or not mandatory:
        raise ValueError(f"a region stays open, or nothing is mandatory: {markup}")
    built = Automaton(label, words, any_word, free, [m / len(mandatory) for m in met], frozenset(), max(mandatory, key=len), max(mandatory[: _least(len(mandatory))], key=len), len(mandatory))
    start = built.closure({0})
    if any(any_word[s] >= 0 for s in start):
        raise ValueError(f"a template must not begin with any word: {markup}")
    return built._replace(begins=frozenset(w for s in start for w in words[s]))


def scan_text(text: str | None, phrases: list[Automaton], templates: list[Automaton]) -> tuple:
    """n_words, starts of phrases, labels of phrases, labels of templates, score."""
    raw = normal_words(text)
    joined = b" ".join(raw)
    likely = [[a for a in phrases if a.rarest.encode() in joined], [a for a in templates if a.early.encode() in joined]]
    if not any(likely):
        return len(raw), [], set(), set(), 0.0
    words = [w.decode() for w in raw]
    places: dict[str, list[int]] = {w: [] for group in likely for a in group for w in a.begins}
    for at, word in enumerate(words):
        if word in places:
            places[word].append(at)
    starts, found, score = [], (set(), set()), 0.0
    for kind, group in enumerate(likely):
        for automaton in group:
            for at in sorted(x for w in automaton.begins for x in places[w]):
                accepted, share = automaton.accepts_at(words, at)
                if kind and round(share * automaton.n_mandatory) >= _least(automaton.n_mandatory):
                    score = max(score, share)
                if accepted:
                    found[kind].add(automaton.label)
                    if not kind:
                        starts.append(at)
                        score = max(score, 0.5)
    return len(raw), starts, found[0], found[0] | found[1], score


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """row (all columns of docs as a struct), doc_id, n_words, places, base_labels, labels, score.

    places are the words (from 0) where phrases start, in order; labels are
    sorted and distinct, base_labels those of phrases, labels those of
    templates too. score is 1 for an accepted template, else the largest
    share of a template's mandatory words met in order from its first, if at
    least half and three words; a phrase alone gives 0.5. Null and empty texts have no words and score 0.
    Every row is scanned by itself. No rows give no rows.
    """
    plain = [compile_template(m, label) for m, label in phrases]
    marked = [compile_template(m, label) for m, label in templates]

    @F.pandas_udf("n_words long, places array<long>, base_labels array<string>, labels array<string>, score double")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = [scan_text(t, plain, marked) for t in texts]
        return pd.DataFrame({
            "n_words": [r[0] for r in rows],
            "places": [sorted(r[1]) for r in rows],
            "base_labels": [sorted(r[2]) for r in rows],
            "labels": [sorted(r[3]) for r in rows],
            "score": [r[4] for r in rows],
        })

    found = docs.select(F.struct("*").alias("row"), scanned("text").alias("found"))
    return found.select("row", F.col("row.doc_id").alias("doc_id"), "found.*")
