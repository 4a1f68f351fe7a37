"""Licence scan: templates with optional and replaceable regions, compiled into one automaton over words.

A template is wording with markup: ``<<beginOptional>>``, ``<<endOptional>>`` (they nest) and ``<<var;max=N>>``, which stands for up to N
words of any kind. All templates become one nondeterministic automaton; its sets of states are made deterministic as
texts ask for them. From every word that can begin a template the automaton reads on until no state is left. A text is
accepted by a template where all its mandatory words stand in order with nothing else between them.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z lower-cased. Null and empty texts have no words: no
matches, empty label lists, score 0. Texts are read whole, rows that repeat give a row each, extra columns are ignored, and
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import bounded_batches, runs

#: The phrases and labels of the base rule.
BASE = {
    "mit": ["under the mit license"],
    "apache-2": ["apache license version 2"],
    "cc-by-nc": ["cc by nc"],
}
#: Wording of common notices.
TEMPLATES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "<<var;max=6>> <<beginOptional>>and associated documentation files<<endOptional>> to deal in the",
        "mit license <<beginOptional>>mit<<endOptional>> copyright",
    ],
    "apache-2": [
        "licensed under the apache license version 2 <<beginOptional>>0<<endOptional>> "
        "<<beginOptional>>the license<<endOptional>>",
        "you may obtain a copy of the license at <<var;max=3>> www apache org licenses license 2 0",
    ],
    "cc-by-nc": [
        "cc by nc <<beginOptional>><<var;max=1>> 0<<endOptional>>",
        "creative commons attribution noncommercial <<beginOptional>><<var;max=2>> international<<endOptional>> license",
    ],
    "gpl": [
        "gnu <<beginOptional>>lesser<<endOptional>> general public license "
        "<<beginOptional>>version <<var;max=1>><<endOptional>>",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ],
    "cc-by": ["creative commons attribution <<beginOptional>><<var;max=2>> international<<endOptional>> license"],
    "all-rights-reserved": [
        "<<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;max=8>><<endOptional>> all rights reserved",
    ],
}

_BREAK = bytes(
    c if c > 127 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower()) if chr(c).isalpha() else 32
    for c in range(256)
)
_MARKUP = re.compile(r"<<(\w+)(?:;max=(\d+))?>>|([^\s<]+)")
ANY = None


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BREAK).split()


class Automaton:
    """All templates in one. ``accepts[state]`` has the template numbers that end in a state."""

    def __init__(self, templates: list[str]):
        self.arcs: list[list[tuple[bytes | None, int]]] = []
        self.empty: list[list[int]] = []
        self.final: dict[int, int] = {}
        entries = []
        for number, template in enumerate(templates):
            first, last = self._compile(template)
            entries.append(first)
            self.final[last] = number
        self.sets: dict[frozenset[int], int] = {}
        self.members: list[frozenset[int]] = []
        self.next: list[dict[bytes | None, int]] = []
        self.accepts: list[tuple[int, ...]] = []
        self.dead = self._number(frozenset())
        self.start = self._number(self._closed(entries))
        self.known = {w for arcs in self.arcs for w, _ in arcs if w is not ANY}
        begins = [w for s in self.members[self.start] for w, _ in self.arcs[s]]
        if ANY in begins or self.accepts[self.start]:
            raise ValueError("a template must begin with a mandatory or optional word and not be empty")
        self.begins = frozenset(begins)

    def _state(self) -> int:
        self.arcs.append([])
        self.empty.append([])
        return len(self.arcs) - 1

    def _compile(self, template: str) -> tuple[int, int]:
        first = last = self._state()
        open_at: list[int] = []
        for kind, most, word in _MARKUP.findall(template):
            if kind == "beginOptional":
                open_at.append(last)
            elif kind == "endOptional":
                close = self._state()
                self.empty[last].append(close)
                self.empty[open_at.pop()].append(close)
                last = close
            elif kind == "var":
                close = self._state()
                for _ in range(int(most)):
                    self.empty[last].append(close)
                    new = self._state()
                    self.arcs[last].append((ANY, new))
                    last = new
                self.empty[last].append(close)
                last = close
            elif word:
                new = self._state()
                self.arcs[last].append((word.encode(), new))
                last = new
        if open_at:
            raise ValueError("an optional region is not closed")
        return first, last

    def _closed(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.empty[s]
        return frozenset(seen)

    def _number(self, states: frozenset[int]) -> int:
        if states not in self.sets:
            self.sets[states] = len(self.members)
            self.members.append(states)
            self.next.append({})
            self.accepts.append(tuple(sorted(self.final[s] for s in states if s in self.final)))
        return self.sets[states]

    def step(self, state: int, word: bytes) -> int:
        key = word if word in self.known else ANY
        found = self.next[state].get(key)
        if found is None:
            onto = [t for s in self.members[state] for w, t in self.arcs[s] if w is ANY or w == key]
            found = self.next[state][key] = self._number(self._closed(onto))
        return found

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Template number, first word and the word after the longest match, from each place where a template fits."""
        begins, n = self.begins, len(words)
        for i in [k for k, w in enumerate(words) if w in begins]:
            state, j, best = self.start, i, {}
            while j < n:
                state = self.step(state, words[j])
                if state == self.dead:
                    break
                j += 1
                for number in self.accepts[state]:
                    best[number] = j
            for number, stop in best.items():
                yield number, i, stop


def scan(docs: DataFrame, base: Mapping[str, list[str]] = BASE, more: Mapping[str, list[str]] = TEMPLATES) -> DataFrame:
    """A row for each document, with the matched spans: template label, first word, word after the last."""
    flat = [(label, True, t) for label, ts in base.items() for t in ts]
    flat += [(label, False, t) for label, ts in more.items() for t in ts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([t for _, _, t in flat])
        for batch, texts in runs(batches):
            out: list[list] = [[] for _ in range(9)]
            for text in texts:
                words = words_of(text)
                found = list(automaton.matches(words)) if words else []
                starts = [i for k, i, _ in found if flat[k][1]]
                inside = {x for _, i, j in found for x in range(i, j)}
                spans = [{"label": flat[k][0], "first": i, "stop": j} for k, i, j in found]
                row = (
                    len(words), len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({flat[k][0] for k, _, _ in found if flat[k][1]})),
                    ",".join(sorted({flat[k][0] for k, _, _ in found})),
                    len(inside) / len(words) if words else 0.0, bool(found), spans,
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_(), span]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), *arrays], names=NAMES)

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, licensed boolean, spans array<struct<label string, first long, stop long>>"
)
NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "licensed", "spans"]
