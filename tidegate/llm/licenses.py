"""License scan by template markup.

A template is wording with ``<<beginOptional>> ... <<endOptional>>`` regions, which a text may
leave out, and ``<<var;words=a-b>>`` regions, which any a to b words may stand for. All templates are
compiled into one automaton over words; a text is accepted where its words run through a
template's mandatory wording exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame

from tidegate.llm.common import map_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices and grants of public licenses, as templates.
TEMPLATES = {
    "apache-2.0": "licensed under <<beginOptional>>the<<endOptional>> apache license"
    " <<beginOptional>>version<<endOptional>> 2.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>>"
    " <<beginOptional>>creative commons<<endOptional>> cc by nc 4.0",
    "gpl-3.0": "<<beginOptional>>this <<var;words=1-3>> is<<endOptional>> licensed under the gnu general public license"
    " <<beginOptional>>as published by the free software foundation<<endOptional>>"
    " <<beginOptional>>either<<endOptional>> version 3"
    " <<beginOptional>>of the license<<endOptional>> <<beginOptional>>or any later version<<endOptional>>",
    "mit": "<<var;words=0-1>> under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "mit-grant": "<<beginOptional>>the mit license <<beginOptional>>mit<<endOptional>><<endOptional>>"
    " <<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;words=1-12>><<endOptional>>"
    " permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction",
    "isc-grant": "permission to use copy modify <<beginOptional>>and or<<endOptional>>"
    " <<beginOptional>>and<<endOptional>> distribute this software for any purpose with or without fee is hereby granted",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "notice": "copyright <<beginOptional>>c<<endOptional>> <<var;words=1-12>> all rights reserved",
}

MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")
ANY = None


@dataclass
class Node:
    """A word, a variable region (``least`` to ``most`` words) or an optional sequence of nodes."""

    word: str | None = None
    least: int = 0
    most: int = 0
    body: list[Node] = field(default_factory=list)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


def parse(template: str) -> list[Node]:
    """The nodes of a template; unbalanced marks are an error."""
    stack: list[list[Node]] = [[]]
    at = 0
    for mark in MARK.finditer(template):
        stack[-1] += [Node(word=w) for w in words_of(template[at : mark.start()])]
        at = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError(f"endOptional without beginOptional: {template}")
            body = stack.pop()
            stack[-1].append(Node(body=body))
        else:
            stack[-1].append(Node(least=int(mark[2]), most=int(mark[3])))
    if len(stack) > 1:
        raise ValueError(f"beginOptional without endOptional: {template}")
    return stack[0] + [Node(word=w) for w in words_of(template[at:])]


def mandatory(nodes: list[Node]) -> int:
    """Words that every accepted text has to hold literally."""
    return sum(node.word is not None for node in nodes)


class Automaton:
    """All templates as one nondeterministic automaton over words, made deterministic as it is used."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.edges: list[list[tuple[str | None, int]]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        self.start = self._state()
        self.weight: dict[str, int] = {}
        for label, template in templates.items():
            nodes = parse(template)
            self.weight[label] = mandatory(nodes)
            if not self.weight[label]:
                raise ValueError(f"template {label} has no mandatory wording")
            entry = self._state()
            self.free[self.start].append(entry)
            self.accepts[self._chain(nodes, entry)] = label
        self.words = {word for out in self.edges for word, _ in out if word is not ANY}
        self.first = self._closure({self.start})
        self.anything_starts = any(word is ANY for state in self.first for word, _ in self.edges[state])
        self.starters = {word for state in self.first for word, _ in self.edges[state]} - {ANY}
        self.steps: dict[tuple[frozenset[int], str | None], frozenset[int]] = {}
        self.labels: dict[frozenset[int], tuple[str, ...]] = {}

    def _state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _chain(self, nodes: list[Node], at: int) -> int:
        for node in nodes:
            if node.word is not None:
                following = self._state()
                self.edges[at].append((node.word, following))
                at = following
            elif node.body:
                end = self._chain(node.body, at)
                self.free[at].append(end)
                at = end
            else:
                end = self._state()
                for used in range(node.most + 1):
                    if used >= node.least:
                        self.free[at].append(end)
                    if used < node.most:
                        following = self._state()
                        self.edges[at].append((ANY, following))
                        at = following
                at = end
        return at

    def _closure(self, states: set[int]) -> frozenset[int]:
        found, open_states = set(states), list(states)
        while open_states:
            for state in self.free[open_states.pop()]:
                if state not in found:
                    found.add(state)
                    open_states.append(state)
        return frozenset(found)

    def step(self, state: frozenset[int], word: str) -> frozenset[int]:
        key = (state, word if word in self.words else ANY)
        if key not in self.steps:
            moved = {to for s in state for label, to in self.edges[s] if label is ANY or label == word}
            self.steps[key] = following = self._closure(moved)
            self.labels[following] = tuple(self.accepts[s] for s in sorted(following) if s in self.accepts)
        return self.steps[key]

    def matches(self, words: list[str]) -> Iterator[tuple[str, int, int]]:
        """(label, start, end) of each accepted stretch of words."""
        for start, word in enumerate(words):
            if word not in self.starters and not self.anything_starts:
                continue
            state = self.first
            for at in range(start, len(words)):
                state = self.step(state, words[at])
                if not state:
                    break
                for label in self.labels[state]:
                    yield label, start, at + 1


@cache
def automaton(templates: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton(dict(templates))


def trimmed(template: str) -> str:
    """The template from its first mandatory word on.

    Optional and variable wording before that never decides whether a text is accepted, and
    without it only a few words can start a match.
    """
    depth = at = 0
    for mark in MARK.finditer(template):
        if depth == 0 and words_of(template[at : mark.start()]):
            break
        depth += {"beginOptional": 1, "endOptional": -1}.get(mark[1], 0)
        at = mark.end()
    return template[at:].strip()


def scan(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: dict[str, str] | None = None
) -> DataFrame:
    """License labels of each text.

    Result: the ``keep`` columns, n_words, n_base (places of the base phrases), first_word and last_word
    (their smallest and largest start), base_labels, labels and score. The score is 1 - 2^-m, m being
    the mandatory words of the longest accepted template; 0 where none is accepted.

    A NULL or empty text has no words and no labels. Repeated rows give repeated results, an empty
    table an empty one. Any length of text is read whole: each start runs at most as far as the
    longest template. Other columns are ignored.
    """
    own = {f"={label}": phrase for phrase, label in BASE.items()}
    own |= {label: trimmed(template) for label, template in (TEMPLATES if templates is None else templates).items()}
    compiled = tuple(own.items())
    kept = df.select(*keep).schema
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + ["n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"]
    )

    def make():
        machine = automaton(compiled)

        def one(value, *kept_values):
            words = words_of(value)
            starts, base, labels, best = [], set(), set(), 0
            for label, start, _ in machine.matches(words):
                if label[0] == "=":
                    starts.append(start)
                    base.add(label[1:])
                labels.add(label.removeprefix("="))
                best = max(best, machine.weight[label])
            first, last = (min(starts), max(starts)) if starts else (None, None)
            score = 1 - 0.5**best
            joined = (",".join(sorted(base)), ",".join(sorted(labels)))
            return (*kept_values, len(words), len(starts), first, last, *joined, score)

        return one

    return map_rows(df, [text, *keep], schema, make)


def pattern(nodes: list[Node]) -> str:
    """The template as a regular expression over words that each end with a space, for the SQL."""
    parts = []
    for node in nodes:
        if node.word is not None:
            parts.append(f"{node.word} ")
        elif node.body:
            parts.append(f"(?:{pattern(node.body)})?")
        else:
            parts.append(f"(?:[^ ]+ ){{{node.least},{node.most}}}")
    return "".join(parts)


def scan_sql() -> str:
    """DuckDB SQL for `scan` over ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places, accepted = [], []
    for phrase, label in BASE.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))
        places.append(
            f"list_transform(list_filter(range(greatest(len(w) - {len(words) - 1}, 0)), lambda i: {same}),"
            f" lambda i: {{'at': i, 'label': '{label}', 'm': {len(words)}}})"
        )
    for label, template in TEMPLATES.items():
        nodes = parse(trimmed(template))
        accepted.append(
            f"CASE WHEN regexp_matches(line, ' {pattern(nodes)}') THEN [{{'label': '{label}', 'm': {mandatory(nodes)}}}]"
            f" ELSE [] END"
        )
    return f"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
found AS (
  SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS line,
         flatten([{", ".join(places)}]) AS p
  FROM cut),
labelled AS (SELECT *, flatten([{", ".join(accepted)}]) AS t FROM found)
SELECT doc_id, n_words, len(p) AS n_base,
       list_min(list_transform(p, lambda x: x.at)) AS first_word, list_max(list_transform(p, lambda x: x.at)) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(
         list_transform(p, lambda x: x.label), list_transform(t, lambda x: x.label)))), ',') AS labels,
       1 - pow(0.5, coalesce(list_max(list_concat(
         list_transform(p, lambda x: x.m), list_transform(t, lambda x: x.m))), 0)) AS score
FROM labelled"""
