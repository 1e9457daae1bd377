"""License scan: template markup compiled to token automata, beside plain phrase counts.

Markup. A template is license wording with ``<<beginOptional>> ... <<endOptional>>`` around words that may
be missing (nested if need be) and ``<<var;name=...;words=a-b>>`` for ``a`` to ``b`` words of any kind.
Words are lower-cased letters and digits, so case, punctuation and line breaks do not matter; all other
wording is mandatory and must stand word for word.

Automaton. A template becomes an automaton over word hashes: one arc per mandatory word, arcs around
optional parts, arcs that take any word for replaceable parts. Its first two words are mandatory words on
every way, so the vectorised search for those pairs finds each place where it can start; from there it is
run word by word, and the longest accepted run counts.

Defined cases: null and empty text have no words, no labels and score 0; overlapping places of several
templates all count; repeated rows give equal rows; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusflow.llm import arrays as A
from corpusflow.llm.decontaminate import words

#: fixed values: phrases and their labels
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: fixed values: public license wording
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0"),
    ("gpl-2.0", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License"
                "<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 2"),
    ("gpl-3.0", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License"
                "<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 3"),
    ("gpl-notice", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
                   " by the Free Software Foundation<<beginOptional>>; either<<endOptional>> version <<var;name=version;words=1-2>>"
                   " of the License<<beginOptional>>, or (at your option) any later version<<endOptional>>"),
    ("lgpl", "GNU Lesser General Public License<<beginOptional>>, version <<var;name=version;words=1-2>><<endOptional>>"),
    ("agpl", "GNU Affero General Public License<<beginOptional>>, version <<var;name=version;words=1-2>><<endOptional>>"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, <<var;name=v;words=1-1>> 2.0"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a <<endOptional>>CC BY<<beginOptional>> International<<endOptional>> 4.0"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>>a <<endOptional>>CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>a <<endOptional>>CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "licensed under <<beginOptional>>a <<endOptional>>CC BY-ND 4.0"),
    ("cc0-1.0", "licensed under <<beginOptional>>a <<endOptional>>CC0 1.0<<beginOptional>> Universal<<endOptional>>"),
    ("cc-attribution", "Creative Commons Attribution<<beginOptional>>-<<var;name=terms;words=1-3>><<endOptional>>"
                       " <<var;name=version;words=2-2>> International License"),
    ("mit-notice", "Released under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name=work;words=1-8>>"
                 " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to"
                 " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
                 " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
                 " notice and this permission notice<<beginOptional>> (including the next paragraph)<<endOptional>> shall be"
                 " included in all copies or substantial portions of the Software"),
    ("isc-text", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any"
                 " purpose with or without fee is hereby granted, provided that the above copyright notice and this permission"
                 " notice appear in all copies"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met<<beginOptional>>: <<var;name=bullet;words=0-1>> Redistributions of source code must"
            " retain the above copyright notice, this list of conditions and the following disclaimer<<endOptional>>"),
    ("all-rights-reserved", "All rights reserved"),
)

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def parse(markup: str) -> list:
    """Words, ``("var", least, most)`` and ``("optional", parts)`` of a template."""
    stack: list[list] = [[]]
    at = 0
    for m in [*_MARK.finditer(markup), None]:
        stack[-1] += _WORD.findall(markup[at:m.start() if m else None].translate(_LOWER))
        if m is None:
            break
        at, tag = m.end(), m[1]
        if tag == "beginOptional":
            stack.append([])
        elif tag == "endOptional":
            part = stack.pop()
            if not stack:
                raise ValueError("endOptional without beginOptional")
            stack[-1].append(("optional", part))
        else:
            span = re.search(r"words=(\d+)-(\d+)", tag)
            if not span:
                raise ValueError(f"a replaceable part needs words=least-most: {tag}")
            stack[-1].append(("var", int(span[1]), int(span[2])))
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


class TokenAutomaton:
    """Arcs of one template: ``on[state]`` by word, ``other[state]`` for any word, ``free[state]`` without a word."""

    def __init__(self, markup: str):
        self.on: list[dict[str, int]] = [{}]
        self.other: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        self.accept = self._add(parse(markup), 0)

    def _state(self) -> int:
        self.on.append({})
        self.other.append(None)
        self.free.append([])
        return len(self.on) - 1

    def _add(self, parts: list, at: int) -> int:
        for p in parts:
            start = at
            if isinstance(p, str):
                at = self._state()
                self.on[start][p] = at
            elif p[0] == "optional":
                inner = self._state()
                self.free[start].append(inner)
                end = self._add(p[1], inner)
                at = self._state()
                self.free[end].append(at)
                self.free[start].append(at)
            else:
                steps = [start]
                for _ in range(p[2]):
                    steps.append(self._state())
                    self.other[steps[-2]] = steps[-1]
                at = self._state()
                for s in steps[p[1]:]:
                    self.free[s].append(at)
        return at

    def closed(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return frozenset(out)

    def step(self, states: frozenset[int], word) -> frozenset[int]:
        to = {self.on[s][word] for s in states if word in self.on[s]} | {self.other[s] for s in states if self.other[s] is not None}
        return self.closed(to) if to else frozenset()

    def first_pairs(self) -> set[tuple[str, str]]:
        out, start = set(), self.closed([0])
        if self.accept in start or any(self.other[s] is not None for s in start):
            raise ValueError("a template must begin with two mandatory words")
        for a in {w for s in start for w in self.on[s]}:
            then = self.step(start, a)
            if self.accept in then or any(self.other[s] is not None for s in then):
                raise ValueError("a template must begin with two mandatory words")
            out |= {(a, b) for s in then for b in self.on[s]}
        return out

    def hashed(self) -> "TokenAutomaton":
        """The same automaton over word hashes."""
        for s, arcs in enumerate(self.on):
            if arcs:
                self.on[s] = dict(zip(A.hash_words(list(arcs)).tolist(), arcs.values()))
        return self

    def longest(self, h: list) -> int:
        """Number of words of the longest accepted run at the beginning of ``h``; 0 for none."""
        states, best = self.closed([0]), 0
        for n, w in enumerate(h, 1):
            states = self.step(states, w)
            if not states:
                break
            if self.accept in states:
                best = n
        return best


class Scanner:
    """All templates and phrases, ready for columns of text."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.labels = [label for label, _ in templates]
        autos = [TokenAutomaton(m) for _, m in templates]
        pairs: dict[int, list[int]] = {}
        for i, a in enumerate(autos):
            for w in a.first_pairs():
                pairs.setdefault(int(A.window_hashes(A.hash_words(list(w)), 2)[0]), []).append(i)
        self.pairs, self.starts = pairs, np.array(sorted(pairs), dtype=np.uint64)
        self.autos = [a.hashed() for a in autos]
        self.phrases = [(A.hash_words(p.split()), label) for p, label in phrases]

    def column(self, col: pa.Array):
        """Word counts, base places (document, first word, label) and template places (document, from, to, label)."""
        _, _, _, _, doc, h = words(col)
        n_words = np.bincount(doc, minlength=len(col))
        first = np.cumsum(n_words) - n_words
        base = []
        for p, label in self.phrases:
            at = np.flatnonzero(h[:max(len(h) - len(p) + 1, 0)] == p[0])
            for j in range(1, len(p)):
                at = at[h[at + j] == p[j]]
            at = at[doc[at] == doc[at + len(p) - 1]]
            base += [(int(doc[i]), int(i - first[doc[i]]), label) for i in at]
        places = []
        two = A.window_hashes(h, 2)
        i = np.minimum(np.searchsorted(self.starts, two), max(len(self.starts) - 1, 0))
        hit = np.flatnonzero((self.starts[i] == two) & A.whole_windows(doc, 2)) if len(self.starts) and len(two) else []
        for at in hit:
            d = int(doc[at])
            rest = h[at:first[d] + n_words[d]]
            for k in self.pairs[int(two[at])]:
                limit = len(self.autos[k].on)  # an automaton takes fewer words than it has states
                n = self.autos[k].longest(rest[:limit].tolist())
                if n:
                    places.append((d, int(at - first[d]), int(at - first[d]) + n, self.labels[k]))
        return n_words, base, places


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``score`` is 1 for a document that a template accepts, else one half for one with a base phrase, else 0.
    ``places`` lists the accepted runs as (label, from, to) in words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, places array<struct<label:string,from:long,to:long>>")

    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for rb in A.slices(batch, "text"):
                n_words, base, places = scanner.column(rb.column("text"))
                n = rb.num_rows
                at: list[list[int]] = [[] for _ in range(n)]
                base_of: list[set] = [set() for _ in range(n)]
                own: list[list] = [[] for _ in range(n)]
                for d, w, label in base:
                    at[d].append(w)
                    base_of[d].add(label)
                for d, a, b, label in places:
                    own[d].append({"label": label, "from": a, "to": b})
                new = [pa.array(n_words.astype(np.int64)), pa.array([len(x) for x in at], pa.int64()),
                       pa.array([min(x) if x else None for x in at], pa.int64()),
                       pa.array([max(x) if x else None for x in at], pa.int64()),
                       pa.array([",".join(sorted(x)) for x in base_of], pa.string()),
                       pa.array([",".join(sorted(x | {p["label"] for p in o})) for x, o in zip(base_of, own)], pa.string()),
                       pa.array([1.0 if o else 0.5 if x else 0.0 for x, o in zip(base_of, own)], pa.float64()),
                       pa.array(own, pa.list_(pa.struct([("label", pa.string()), ("from", pa.int64()), ("to", pa.int64())])))]
                yield pa.RecordBatch.from_arrays([rb.column("id"), *new], names=[
                    "id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    part = docs.selectExpr(f"`{id_col}` AS id", f"CAST(`{text}` AS STRING) AS text")
    return part.mapInArrow(run, schema).withColumnRenamed("id", id_col)
