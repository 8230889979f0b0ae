"""License scans by template markup compiled into token automata.

A template is a license's wording as words, with optional regions in brackets, which may hold
others, and replaceable regions ``<name:least-most>``, which any words in that number fill. It is
compiled into an automaton whose states follow the wording: an edge for each mandatory word, an
empty edge around an optional region, an edge over any words for a replaceable one. A text is
accepted where the automaton gets from its first state to its last on consecutive words, so the
mandatory wording has to match word by word. A plain phrase is a template without regions.

Words are runs of ASCII letters and figures and of characters beyond ASCII, A-Z as a-z. The words
of many texts are looked up in the templates' vocabulary at once; an automaton runs, for all its
starts together, over those texts that hold all its mandatory words.

Places of a phrase are all its places; of a template the leftmost ones, each as long as possible,
that don't overlap. ``score`` is the largest share n / (n + 1) of the matched templates and phrases,
n being their mandatory words: the more wording stands there exactly, the surer.

Defined cases: null and empty texts have no words and no places; null and repeated ids are rows as
others; other columns are ignored; an empty table gives no rows. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import ship
from .terms import find, hash_of, ranges, terms

# The phrases that give a base label.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# The wording of public licenses, notices and grants.
TEMPLATES = (
    ("mit-grant", "<verb:1-1> under [the terms of] the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights to "
     "use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
     "software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
     "[including the next paragraph] shall be included in all copies or substantial portions of the software"),
    ("apache-2.0-grant", "licensed under the apache license version 2 0"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this <work:1-4> except in "
     "compliance with the license you may obtain a copy of the license at [http] [https] [www] apache org licenses license 2 0"),
    ("gpl-grant", "licensed under the [gnu [affero] [lesser]] general public license [version <number:1-2>]"),
    ("gpl-notice", "this <work:1-4> is free software you can redistribute it and or modify it under the terms of the gnu [affero] "
     "[lesser] general public license as published by the free software foundation either version <number:1-2> of the license or "
     "at your option any later version"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met [1] redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer [2] redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
     "[[3] neither the name of <holder:1-12> nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission]"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-grant", "licensed under [a] [the] cc by nc <number:1-2>"),
    ("cc-by-grant", "licensed under [a] [the] creative commons attribution <kind:0-4> <number:1-2> [international] license"),
)
SCHEMA = "doc_id long, n_words long, places array<struct<label:string,base:boolean,first:long,last:long,words:int>>"


def tree(markup: str) -> list:
    """The markup as a list of words, (least, most) of replaceable regions and lists of optional regions."""
    out: list[list] = [[]]
    for part in re.findall(r"\[|\]|<[^>]*>|[^\s\[\]<>]+", markup):
        if part == "[":
            out.append([])
        elif part == "]":
            if len(out) < 2 or not out[-1]:
                raise ValueError(f"empty or unopened region: {markup}")
            out[-2].append(out.pop())
        elif part[0] == "<":
            low, high = map(int, re.fullmatch(r"<\w+:(\d+)-(\d+)>", part).groups())
            out[-1].append((low, high))
        else:
            out[-1].append(part)
    if len(out) > 1:
        raise ValueError(f"unclosed region: {markup}")
    return out[0]


@dataclass(frozen=True)
class Edge:
    """From one state to a later one over a word's number, or over ``least`` to ``most`` words of any kind."""

    start: int
    end: int
    word: int = 0
    least: int = 0
    most: int = 0


class Automaton:
    def __init__(self, label: str, markup: str, base: bool, numbers: dict[str, int]):
        self.label, self.base = label, base
        self.edges: list[Edge] = []
        self.mandatory: list[int] = []
        self.last = self._grow(tree(markup), 0, numbers, True)
        if not self.mandatory:
            raise ValueError(f"no mandatory word: {markup}")

    def _grow(self, parts: list, state: int, numbers: dict[str, int], must: bool) -> int:
        for part in parts:
            if isinstance(part, str):
                edge = Edge(state, state + 1, word=numbers[part])
                self.mandatory += [edge.word] if must else []
            elif isinstance(part, tuple):
                edge = Edge(state, state + 1, least=part[0], most=part[1])
            else:
                edge = Edge(state, self._grow(part, state, numbers, False))
            self.edges.append(edge)
            state = edge.end
        return state

    def places(self, words: np.ndarray, at: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of each accepted run in ``texts``; a start has its longest run only.

        Pairs (start, position) go from state to state; edges lead to later states only, so each
        state is left once, with all its pairs.
        """
        first = ranges(at[texts], at[texts + 1] - at[texts])
        limit = np.zeros(len(words) + 1, np.int64)
        limit[first] = np.repeat(at[texts + 1], at[texts + 1] - at[texts])
        reached: dict[int, list] = {0: [(first, first)]}
        for state in range(self.last):
            start, pos = merged(reached.pop(state, []))
            if not len(start):
                continue
            for edge in (e for e in self.edges if e.start == state):
                if edge.word:
                    on = pos < limit[start]
                    on[on] = words[pos[on]] == edge.word
                    moves = [(start[on], pos[on] + 1)]
                else:
                    moves = [(start[on], pos[on] + k) for k in range(edge.least, edge.most + 1) if (on := pos + k <= limit[start]).any()]
                reached.setdefault(edge.end, []).extend(moves)
        start, end = merged(reached.get(self.last, []))
        longest = np.append(start[1:] != start[:-1], True)[:len(start)]
        return start[longest], end[longest] - 1


def merged(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order."""
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.concatenate([a << 32 | b for a, b in pairs])
    key = key if len(pairs) == 1 else np.unique(key)
    return key >> 32, key & 0xFFFFFFFF


def apart(first: np.ndarray, last: np.ndarray) -> list[int]:
    """The leftmost runs that don't overlap."""
    out, free = [], -1
    for k in range(len(first)):
        if first[k] >= free:
            out.append(k)
            free = last[k] + 1
    return out


class Scanner:
    """All automata over one vocabulary."""

    def __init__(self, phrases: Iterable[tuple[str, str]], templates: Iterable[tuple[str, str]]):
        rows = [(label, markup, True) for label, markup in phrases] + [(label, markup, False) for label, markup in templates]
        vocabulary = sorted({w for _, m, _ in rows for w in re.findall(r"[^\s\[\]<>]+(?![^<]*>)", m)})
        hashes = np.array([hash_of(w) for w in vocabulary], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        numbers = {vocabulary[k]: place + 1 for place, k in enumerate(order)}
        self.automata = [Automaton(*row, numbers) for row in rows]

    def scan(self, w: kernel.Words) -> list[tuple[int, dict]]:
        """Text and place of every accepted run; words are counted from the text's first."""
        words = find(self.hashes, w.hashes) + 1
        n = len(w.at) - 1
        held = np.zeros((n, len(self.hashes) + 1), bool)
        held[np.repeat(np.arange(n), np.diff(w.at)), words] = True
        out = []
        for a in self.automata:
            texts = np.flatnonzero(held[:, a.mandatory].all(axis=1))
            if not len(texts):
                continue
            first, last = a.places(words, w.at, texts)
            for k in range(len(first)) if a.base else apart(first, last):
                text = int(np.searchsorted(w.at, first[k], "right")) - 1
                base = int(w.at[text])
                out.append((text, {"label": a.label, "base": a.base, "first": int(first[k]) - base, "last": int(last[k]) - base,
                                   "words": len(a.mandatory)}))
        return out


def license_scan(docs: DataFrame, phrases: Iterable[tuple[str, str]] = PHRASES,
                 templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, places``: every place of a phrase or template, with the first and last word of its run."""
    ship(docs.sparkSession)
    scanner = Scanner(phrases, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()),
                                   ("words", pa.int32())]))
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                w = terms(raw, offs)
                rows: list[list] = [[] for _ in range(hi - lo)]
                for text, place in scanner.scan(w):
                    rows[text].append(place)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(w.at), pa.int64()),
                                                  pa.array(rows, kind)], names=["doc_id", "n_words", "places"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """Places as counts, labels and a score; labels are distinct, sorted and joined by commas."""
    base = F.filter("places", lambda p: p["base"])
    firsts = F.transform(base, lambda p: p["first"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    score = F.array_max(F.transform("places", lambda p: p["words"] / (p["words"] + 1)))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"))


def pattern(markup: str) -> str:
    """The markup as a regular expression over words that each stand between blanks of their own."""
    def text(parts: list) -> str:
        return "".join(f" {p} " if isinstance(p, str) else f"(?: [^ ]+ ){{{p[0]},{p[1]}}}" if isinstance(p, tuple)
                       else f"(?:{text(p)})?" for p in parts)

    return text(tree(markup))


def mandatory_words(markup: str) -> int:
    return sum(isinstance(p, str) for p in tree(markup))
