"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

Terms are pairs of neighbouring words (ASCII case folded, punctuation at word ends taken
off); a one-word item is a pair with itself. Items of more than ``SEGMENT`` words are indexed
as segments of at most that many. A posting holds the term's BM25 weight divided by the
segment's score with itself, so a score of 1 means that the whole segment is there and one
threshold fits short and long items. Lists are kept by segment number in blocks with a
maximum each.

Every passage (``WINDOW`` words, each ``STRIDE`` words) of every text is a query. Passages
whose terms' largest weights don't add up to the threshold can't reach it and are passed over
with running sums; the others are searched with WAND: the pivot is the first list where the
upper bounds reach the threshold, and the bounds of the current blocks decide whether it is
scored or skipped. All segments at or over the threshold are retrieved, then verified, the
highest scores first until one passes: question and answer (an item's last line or sentence,
else its last third) have to be covered by the passage's pairs.

The index is broadcast in parts of at most ``PART_WORDS`` words, one pass over the documents
for each, so it is bounded however many items there are.

Defined cases: null and empty texts and items match nothing; repeated rows and items are
matched each (ties all count); null ids are kept; extra columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import ship

K1, B = 1.2, 0.75
THRESHOLD = 0.5
QUESTION, ANSWER = 0.6, 0.5
SEGMENT = 64
WINDOW, STRIDE = 96, 32
BLOCK = 64
STRIP = 4
PART_WORDS = 2_000_000


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    text = text.strip()
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    ends = [m.end() for m in re.finditer(r"[.!?]\s+(?=\S)", text)]
    if ends:
        return text[:ends[-1]], text[ends[-1]:]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return kernel.words(data, np.array([0, len(data)], np.int64), STRIP).hashes


def pairs(h: np.ndarray) -> np.ndarray:
    return kernel.fold(np.repeat(h, 2) if len(h) == 1 else h, 2)


@dataclass
class Index:
    """Terms sorted by hash; of term k the postings ``first[k]:first[k + 1]`` by segment number."""

    terms: np.ndarray
    first: np.ndarray
    segments: np.ndarray
    weights: np.ndarray
    tops: np.ndarray           # a term's largest weight
    blocks: list[np.ndarray]   # a term's largest weight in each block of its postings
    item: np.ndarray           # segment -> item
    questions: list[np.ndarray]
    answers: list[np.ndarray]


def build(items: list[tuple[int, str]]) -> Index:
    """The index of one part of the items."""
    owner, bags, questions, answers = [], [], [], []
    for k, (_, text) in enumerate(items):
        h = word_hashes(text)
        whole, cut = pairs(h), max(0, len(word_hashes(split_item(text)[0])) - 1)
        questions.append(np.unique(whole[:cut]))
        answers.append(np.unique(whole[cut:]))  # with the pair across the border, so one word suffices
        parts = max(1, -(-len(h) // SEGMENT))
        for part in np.array_split(h, parts):
            if len(part):
                owner.append(k)
                bags.append(pairs(part))
    mean = np.mean([len(b) for b in bags]) if bags else 1.0
    found: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for s, bag in enumerate(bags):
        for t, n in zip(*np.unique(bag, return_counts=True), strict=True):
            found[int(t)].append((s, n * (K1 + 1) / (n + K1 * (1 - B + B * len(bag) / mean))))
    own = np.zeros(len(bags))
    for rows in found.values():
        idf = log(1 + (len(bags) - len(rows) + 0.5) / (len(rows) + 0.5))
        rows[:] = [(s, idf * x) for s, x in rows]
        for s, x in rows:
            own[s] += x
    terms = sorted(found)
    lists = [found[t] for t in terms]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    segments = np.array([s for x in lists for s, _ in x], np.int64)
    weights = np.array([w / own[s] for x in lists for s, w in x])
    cut = [weights[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    return Index(np.array(terms, np.uint64), first, segments, weights, np.array([c.max() for c in cut]),
                 [np.maximum.reduceat(c, np.arange(0, len(c), BLOCK)) for c in cut], np.array(owner, np.int64),
                 questions, answers)


def wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """Segments scoring at least ``threshold`` for a query of different terms (their places in the index)."""
    least = threshold - 1e-9
    at = {int(t): int(index.first[t]) for t in terms}
    end = {t: int(index.first[t + 1]) for t in at}
    out = []
    while at:
        order = sorted(at, key=lambda t: index.segments[at[t]])
        total, pivot = 0.0, None
        for t in order:
            total += index.tops[t]
            if total >= least:
                pivot = int(index.segments[at[t]])
                break
        if pivot is None:
            break
        ahead = [t for t in order if index.segments[at[t]] <= pivot]
        # bounds of the blocks that would hold the pivot
        bound, limits = 0.0, []
        for t in ahead:
            a, b = int(index.first[t]), end[t]
            k = a + int(np.searchsorted(index.segments[a:b], pivot))
            if k < b:
                block = (k - a) // BLOCK
                bound += index.blocks[t][block]
                limits.append(int(index.segments[min(b, a + (block + 1) * BLOCK) - 1]))
        if bound >= least:
            score = 0.0
            for t in ahead:
                k = at[t] + int(np.searchsorted(index.segments[at[t]:end[t]], pivot))
                if k < end[t] and index.segments[k] == pivot:
                    score += index.weights[k]
            if score >= least:
                out.append((pivot, score))
            goal = pivot + 1
        else:
            # nothing before the nearest end of these blocks, or the next list, can reach the threshold
            rest = [int(index.segments[at[t]]) for t in order if index.segments[at[t]] > pivot]
            goal = max(pivot + 1, min([x + 1 for x in limits] + rest[:1], default=pivot + 1))
        for t in ahead:
            at[t] += int(np.searchsorted(index.segments[at[t]:end[t]], goal))
            if at[t] >= end[t]:
                del at[t]
    return out


def covered(part: np.ndarray, there: np.ndarray) -> float:
    """The share of a part's pairs that are there; 1 for a part without pairs."""
    return float(np.isin(part, there).mean()) if len(part) else 1.0


def matches(index: Index, w: kernel.Words, threshold: float, question: float, answer: float) -> Iterator[tuple]:
    """Text, item, score, overlaps and first word of the best passage that passes, for each item found in a text."""
    if not len(w.hashes) or not len(index.terms):
        return
    term = np.empty(len(w.hashes), np.uint64)
    term[:-1] = kernel.fold(w.hashes, 2)
    count = np.diff(w.at)
    lasts = w.at[1:][count > 0] - 1
    term[lasts] = 0  # a text's last word starts no pair
    single = w.at[:-1][count == 1]
    if len(single):
        term[single] = kernel.fold(np.repeat(w.hashes[single], 2), 2)[::2]
    place = np.minimum(np.searchsorted(index.terms, term), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[place] == term)
    if not len(hit):
        return
    place = place[hit]
    docs = np.searchsorted(w.at, hit, "right") - 1
    for d in np.unique(docs):
        rows = slice(*np.searchsorted(docs, [d, d + 1]))
        words, terms = hit[rows] - w.at[d], place[rows]
        sums = np.concatenate([[0.0], np.cumsum(index.tops[terms])])
        if sums[-1] < threshold - 1e-9:
            continue
        starts = np.arange(0, max(1, int(count[d]) - WINDOW + STRIDE), STRIDE)
        lo, hi = np.searchsorted(words, starts), np.searchsorted(words, starts + WINDOW)
        met: dict[int, set] = defaultdict(set)
        for k in np.flatnonzero(sums[hi] - sums[lo] >= threshold - 1e-9):
            for segment, score in wand(index, np.unique(terms[lo[k]:hi[k]]), threshold):
                met[int(index.item[segment])].add((-score, int(starts[k])))
        for item, passages in met.items():
            # an item longer than a passage may reach beyond it on either side
            reach = len(index.questions[item]) + len(index.answers[item])
            for score, start in sorted(passages):
                a = int(w.at[d]) + max(0, start - reach)
                there = term[a:min(int(w.at[d + 1]), int(w.at[d]) + start + WINDOW + reach)]
                q, r = covered(index.questions[item], there), covered(index.answers[item], there)
                if q >= question and r >= answer:
                    yield int(d), item, -score, q, r, start
                    break


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION,
                  answer: float = ANSWER, part_words: int = PART_WORDS) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, first_word``: a row for each item in a document."""
    spark = ship(docs.sparkSession)
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
    parts: list[list[tuple[int, str]]] = [[]]
    room = part_words
    for r in items.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():  # one part in memory at a time
        words = len(r["text"].split())
        if parts[-1] and words > room:
            parts.append([])
            room = part_words
        parts[-1].append((r["item_id"], r["text"]))
        room -= words

    def search(own: list[tuple[int, str]]) -> DataFrame:
        held = spark.sparkContext.broadcast((build(own), [i for i, _ in own]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, ids = held.value
            for batch in batches:
                for lo, _, raw, offs in kernel.chunks(batch.column(1)):
                    rows = list(matches(index, kernel.words(raw, offs, STRIP), threshold, question, answer))
                    if rows:
                        d, item, *rest = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([lo + x for x in d])), pa.array([ids[k] for k in item], pa.int64()),
                             *(pa.array(c, pa.float64()) for c in rest[:3]), pa.array(rest[3], pa.int64())], names=names)

        return docs.select("doc_id", "text").mapInArrow(
            run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long")

    return reduce(DataFrame.union, map(search, parts))
