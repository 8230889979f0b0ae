"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

Learning, from labelled rows outside the held-out fifth only, at most ``MOST_LABELLED`` of
them, one text an id: words of any form and length, and word beginnings of 4 to 6 letters, are counted in toxic and other documents
(near copies, told by three min-hashes, count once) and kept where nearly all their documents
are toxic, and too many for chance (binomial probability up to ``CHANCE``). The terms form a
trie.

Scoring: every distinct token of a run of texts is judged once. It is split and folded as in
learning (case, outer marks, figures used as letters), then looked up as a term, as a beginning, and, if half of a term
stands at one of its ends, by walking the trie with the Levenshtein automaton of the token:
both advance together, so only beginnings within the distance are visited. Each hit is weighed
by its term's log-odds and split by its window of neighbouring words: quotation marks and
verbs of reporting move weight from abuse to quotation. A logistic model over the sums,
fitted on the sample, gives the score.

Inputs of a score are the text alone. Defined cases: null and empty texts score as a text
without hits; null ids are kept, never held out and never learned from; repeated rows are
scored each; extra columns are ignored; an empty table gives no rows; without labels of both
kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import held_out, labelled_sample, ship, stage

MOST_LABELLED = 20_000
MIN_DOCS = 3
PRECISION = 0.8
CHANCE = 1e-5
STEMS = (4, 5, 6)
FUZZY_LETTERS = 5
DISTANCE = 1
WINDOW = 6
SEEN = 1 << 18
#: Figures and signs that stand for letters.
LEET = str.maketrans("01345789@$!€", "oieastbgasie")
#: Marks and words that show a quotation nearby.
QUOTES = re.compile(r"[\"“”„«»‘’]")
REPORTS = frozenset("said says say quoted quote wrote writes called calls reported told dit disait écrit cité sagte sagt "
                    "schrieb zitierte nannte dijo dice escribió citó llamó".split())
#: The splitter of the kernel, for learning.
SPACE = re.compile(r"[\x20\x09-\x0D]+")
BEFORE, AFTER = re.compile(r"[^\w@$€]+"), re.compile(r"[\W_]+")
FEATURES = ("strongest", "abuse", "quotation", "misspelled", "beginnings", "density", "terms")


def form(token: str) -> str:
    """A token without case and outer marks, figures and signs inside read as letters; for learning and scoring."""
    word = token.lower()
    if lead := BEFORE.match(word):
        word = word[lead.end():]
    if tail := AFTER.match(word[::-1]):
        word = word[:-tail.end()]
    return word if word.isalpha() else word.translate(LEET)


@dataclass
class Lexicon:
    """Terms with weights; ``fuzzy`` is the trie of the terms that may be misspelled."""

    terms: dict[str, float]
    stems: dict[str, float]
    fuzzy: dict = field(default_factory=dict)
    heads: set[str] = field(default_factory=set)
    tails: set[str] = field(default_factory=set)

    def __post_init__(self):
        for term in self.terms:
            if len(term) < FUZZY_LETTERS:
                continue
            node = self.fuzzy
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term
            self.heads.add(term[:len(term) // 2])
            self.tails.add(term[len(term) // 2:])
        self.sizes = sorted({len(x) for x in self.heads | self.tails})

    def __reduce__(self):
        return Lexicon, (self.terms, self.stems)  # the trie is built anew where it is needed: it may be deep

    def near(self, word: str) -> str | None:
        """The term within DISTANCE edits; of several the heaviest, then the first in order."""
        found = automaton_walk(self.fuzzy, word, DISTANCE)
        return min(found, key=lambda t: (-self.terms[t], t), default=None)

    def judge(self, token: str) -> tuple[str, str, float] | None:
        """Kind, term and weight of a token."""
        word = form(token)
        if word in self.terms:
            return "term", word, self.terms[word]
        for k in STEMS:
            if len(word) > k and word[:k] in self.stems:
                return "stem", word[:k], self.stems[word[:k]]
        if len(word) >= FUZZY_LETTERS and any(word[:k] in self.heads or word[-k:] in self.tails for k in self.sizes):
            near = self.near(word)
            if near is not None:
                return "near", near, self.terms[near]
        return None


def automaton_walk(trie: dict, word: str, most: int) -> list[str]:
    """The trie's terms within ``most`` edits of ``word``: automaton and trie advance together.

    A state (i, e) has read i letters of the word at the cost of e edits.
    """
    out, todo = [], [(trie, {0: 0})]
    while todo:
        node, states = todo.pop()
        for c, child in node.items():
            if c == "":
                if any(len(word) - i + e <= most for i, e in states.items()):
                    out.append(child)
                continue
            new: dict[int, int] = {}
            for i, e in states.items():
                if e < most:
                    for j, cost in ((i + 1, e + 1), (i, e + 1)):  # another letter here, or one too few in the word
                        if j <= len(word) and cost < new.get(j, most + 1):
                            new[j] = cost
                for skip in range(min(most - e, len(word) - i - 1) + 1):  # letters too many in the word
                    if word[i + skip] == c:
                        if e + skip < new.get(i + skip + 1, most + 1):
                            new[i + skip + 1] = e + skip
                        break
            if new:
                todo.append((child, new))
    return out


class Scorer:
    """Feature sums of texts; remembers the judgement of tokens it has seen."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.codes: dict[int, int] = {}
        self.hits: list[tuple[str, str, float]] = [("", "", 0.0)]

    def features(self, w: kernel.Words) -> np.ndarray:
        docs = len(w.at) - 1
        out = np.zeros((docs, len(FEATURES)))
        if not len(w.hashes):
            return out
        own, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        if len(self.codes) > SEEN:
            self.codes.clear()
        code = np.zeros(len(own), np.int64)
        for k, h in enumerate(own.tolist()):
            c = self.codes.get(h)
            if c is None:
                c, hit = 0, self.lexicon.judge(w.text(first[k]))
                if hit:
                    c = len(self.hits)
                    self.hits.append(hit)
                self.codes[h] = c
            code[k] = c
        at = np.flatnonzero(code[back])
        found: dict[int, list] = defaultdict(list)
        for p, d in zip(at.tolist(), (np.searchsorted(w.at, at, "right") - 1).tolist(), strict=True):
            found[d].append((p, self.hits[code[back[p]]]))
        for d, rows in found.items():
            lo, hi = int(w.at[d]), int(w.at[d + 1])
            sums = dict.fromkeys(FEATURES, 0.0)
            for p, (kind, _, weight) in rows:
                around = [w.text(k) for k in range(max(lo, p - WINDOW), min(hi, p + WINDOW + 1))]
                marks = sum(len(QUOTES.findall(x)) for x in around) + sum(x.strip(".,:;") in REPORTS for x in around)
                quoted = min(1.0, marks / 2)
                sums["quotation"] += weight * quoted
                weight *= 1 - 0.5 * quoted
                sums[{"term": "abuse", "near": "misspelled", "stem": "beginnings"}[kind]] += weight
                if kind != "near":
                    sums["strongest"] = max(sums["strongest"], weight)
            sums["density"] = len(rows) / (hi - lo)
            sums["terms"] = len({hit[:2] for _, hit in rows})
            out[d] = [np.log1p(sums[f]) if f not in ("strongest", "density") else sums[f] for f in FEATURES]
        return out


def term_counts(rows: DataFrame) -> DataFrame:
    """``term, stem, toxic, other``: documents that hold a word or beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = {form(t) for t in set(SPACE.split(text or ""))} - {""}
                found = {(x, False) for x in words} | {(x[:k], True) for x in words for k in STEMS if len(x) > k}
                for key in found:
                    sums[key][1 - y] += 1
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
             *(pa.array([sums[k][i] for k in keys], pa.int64()) for i in range(2))],
            names=["term", "stem", "toxic", "other"])

    return (rows.select("text", "y").mapInArrow(run, "term string, stem boolean, toxic long, other long")
            .groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def lexicon(rows: list, n_toxic: int, n_other: int) -> Lexicon:
    """The terms that tell toxic documents, with smoothed log-odds as weights."""
    terms, stems, share = {}, {}, n_toxic / (n_toxic + n_other)
    for r in rows:
        a, b = r["toxic"], r["other"]
        chance = lgamma(a + b + 1) - lgamma(a + 1) - lgamma(b + 1) + a * log(share) + b * log(1 - share)
        if a < MIN_DOCS or a < PRECISION * (a + b) or chance > log(CHANCE):
            continue
        weight = log((a + 0.5) / (n_toxic + 1)) - log((b + 0.5) / (n_other + 1))
        (stems if r["stem"] else terms)[r["term"]] = round(min(weight, 8.0), 4)
    # a beginning needs several words; else it is one term's own
    own = {r["term"]: r["toxic"] for r in rows if not r["stem"]}
    single: dict[str, int] = defaultdict(int)
    for t, a in own.items():
        for k in STEMS:
            if len(t) > k:
                single[t[:k]] = max(single[t[:k]], a)
    docs = {r["term"]: r["toxic"] for r in rows if r["stem"]}
    return Lexicon(terms, {s: w for s, w in stems.items() if docs[s] > single[s]})


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def min_hashes(docs: DataFrame) -> DataFrame:
    """``doc_id, y, h0, h1, h2``: three min-hashes of a text's five-word shingles."""
    salts = [np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                sets = list(kernel.shingle_sets(kernel.words(raw, offs), 5))
                cols = [pa.array([int(kernel.mix(s ^ k).min().view(np.int64)) if len(s) else 0 for s in sets], pa.int64())
                        for k in salts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), *cols],
                    names=["doc_id", "y", "h0", "h1", "h2"])

    return docs.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, h0 long, h1 long, h2 long")


def first_copies(rows: list) -> dict[int, int]:
    """The smallest id of each group that shares a min-hash, and its label (of a bounded sample)."""
    seen: set[tuple[int, int]] = set()
    out: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        keys = {(k, r[f"h{k}"]) for k in range(3) if r[f"h{k}"]}
        if not keys & seen:
            out[r["doc_id"]] = r["y"]
        seen |= keys
    return out


def featured(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the feature sums of each row; ``model`` is a broadcast lexicon."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "x array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(len(keep))):
                x = scorer.features(kernel.words(raw, offs))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                                                pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in range(len(keep))), flat],
                                                 names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED):
    """The lexicon and the coefficients of the logistic model."""
    spark = docs.sparkSession
    sample = stage(labelled_sample(docs, labels, "toxic", most), "labelled")
    y = first_copies(min_hashes(sample).collect())  # at most ``most`` rows
    n_toxic = sum(y.values())
    n_other = len(y) - n_toxic
    if not n_toxic or not n_other:
        share = n_toxic / max(1, len(y))
        return Lexicon({}, {}), np.array([0.0] * len(FEATURES) + [log((share + 1e-6) / (1 - share + 1e-6))])
    chosen = spark.createDataFrame(list(y.items()), "doc_id long, own int")
    sample = sample.join(F.broadcast(chosen), "doc_id")
    enough = (F.col("toxic") >= MIN_DOCS) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("other")))
    found = term_counts(sample).where(enough).collect()  # bounded by the words of the sample
    whole = lexicon(found, n_toxic, n_other)
    fitted = featured(sample, spark.sparkContext.broadcast(whole), ["y"]).collect()  # bounded as the sample
    return whole, fit(np.array([r["x"] for r in fitted]), np.array([r["y"] for r in fitted], float))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the feature sums ``x`` of each row of ``docs``."""
    spark = ship(docs.sparkSession)
    terms, b = learn(docs, labels, most)
    margin = F.aggregate(F.zip_with("x", F.array(*map(F.lit, map(float, b[:-1]))), lambda u, v: u * v),
                         F.lit(float(b[-1])), lambda s, v: s + v)
    rows = featured(docs, spark.sparkContext.broadcast(terms), ["doc_id"])
    return (rows.withColumn("score", 1 / (1 + F.exp(-margin)))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "x"))
