"""Language-model scoring by cross-entropy difference.

A target and a background model of the same kind share one vocabulary: every word that
all documents hold at least ``least`` times; the others are one unknown word. Both are bigram
models with absolute discounting that back off to smoothed word frequencies, over every bigram
that stands at least ``least`` times. The background is every document, the target all labelled
documents of good quality outside the held-out fifth. Neither grows to a limit.

No table of bigrams is written. The tokens of a run of texts are a parcel; it sends its distinct
bigrams with their counts to the hash range of their first word. There all bigrams that begin
with a word meet, so their counts and the word's sums follow on the spot and go back to the
parcel, which scores its texts. Words travel as numbers in the list of frequent words.

1. Words are counted by hash range; the frequent ones are broadcast.
2. Of words so frequent that they would fill a range, and of the start of a text, the bigrams are
   counted by their own hash, which gives these words' sums; parcels ask for them by bigram. The
   most frequent of these bigrams are broadcast as well and needn't be asked for.
3. Parcels and what they ask for are dealt by range, where the table of words meets them: it
   answers for the words that aren't broadcast.
4. The answers and the tokens of a parcel meet in one task.

The number of ranges follows from the bytes of the texts; what travels is in proportion to the
tokens. Texts of the target are found by their ids; only texts whose id passes a filter are moved
for that. A document's score is the mean over its tokens of the target model's loss minus the
background model's, in nats: lower is closer to the target.

Words and bigrams are compared by 64-bit hashes. Defined cases: null and empty texts have no
tokens and losses and score 0; null ids are kept; repeated rows are counted and scored each;
extra columns are ignored; an empty table gives no rows; without target documents the target
model is the uniform one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import held_out, id_bitmap, in_bitmap, partitions, settled, ship, stage
from .terms import find

#: Entries of the broadcast tables of frequent words and bigrams.
VOCABULARY = 1 << 16
BIGRAMS = 1 << 18
LEAST = 2
DISCOUNT = 0.75
SMOOTHING = 0.5
FLUSH = 1 << 20
#: Bytes of text and tokens of a hash range, about.
RANGE_BYTES = 6 << 20
RANGE_TOKENS = 1 << 20
#: A word of more than a 2^18th of all tokens, and of half a range, is dealt by bigram.
HOT_SHARE = 18
#: Tokens and texts of a parcel, at most but for a last run of texts.
PARCEL = 1 << 19
PARCEL_TEXTS = 60_000
STRIP = 3
#: Stands before a text's first word.
START = np.uint64(0x5354415254A5A5A5)
#: Kinds of rows: the table of words, tokens of a parcel, its bigrams and rare words of a range, and their answers.
TABLE, TOKENS, PAIRS, RARE, PAIR_ANSWERS, RARE_ANSWERS = range(6)


def edges_of(buckets: int) -> np.ndarray:
    return np.array([(k + 1) * (1 << 64) // buckets - 1 for k in range(buckets)], np.uint64)


def slices(keys: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the keys by hash range, and range, first and end of each that has keys."""
    place = np.searchsorted(edges, kernel.mix(keys))
    order = np.argsort(place, kind="stable")
    cut = np.searchsorted(place[order], np.arange(len(edges) + 1))
    return order, [(k, int(cut[k]), int(cut[k + 1])) for k in np.flatnonzero(np.diff(cut)).tolist()]


class Tally:
    """Sums of two integer values of 64-bit keys; ``before`` is a bigram's first word, 0 for words."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def push(self, keys: np.ndarray, before: np.ndarray, values: np.ndarray) -> None:
        if len(keys):
            order = np.argsort(keys, kind="stable")
            k = keys[order]
            at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            self.held.append((k[at], before[order[at]], np.add.reduceat(values[:, order], at, axis=1)))
            self.size += len(at)
            if len(self.held) > 32:
                self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held, self.held, self.size = self.held, [], 0
        if not held:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        if len(held) > 1:
            self.push(*(np.concatenate([h[i] for h in held], axis=-1) for i in range(3)))
        else:
            self.held, self.size = held, len(held[0][0])
        return self.held[0]


COUNTS = "bucket int, keys binary, before binary, vals binary"


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def sent(tally: Tally, edges: np.ndarray, pairs: bool) -> pa.RecordBatch:
    """What a tally holds as a row for each hash range; the tally is empty afterwards."""
    keys, before, values = tally.merged()
    tally.held, tally.size = [], 0
    order, own = slices(keys, edges)
    keys, before, values = keys[order], before[order], values[:, order].astype("<u4")
    return batch_of(COUNTS, [(k, np.diff(keys[a:b], prepend=np.uint64(0)).tobytes(), before[a:b].tobytes() if pairs else b"",
                              values[:, a:b].tobytes()) for k, a, b in own])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}


def by_bucket(rows: DataFrame, buckets: int, column: str = "bucket") -> DataFrame:
    n = max(partitions(rows.sparkSession), -(-buckets // 4))
    return rows.repartition(n, F.xxhash64(column)).sortWithinPartitions(column, *(["kind"] if "kind" in rows.columns else []))


def tokens_of(w: kernel.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token the word before it, the key of the bigram and the text."""
    before = np.empty_like(w.hashes)
    before[1:] = w.hashes[:-1]
    before[w.at[:-1][np.diff(w.at) > 0]] = START
    return before, pair_key(before, w.hashes), np.repeat(np.arange(len(w.at) - 1), np.diff(w.at))


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return kernel.mix((before ^ (before >> np.uint64(29))) * kernel.STEP[1] + word)


Chosen = Callable[[kernel.Words], tuple[np.ndarray, np.ndarray, np.ndarray]]


def counted(rows: DataFrame, bits, buckets: int, chosen: Chosen, pairs: bool) -> DataFrame:
    """Counts by hash range: a row each of keys, first words and counts in target and background.

    ``chosen`` gives of a run of texts the keys to count, their first words and their texts.
    """
    edges = edges_of(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in (ours(b, bits) for b in batches):
            flag = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, raw, offs in kernel.chunks(batch.column(0)):
                keys, before, docs = chosen(kernel.words(raw, offs, STRIP))
                tally.push(keys, before, np.stack([flag[lo:hi][docs].astype(np.int64), np.ones(len(docs), np.int64)]))
                if tally.size >= FLUSH:
                    yield sent(tally, edges, pairs)
        if tally.size:
            yield sent(tally, edges, pairs)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, at = Tally(), None
        for row in rows_of(batches):
            if at != row["bucket"] and tally.size:
                yield whole(at, tally)
            at = row["bucket"]
            keys = np.cumsum(np.frombuffer(row["keys"], np.uint64), dtype=np.uint64)
            before = np.frombuffer(row["before"], np.uint64) if pairs else np.zeros(len(keys), np.uint64)
            tally.push(keys, before, np.frombuffer(row["vals"], "<u4").reshape(2, -1).astype(np.int64))
        if tally.size:
            yield whole(at, tally)

    def whole(bucket: int, tally: Tally) -> pa.RecordBatch:
        keys, before, values = tally.merged()
        tally.held, tally.size = [], 0
        return batch_of(COUNTS, [(bucket, keys.tobytes(), before.tobytes() if pairs else b"", values.astype("<i8").tobytes())])

    sent_rows = rows.select("text", "flag", "slot").mapInArrow(count, COUNTS)
    return stage(by_bucket(sent_rows, buckets).mapInArrow(total, COUNTS), "counts")


def read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["vals"], "<i8").reshape(2, -1)


@dataclass
class Frequent:
    """Broadcast entries. Words: counts in target and background. Hot words: counts, tokens and number of the
    bigrams they begin, in each. Pairs: counts."""

    words: np.ndarray
    word_values: np.ndarray
    hot: np.ndarray
    hot_values: np.ndarray
    pairs: np.ndarray
    pair_values: np.ndarray
    tokens: tuple[int, int]
    known: int
    unknown: np.ndarray

    def backed(self, values: np.ndarray) -> np.ndarray:
        """The smoothed frequency of words in both models."""
        return np.stack([(values[m] + SMOOTHING) / (self.tokens[m] + SMOOTHING * (self.known + 1)) for m in range(2)])


def entries(rows: DataFrame, wanted: Callable[[dict], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Some entries of all ranges, sorted by key; ``wanted`` bounds how many of a range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, values = read(row)
            at = wanted(row)
            yield batch_of("keys binary, vals binary", [(keys[at].tobytes(), values[:, at].tobytes())])

    own = rows.mapInArrow(run, "keys binary, vals binary").toArrow()
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_py(), np.uint64) for x in own.column(0))])
    vals = np.concatenate([np.zeros((2, 0), np.int64), *(np.frombuffer(x.as_py(), "<i8").reshape(2, -1) for x in own.column(1))], axis=1)
    order = np.argsort(keys)
    return keys[order], vals[:, order]


def most(values: np.ndarray, n: int, above: int) -> np.ndarray:
    """The n largest entries, and all above a count."""
    order = np.argsort(-values, kind="stable")
    return order[:max(n, int((values > above).sum()))]


def totals(words: DataFrame, least: int) -> tuple[tuple[int, int], int, np.ndarray]:
    """Tokens in target and background, known words, tokens of the unknown word in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            values = read(row)[1]
            rare = values[1] < least
            yield batch_of("t long, b long, known long, ut long, ub long",
                           [(*map(int, values.sum(axis=1)), int((~rare).sum()), *map(int, values[:, rare].sum(axis=1)))])

    names = ["t", "b", "known", "ut", "ub"]
    r = words.mapInArrow(run, ", ".join(f"{n} long" for n in names)).agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in names)).first()
    return (int(r[0]), int(r[1])), int(r[2]), np.array([int(r[3]), int(r[4])], np.int64)


def hot_sums(pairs: DataFrame, hot: np.ndarray, least: int) -> np.ndarray:
    """Tokens and number of the bigrams that each hot word begins, in target and background."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, len(hot)), np.int64)
        for row in rows_of(batches):
            values = read(row)[1]
            keep = values[1] >= least
            at = find(hot, np.frombuffer(row["before"], np.uint64)[keep])
            for m in range(2):
                np.add.at(sums[m], at, values[m][keep])
                np.add.at(sums[m + 2], at, values[m][keep] > 0)
        yield batch_of("at long, a long, b long, c long, d long", [(int(k), *map(int, sums[:, k])) for k in np.flatnonzero(sums[1])])

    own = pairs.mapInArrow(run, "at long, a long, b long, c long, d long").groupBy("at").agg(
        *(F.sum(c).alias(c) for c in "abcd")).toArrow()  # a row a hot word
    out = np.zeros((4, len(hot)), np.int64)
    at, *cols = (c.to_numpy() for c in own.columns)
    out[:, at.astype(np.int64)] = np.array(cols, np.int64).reshape(4, -1)
    return out


def context(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What first words leave to the back-off and the size their bigrams are divided by: counts, tokens, kinds in both models."""
    size = np.maximum(np.maximum(values[:2], values[2:4]), 1)
    return np.maximum(1 - (values[2:4] - DISCOUNT * values[4:]) / size, 1e-6), size


def losses(left: np.ndarray, backed: np.ndarray, share: np.ndarray) -> np.ndarray:
    return -np.log(left * backed + share)


FLOW = ("kind int, bucket int, parcel long, rare binary, before binary, word binary, vals binary, "
        "ids array<long>, sizes binary")
NAMES = [x.split()[0] for x in FLOW.split(", ")]


def flow(**cells) -> tuple:
    return tuple(cells.get(n) for n in NAMES)


def squeezed(values: np.ndarray) -> bytes:
    """An array's byte planes, compressed: small numbers in wide types take little."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def opened(cell: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(cell[:8], "little")
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(cell[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def coded(frequent: np.ndarray, *columns: np.ndarray) -> tuple[bytes, ...]:
    """The words that aren't frequent, and each column as numbers in the frequent words followed by them."""
    at = [find(frequent, c) for c in columns]
    rare = np.unique(np.concatenate([c[k < 0] for c, k in zip(columns, at, strict=True)]))
    kind = "<u2" if len(frequent) + len(rare) <= 1 << 16 else "<u4"
    out = []
    for c, k in zip(columns, at, strict=True):
        k[k < 0] = len(frequent) + np.searchsorted(rare, c[k < 0])
        out.append(squeezed(k.astype(kind)))
    return rare.tobytes(), *out


def decoded(frequent: np.ndarray, rare: bytes, *columns: bytes) -> list[np.ndarray]:
    own = np.frombuffer(rare, np.uint64)
    kind = "<u2" if len(frequent) + len(own) <= 1 << 16 else "<u4"
    out = []
    for c in columns:
        at = opened(c, kind).astype(np.int64)
        words = np.empty(len(at), np.uint64)
        known = at < len(frequent)
        words[known], words[~known] = frequent[at[known]], own[at[~known] - len(frequent)]
        out.append(words)
    return out


@dataclass
class Parcel:
    """A parcel's tokens: first word, word and text of each, and its distinct bigrams."""

    before: np.ndarray   # of bigrams
    word: np.ndarray
    key: np.ndarray
    of: np.ndarray       # token -> bigram
    doc: np.ndarray

    @staticmethod
    def of_words(words: np.ndarray, sizes: np.ndarray) -> Parcel:
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
        key, first, of = np.unique(pair_key(before, words), return_index=True, return_inverse=True)
        return Parcel(before[first], words[first], key, of, np.repeat(np.arange(len(sizes)), sizes))

    def asked(self, f: Frequent, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The bigrams to ask for in each range, by first word."""
        own = np.flatnonzero(find(f.pairs, self.key) < 0)
        hot = find(f.hot, self.before[own]) >= 0
        order, cut = slices(np.where(hot, self.key[own], self.before[own]), edges)
        for k, a, b in cut:
            mine = own[order[a:b]]
            yield k, mine[np.argsort(self.before[mine], kind="stable")]

    def rare(self, f: Frequent, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The words to ask for in each range."""
        own = np.unique(self.word[find(f.words, self.word) < 0])
        order, cut = slices(own, edges)
        for k, a, b in cut:
            yield k, own[order[a:b]]


def parcels(rows: DataFrame, bits, held, buckets: int) -> DataFrame:
    """Parcels of texts, and what they ask for by range."""
    edges = edges_of(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Frequent = held.value
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        runs: list[tuple] = []
        many = 0

        def out() -> Iterator[pa.RecordBatch]:
            words, sizes, flag = (np.concatenate(c) for c in zip(*runs, strict=True))
            p = Parcel.of_words(words, sizes)
            counts = np.stack([np.bincount(p.of, flag[p.doc], len(p.key)), np.bincount(p.of, minlength=len(p.key))]).astype("<u4")
            rare, code = coded(f.words, words)
            rows = [flow(kind=TOKENS, bucket=number % buckets, parcel=number, ids=ids, rare=rare, word=code, sizes=squeezed(sizes.astype("<i8")))]
            for k, mine in p.asked(f, edges):
                rare, u, v = coded(f.words, p.before[mine], p.word[mine])
                rows.append(flow(kind=PAIRS, bucket=k, parcel=number, rare=rare, before=u, word=v, vals=squeezed(counts[:, mine])))
            rows += [flow(kind=RARE, bucket=k, parcel=number, rare=own.tobytes()) for k, own in p.rare(f, edges)]
            yield batch_of(FLOW, rows)

        for batch in (ours(b, bits) for b in batches):
            flag = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            for lo, hi, raw, offs in kernel.chunks(batch.column(1)):
                w = kernel.words(raw, offs, STRIP)
                if ids and (many + len(w.hashes) > PARCEL or len(ids) + hi - lo > PARCEL_TEXTS):
                    yield from out()
                    ids, runs, many, number = [], [], 0, number + 1
                runs.append((w.hashes, np.diff(w.at), flag[lo:hi]))
                ids.extend(batch.column(0).slice(lo, hi - lo).to_pylist())
                many += len(w.hashes)
        if ids:
            yield from out()

    return rows.mapInArrow(run, FLOW)


def answers(f: Frequent, table: tuple[np.ndarray, np.ndarray], asked: list[dict], least: int) -> list[tuple]:
    """To each parcel the counts of its bigrams in this range, and counts, tokens and kinds of their first words."""
    if not asked:
        return []
    pieces = [decoded(f.words, r["rare"], r["before"], r["word"]) for r in asked]
    counts = np.concatenate([opened(r["vals"], "<u4").reshape(2, -1) for r in asked], axis=1).astype(np.int64)
    u, v = (np.concatenate(c) for c in zip(*pieces, strict=True))
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new_u = np.append(True, u[1:] != u[:-1])
    new = new_u | np.append(True, v[1:] != v[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[:, order], at, axis=1)
    total[:, total[1] < least] = 0
    place = np.empty(len(u), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new_u[at])
    known = find(table[0], u[at][first])
    words = np.where(known >= 0, table[1][:, known], 0) if len(table[0]) else np.zeros((2, len(first)), np.int64)
    stats = np.concatenate([words, np.add.reduceat(total, first, axis=1), np.add.reduceat(total > 0, first, axis=1, dtype=np.int64)])
    owner = (np.cumsum(new_u[at]) - 1)[place]
    out, a = [], 0
    for r, (mine, _) in zip(asked, pieces, strict=True):
        b = a + len(mine)
        firsts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))  # a part is sorted by first word
        out.append(flow(kind=PAIR_ANSWERS, bucket=r["bucket"], parcel=r["parcel"], vals=squeezed(total[:, place[a:b]]),
                        before=squeezed(stats[:, owner[a:b][firsts]])))
        a = b
    return out


def answered(dealt: DataFrame, words: DataFrame, held, buckets: int, least: int) -> DataFrame:
    """Tokens as they come, and the answers of each range to the parcels."""
    table = words.select(F.lit(TABLE).alias("kind"), "bucket", F.col("keys").alias("rare"), "vals")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Frequent = held.value
        none = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        at, own, asked = None, none, []
        for row in rows_of(batches):
            if row["bucket"] != at:
                if asked:
                    yield batch_of(FLOW, answers(f, own, asked, least))
                at, own, asked = row["bucket"], none, []
            if row["kind"] == TABLE:
                own = np.frombuffer(row["rare"], np.uint64), np.frombuffer(row["vals"], "<i8").reshape(2, -1)
            elif row["kind"] == PAIRS:
                asked.append(row)
            elif row["kind"] == RARE:
                place = find(own[0], np.frombuffer(row["rare"], np.uint64))
                if (place < 0).any():
                    raise RuntimeError("a word that stands in a text isn't among the counted ones")
                values = own[1][:, place]
                values = np.where(values[1] >= least, values, f.unknown[:, None])
                yield batch_of(FLOW, [flow(kind=RARE_ANSWERS, bucket=at, parcel=row["parcel"], vals=squeezed(values))])
            else:
                yield batch_of(FLOW, [tuple(row[n] for n in NAMES)])
        if asked:
            yield batch_of(FLOW, answers(f, own, asked, least))

    return by_bucket(dealt.unionByName(table, allowMissingColumns=True), buckets).mapInArrow(run, FLOW)


def scored(rows: DataFrame, held, buckets: int) -> DataFrame:
    """The documents of each parcel, from its tokens and the answers."""
    edges = edges_of(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, got = None, {}
        for row in rows_of(batches):
            if row["kind"] == TOKENS:
                if tokens:
                    yield done(tokens, got)
                tokens, got = row, {}
            else:
                got[row["kind"], row["bucket"]] = row
        if tokens:
            yield done(tokens, got)

    def done(row: dict, got: dict) -> pa.RecordBatch:
        f: Frequent = held.value
        sizes = opened(row["sizes"], "<i8")
        p = Parcel.of_words(decoded(f.words, row["rare"], row["word"])[0], sizes)
        # bigrams: counts, and the values of the first word; both from the broadcast or from the answers
        at = find(f.pairs, p.key)
        pair = f.pair_values[:, at] if len(f.pairs) else np.zeros((2, len(at)), np.int64)
        at = find(f.hot, p.before)
        values = f.hot_values[:, at].copy()
        for k, mine in p.asked(f, edges):
            answer = got[PAIR_ANSWERS, k]
            pair[:, mine] = opened(answer["vals"], "<i8").reshape(2, -1)
            before = p.before[mine]
            owner = np.cumsum(np.append(True, before[1:] != before[:-1])) - 1
            stats = opened(answer["before"], "<i8").reshape(6, -1)[:, owner]
            values[:, mine] = np.where(at[mine] >= 0, values[:, mine], stats)
        at = find(f.words, p.word)
        word = f.word_values[:, at] if len(f.words) else np.zeros((2, len(at)), np.int64)
        rare = list(p.rare(f, edges))
        if rare:
            own = np.concatenate([x for _, x in rare])
            told = np.concatenate([opened(got[RARE_ANSWERS, k]["vals"], "<i8").reshape(2, -1) for k, _ in rare], axis=1)
            order, cold = np.argsort(own), at < 0
            word[:, cold] = told[:, order[np.searchsorted(own[order], p.word[cold])]]
        left, size = context(values)
        loss = losses(left, f.backed(word), np.maximum(pair - DISCOUNT, 0) / size)[:, p.of]
        n = np.maximum(sizes, 1)
        t, b = (np.bincount(p.doc, x, len(sizes)) / n for x in loss)
        return pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(sizes), *(pa.array(x) for x in (t, b, t - b))],
                                          names=["doc_id", "tokens", "target_loss", "background_loss", "score"])

    return by_bucket(rows, buckets, "parcel").mapInArrow(
        run, "doc_id long, tokens long, target_loss double, background_loss double, score double")


def ours(batch: pa.RecordBatch, bits, near: bool = False) -> pa.RecordBatch:
    """The rows whose ``slot``, the last column, isn't in the filter (or is, if ``near``); rows without a slot stay."""
    slot = batch.column(batch.num_columns - 1)
    place = pc.fill_null(slot, 0).to_numpy()
    held = (np.frombuffer(bits.value, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    none = slot.is_null().to_numpy(zero_copy_only=False)
    return batch.filter(pa.array((held & ~none) if near else (~held | none)))


def flagged(docs: DataFrame, target: DataFrame) -> tuple[DataFrame, object]:
    """``doc_id, text, flag, slot`` of each row, and the filter of the target's ids.

    Texts whose id passes the filter are joined exactly and have no slot; they come a second time, with
    one, among all rows, where tasks leave them out (``ours``). So no other text is moved.
    """
    own = target.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(own, "_id"))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.lit(False).alias("flag"), in_bitmap("doc_id").alias("slot"))
    near = rows.mapInArrow(lambda batches: (ours(b, bits, True) for b in batches), rows.schema)
    near = near.join(own, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "text", F.col("_id").isNotNull().alias("flag"), F.lit(None).cast("long").alias("slot"))
    return rows.unionByName(stage(near, "flagged")), bits


def cross_entropy_difference(docs: DataFrame, target: DataFrame, vocabulary: int = VOCABULARY, bigram_entries: int = BIGRAMS,
                             least: int = LEAST, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """``doc_id, tokens, target_loss, background_loss, score`` of each row; ``target`` holds ``doc_id``.

    ``vocabulary`` and ``bigram_entries`` bound what is broadcast, not the models.
    """
    spark = ship(docs.sparkSession)

    def work() -> DataFrame:
        rows, bits = flagged(docs, target)
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(partitions(spark), -(-size // RANGE_BYTES))

        def every_word(w: kernel.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return w.hashes, np.zeros_like(w.hashes), np.repeat(np.arange(len(w.at) - 1), np.diff(w.at))

        words = counted(rows, bits, buckets, every_word, False)
        tokens, known, unknown = totals(words, least)
        above = max(range_tokens // 2, tokens[1] >> HOT_SHARE)
        frequent, values = entries(words, lambda r: (lambda c: most(c, -(-vocabulary // buckets), above))(read(r)[1][1]))
        hot = np.sort(np.append(frequent[values[1] > above], START))  # every text begins after START
        hot_words = np.zeros((2, len(hot)), np.int64)
        hot_words[:, hot != START] = values[:, values[1] > above]
        # a rare word that happens to be broadcast counts as the unknown one, too
        word_values = np.where(values[1] >= least, values, unknown[:, None])

        def hot_pairs(w: kernel.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            before, key, doc = tokens_of(w)
            at = find(hot, before) >= 0
            return key[at], before[at], doc[at]

        table = counted(rows, bits, buckets, hot_pairs, True)
        pairs, pair_values = entries(table, lambda r: (lambda c: most(c, -(-bigram_entries // buckets), above))(read(r)[1][1]))
        pair_values = np.where(pair_values[1] >= least, pair_values, 0)
        hot_values = np.concatenate([hot_words, hot_sums(table, hot, least)])
        held = spark.sparkContext.broadcast(Frequent(frequent, word_values, hot, hot_values, pairs, pair_values, tokens, known, unknown))
        return scored(answered(parcels(rows, bits, held, buckets), words, held, buckets, least), held, buckets)

    return settled(spark, work, "cross-entropy")


def good_documents(labels: DataFrame) -> DataFrame:
    """The ids of all labelled documents of good quality outside the held-out fifth."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    return stage(known.groupBy("doc_id").agg(F.max("quality").alias("y")).where("y = 1").select("doc_id"), "target")
