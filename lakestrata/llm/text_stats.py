"""Statistics of whole texts, vectorised over their bytes and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel

STATS = ("bytes", "words", "word_length", "upper", "digits", "signs", "bars", "marks", "beyond_ascii", "lines",
         "line_words", "distinct_words", "top_word", "distinct_pairs", "repeated_next", "distinct_lines", "function_words",
         "sign_ends", "upper_words", "short_words", "long_words", "sentence_ends", "language_mix")

#: Frequent words of four languages.
FUNCTION_WORDS = {
    "en": "the of and to in is it that was for with as on by be this are from at or an not have he his which you they",
    "fr": "le la les de des et un une du en est que qui dans par pour sur pas avec au il elle on ne se ce",
    "de": "der die das und ist in zu den von mit dem nicht ein eine sich auf für im des als auch es an werden wird",
    "es": "el la los las de que y en un una por con no se su para es al lo como más del o pero",
}


def _classes() -> np.ndarray:
    """Class bits of each byte: 1 upper, 2 digit, 4 sign, 8 bar, 16 punctuation mark, 32 beyond ASCII, 64 line end."""
    out = np.zeros(256, np.uint8)
    out[65:91] |= 1
    out[48:58] |= 2
    out[[ord(c) for c in "#$%&*+<=>@\\^_`{}~"]] |= 4
    out[ord("|")] |= 8
    out[[ord(c) for c in "!?;:"]] |= 16
    out[128:] |= 32
    out[10] |= 64
    return out


CLASSES = _classes()


def _hashes(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    return np.sort(kernel.words(data, np.array([0, len(data)], np.int64)).hashes)


def _member(h: np.ndarray, own: np.ndarray) -> np.ndarray:
    return own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h


def _distinct(h: np.ndarray) -> tuple[int, int]:
    """How many different values there are, and how often the most frequent one occurs."""
    if not len(h):
        return 0, 0
    h = np.sort(h)
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    return len(at) - 1, int(np.diff(at).max())


class Stats:
    def __init__(self):
        self.words = [_hashes(x) for x in FUNCTION_WORDS.values()]

    def __call__(self, w: kernel.Words) -> np.ndarray:
        """A row of STATS for each text; ratios of nothing are 0."""
        n = len(w.at) - 1
        cls = CLASSES[w.raw]
        sums = np.zeros((7, len(cls) + 1), np.int64)
        for k in range(7):
            np.cumsum((cls >> k) & 1, out=sums[k, 1:])
        by = sums[:, w.offs[1:]] - sums[:, w.offs[:-1]]
        size = np.diff(w.offs)
        count = np.diff(w.at)
        length = (w.ends - w.starts).astype(np.int64)

        def per_text(x: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(x)])
            return c[w.at[1:]] - c[w.at[:-1]]

        last = w.raw[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
        end_class = CLASSES[last]
        words_upper = (sums[0, w.ends] - sums[0, w.starts]) if len(w.ends) else np.zeros(0, np.int64)
        lang = np.array([per_text(_member(w.hashes, own)) if len(w.hashes) else np.zeros(n) for own in self.words])
        again = np.zeros(len(w.hashes), np.int64)
        if len(again) > 1:
            again[1:] = w.hashes[1:] == w.hashes[:-1]
        pairs = np.zeros(len(w.hashes), np.uint64)
        if len(pairs) > 1:
            pairs[:-1] = kernel.fold(w.hashes, 2)
        line_starts = np.flatnonzero(cls & 64) + 1
        out = np.zeros((n, len(STATS)))
        many = np.maximum(count, 1)
        chars = np.maximum(size, 1)
        total_lang = np.maximum(lang.sum(axis=0), 1)
        out[:, 0] = size
        out[:, 1] = count
        out[:, 2] = per_text(length) / many
        out[:, 3] = by[0] / chars
        out[:, 4] = by[1] / chars
        out[:, 5] = by[2] / chars
        out[:, 6] = by[3] / chars
        out[:, 7] = by[4] / chars
        out[:, 8] = by[5] / chars
        out[:, 9] = by[6] + (size > 0)
        out[:, 10] = count / np.maximum(out[:, 9], 1)
        out[:, 14] = per_text(again) / many
        out[:, 16] = lang.sum(axis=0) / many
        out[:, 17] = per_text((end_class & 4) > 0) / many
        out[:, 18] = per_text((words_upper >= 2) & (2 * words_upper >= length)) / many
        out[:, 19] = per_text(length <= 2) / many
        out[:, 20] = per_text(length >= 20) / many
        out[:, 21] = per_text(last == ord(".")) / many
        out[:, 22] = 1 - lang.max(axis=0) / total_lang if n else 0
        for i in range(n):
            a, b = int(w.at[i]), int(w.at[i + 1])
            if b > a:
                distinct, top = _distinct(w.hashes[a:b])
                out[i, 11], out[i, 12] = distinct / (b - a), top / (b - a)
                out[i, 13] = _distinct(pairs[a:b - 1])[0] / max(1, b - a - 1)
                lo, hi = np.searchsorted(line_starts, [w.offs[i] + 1, w.offs[i + 1]])
                cuts = np.concatenate([[a], np.searchsorted(w.starts[a:b], line_starts[lo:hi]) + a, [b]])
                cuts = cuts[np.concatenate([[True], np.diff(cuts) > 0])]
                if len(cuts) > 2:
                    lines = np.add.reduceat(kernel.mix(w.hashes[a:b] + np.arange(b - a, dtype=np.uint64)
                                                       - np.repeat(cuts[:-1] - a, np.diff(cuts)).astype(np.uint64)),
                                            cuts[:-1] - a)
                    out[i, 15] = _distinct(lines)[0] / len(lines)
                else:
                    out[i, 15] = 1
        return out


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and one double for each of STATS."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"{s} double" for s in STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = Stats()
        for batch in batches:
            for lo, hi, raw, offs in kernel.chunks(batch.column(len(keep))):
                x = stats(kernel.words(raw, offs))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in range(len(keep))), *(pa.array(c) for c in x.T)],
                    names=[*keep, *STATS])

    return docs.select(*keep, "text").mapInArrow(run, schema)
