"""URL filter by a weighted vocabulary, with rules for hosts and paths before it.

An Aho-Corasick automaton of all terms runs once over each lower-cased URL. A hit counts
only between boundaries: the characters beside it are no ASCII letters or digits. One
strict term rejects a URL, and so do ``min_soft`` different soft terms. A rule names a host
and a path; it fits the host and its subdomains where the URL's path starts with the
rule's, and the longest fitting rule decides before the vocabulary is asked.

Defined cases: a null URL and one without ``://`` have an empty host and path and no
rule; the vocabulary sees the whole URL, a null one as empty; equal rows are judged each;
of two fitting rules of one length the one of the longer host wins; a null id is kept.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Verdict, host and path of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: One of these rejects a URL.
STRICT = ("porn", "porno", "xxx", "hentai", "camgirl", "camgirls", "escorts", "milf", "nsfw", "warez", "keygen", "viagra")
#: Several different ones of these reject a URL.
SOFT = ("adult", "sex", "casino", "poker", "betting", "bonus", "jackpot", "slots", "free", "download", "torrent", "crack",
        "pills", "pharmacy", "cheap", "loan", "loans", "dating", "hot", "live", "win", "winner", "prize", "lottery")
MIN_SOFT = 2
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PART = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    path = rest[host:]
    end = min((k for k in map(path.find, "?#") if k >= 0), default=len(path))
    return rest[:host].translate(ASCII_LOWER), path[:end]


class Judge:
    """Rules and vocabulary, built once per task."""

    def __init__(self, rules: Sequence, strict: Sequence[str], soft: Sequence[str], min_soft: int):
        self.rules: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.rules.setdefault(host, []).append((path, verdict))
        self.min_soft = min_soft
        self.words = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for t in terms:
                self.words.add_word(t, (kind, t))
        self.words.make_automaton()
        self.any = bool(strict or soft)

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        labels = host.split(".") if host else []
        for k in range(len(labels)):
            tail = ".".join(labels[k:])
            for start, verdict in self.rules.get(tail, ()):
                if path.startswith(start) and (best is None or len(tail) + len(start) > best[0]):
                    best = (len(tail) + len(start), tail + start, verdict)
        return best and best[1:]

    def hits(self, url: str | None) -> tuple[int, int]:
        """Strict and different soft terms of a URL."""
        text = (url or "").translate(ASCII_LOWER)
        strict, soft = 0, set()
        for end, (kind, term) in self.words.iter(text) if self.any else ():
            first = end - len(term)
            if (first < 0 or text[first] not in PART) and (end + 1 == len(text) or text[end + 1] not in PART):
                if kind == "strict":
                    strict += 1
                else:
                    soft.add(term)
        return strict, len(soft)

    def __call__(self, url: str | None) -> tuple:
        host, path = split_url(url)
        rule, (strict, soft) = self.rule(host, path), self.hits(url)
        own = "block" if strict or soft >= self.min_soft else "allow"
        return host, path, rule and rule[0], rule[1] if rule else own, strict, soft


def url_filter(pages: DataFrame, rules: Sequence = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
               min_soft: int = MIN_SOFT) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits`` for each row of ``pages``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(rules, strict, soft, min_soft)
        for batch in batches:
            cols = list(zip(*map(judge, batch.column(1).to_pylist()), strict=True)) or [()] * 6
            kinds = [pa.string()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, strict_hits int, soft_hits int")
