"""Token ids of whole texts by a byte-level BPE tokenizer file."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

#: Cuts remembered by a worker in each of two generations; the older one is dropped when the younger is full.
REMEMBERED = 400_000
#: White space other than the space and the line feed.
ODD = re.compile(r"[^\S \n]")
CLOSING = frozenset(".,;:!?")


class Memory(dict):
    """Ids of the cuts seen lately, each with what stands before it in the text."""

    def __init__(self, lead: str):
        super().__init__()
        self.lead, self.older = lead, {}

    def learn(self, cuts: set[str], encode) -> None:
        """Makes sure that all ``cuts`` are known; ``encode`` gives the ids of whole strings."""
        missing = cuts.difference(self)
        if not missing:
            return
        if len(self) + len(missing) > REMEMBERED:
            self.older = dict(self)
            self.clear()
            missing = cuts
        if self.older:
            self.update({c: self.older[c] for c in missing if c in self.older})
            missing = missing.difference(self)
        # a closing mark after letters or figures is a piece of its own
        closed = [c for c in missing if c[-1] in CLOSING and c[:-1].isalnum()]
        plain = list(missing.difference(closed).union({c[:-1] for c in closed}.difference(self)))
        self.update(zip(plain, encode([self.lead + c for c in plain]), strict=True))
        if closed:
            marks = dict(zip(CLOSING, encode(list(CLOSING)), strict=True))
            self.update({c: self[c[:-1]] + marks[c[-1]] for c in closed})


def ranked(path: str) -> tiktoken.Encoding:
    """The tokenizer of the file in the library that is quicker for short strings: ids are its ranks of merges."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, as bytes of unsigned 32-bit ids.

    The tokenizer's pre-tokenizer always ends a piece before a space or a line feed that stands
    between other characters. Texts are cut there, so that a cut is encoded once per worker, not
    once per occurrence. Lines with neighbouring, leading or trailing spaces, empty lines and
    other white space beside a cut make the whole text be encoded at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t for t in (str(x.content) for x in self.model.get_added_tokens_decoder().values()) if t]
        self.inner, self.heads = Memory(" "), Memory("")
        self.feed = self._whole(["\n"])[0]
        self.ranked = ranked(path)

    def _cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of strings without line feeds, from one call: a feed between two strings is one id of its own."""
        if not cuts:
            return []
        ids = self.ranked.encode_to_numpy("\n".join(cuts)).astype("<u4")
        at = np.flatnonzero(ids == np.frombuffer(self.feed, "<u4")[0])
        data, ends = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
        starts = [0, *(4 * (at + 1)).tolist()]
        return [data[a:b] for a, b in zip(starts, ends, strict=True)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.model.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        split, whole, heads, inner = [], [], set(), set()
        for i, text in enumerate(texts):
            lines = [line.split(" ") for line in text.split("\n")]
            if any("" in cuts for cuts in lines) or any(s in text for s in self.special) or ODD.search(text):
                whole.append(i)
                continue
            split.append((i, lines))
            for cuts in lines:
                heads.add(cuts[0])
                inner.update(cuts[1:])
        if whole:
            for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
                out[i] = ids
        self.heads.learn(heads, self._cuts)
        self.inner.learn(inner, self._cuts)
        head, get, feed = self.heads.__getitem__, self.inner.__getitem__, self.feed
        for i, lines in split:
            parts = []
            for cuts in lines:
                parts.append(feed)
                parts.append(head(cuts[0]))
                parts.extend(map(get, cuts[1:]))
            out[i] = b"".join(parts[1:])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
