import zlib

import numpy as np
import public_tokenizers
from corpus_helpers import TEXTS, no_documents, odd_documents
from tokenizers import Tokenizer

from lakestrata.llm.encode import Encoder
from lakestrata.llm.packing import cut, pack, plan, sequences
from lakestrata.llm.sharding import hypergeometric, matrix, uniform_shards

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cached_ids_equal_the_tokenizer(spark, sf):
    odd = ["", " a", "a  b", "x\n\ny", "a\n b", "a \nb", "é,\u00a0x", "don't stop. It's", "12,3 4.", "x\ty z", "end.", "'ll 'll.",
           "<|endoftext|> x", "Ⅷ. ²,", "日本。 x", "a\u2028b c.\nD"]
    texts = odd + [a + s + b for a in odd for b in odd for s in "\n "]
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert Encoder(PATH).encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in ids]


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(rng.geometric(0.01, 5000), 100), minlength=101)
    patterns = plan(counts, 100)
    used = np.zeros(101, np.int64)
    for times, lengths in patterns:
        assert sum(lengths) <= 100 and times > 0
        np.add.at(used, lengths, times)
    assert (used == counts * (np.arange(101) > 0)).all()
    assert sum(t for t, _ in patterns) <= 1.01 * -(-(counts * np.arange(101)).sum() // 100)


def check_packed(rows, want):
    by, places = {}, {}
    for r in rows:
        by.setdefault((r["doc_id"], r["piece"]), []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(rows) == sum(len(cut(len(ids), 1024)) for _, ids in want)
    for d, ids in want:
        for k, (start, n) in enumerate(cut(len(ids), 1024)):
            crc = zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())
            assert any((r["start"], r["length"], r["ids_crc32"]) == (start, n, crc) for r in by[d, k])


def test_packing_of_odd_rows_and_the_sequences(spark):
    docs = odd_documents(spark)
    placed = pack(docs, PATH)
    rows = placed.collect()
    model = Tokenizer.from_file(PATH)
    check_packed(rows, [(i, [*model.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in TEXTS])
    made = sequences(docs.where("doc_id IS NOT NULL"), pack(docs.where("doc_id IS NOT NULL"), PATH), PATH).collect()
    assert all(len(r["input_ids"]) <= 1024 and r["input_ids"][-1] in (2, *range(50257)) for r in made)
    assert pack(no_documents(spark), PATH).count() == 0


def test_cut():
    assert cut(1024, 1024) == [(0, 1024)] and cut(1030, 1024) == [(0, 6), (6, 1024)] and cut(1, 1024) == [(0, 1)]


def test_shards(spark):
    docs = odd_documents(spark)
    out = uniform_shards(docs, shards=5, cell_rows=2)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    rows = out.collect()
    slots: dict[int, list] = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(TEXTS) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, TEXTS))
    assert uniform_shards(no_documents(spark)).count() == 0


def test_matrix_sums_and_spread():
    m = matrix([100, 0, 37, 63], 7, 1)
    assert m.sum(axis=1).tolist() == [100, 0, 37, 63] and max(m.sum(axis=0)) - min(m.sum(axis=0)) <= 1
    rng = np.random.default_rng(5)
    n, good, bad = 1000, 3_000_000_000, 1_000_000_000
    draws = [hypergeometric(rng, good, bad, n) for _ in range(300)]
    assert abs(np.mean(draws) - 750) < 4 and 9 < np.std(draws) < 19
