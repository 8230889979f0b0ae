from pyspark.sql import functions as F

from lakestrata.llm.common import BITMAP_BITS, id_bitmap, in_bitmap
from lakestrata.llm.jaccard_join import jaccard_join


def test_first_and_last_slots_are_found(spark):
    slot = F.pmod(F.xxhash64("a"), F.lit(BITMAP_BITS))
    last = spark.range(40_000_000).select(F.col("id").alias("a")).where(slot == BITMAP_BITS - 1).first()["a"]
    ids = spark.createDataFrame([(25317696,), (last,), (7,)], "a long")
    assert ids.where(slot == 0).count() == 1
    bits = id_bitmap(ids, "a")
    assert len(bits) == BITMAP_BITS // 8
    at = [r["p"] for r in ids.select(in_bitmap("a").alias("p")).collect()]
    assert all(0 <= p < BITMAP_BITS and bits[p >> 3] >> (p & 7) & 1 for p in at)
    assert sum(b.bit_count() for b in bits) == 3


def test_document_of_the_first_slot_keeps_its_links(spark):
    base = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(25317696, base), (9, base + " tail")], "doc_id long, text string")
    assert {(r["component_id"], r["links"]) for r in jaccard_join(docs).collect()} == {(9, 1)}
