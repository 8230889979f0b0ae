"""The hash gate cuts a large target by a bitmap over the keys at hand, with the result of the plain join."""

from pyspark.sql import functions as F

from lakestrata.operators import merge, sieve
from lakestrata.session import stage


def test_gate_by_bitmap_gives_the_plain_result(spark, monkeypatch):
    target = spark.range(2000).selectExpr("if(id = 5, null, id div 2) k", "date'2000-01-01' + cast(id % 3 as int) d",
                                          "md5(cast(id as string)) h", "id c")
    new = target.where("k % 13 = 0 or k is null").unionByName(spark.range(3).selectExpr(
        "id + 5000 k", "date'2000-01-01' d", "'x' h", "-1L c"))
    rows = stage(new.withColumn("h", F.when(F.col("k") % 2 == 0, F.lit("y")).otherwise(F.col("h"))), "rows")

    def tell():
        return sorted(map(str, merge.hash_gate(rows, target, ["k", "d"], "h", ("c",), narrow=True).collect()))

    plain, cut = tell(), []

    def by_bitmap(r, k, on):
        out = sieve.possible(r, k, on, 0)
        cut.append(out.count())
        return sieve.semi(r, k, on, 0)

    monkeypatch.setattr(merge, "semi", by_bitmap)
    assert tell() == plain and len(plain) > 3
    assert cut[0] < 400  # of 2000 rows, all of which went to the join
