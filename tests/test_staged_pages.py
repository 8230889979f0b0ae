"""Tables staged with a codec of their own keep columns of many values as differences and give every value back."""

import glob

import pyarrow.parquet as pq

from lakestrata.session import scratch_root, stage


def test_columns_of_many_values_are_written_as_differences(spark):
    rows = spark.range(0, 300000, 1, 1).selectExpr(
        "id", "if(id % 9 = 0, null, id * 7919 % 1000003) n", "cast(id as int) i", "cast(id % 100 as smallint) s",
        "if(id % 5 = 0, null, id % 2 = 0) b", "cast(id - 150000 as decimal(12,2)) d", "cast(id as decimal(30,4)) wide",
        "date_add(date'1990-01-01', cast(id % 4000 as int)) on", "timestamp_micros(id * 1000003) at",
        "cast(timestamp_seconds(-id) as timestamp_ntz) ntz", "if(id % 11 = 0, null, 'INV-' || id) t", "cast('x' || id as binary) raw",
        "id * 1.5D f", "array(id, null) a", "named_struct('k', id, 'l', if(id % 3 = 0, null, 'v' || id)) st")
    staged = stage(rows, "pages", "zstd")
    assert staged.exceptAll(rows).isEmpty() and rows.exceptAll(staged).isEmpty()
    folder = max(glob.glob(f"{scratch_root(spark).removeprefix('file:')}/pages-*"))
    group = pq.ParquetFile(glob.glob(f"{folder}/*.parquet")[0]).metadata.row_group(0)
    used = {group.column(c).path_in_schema: group.column(c).encodings for c in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in used["id"] and "DELTA_BYTE_ARRAY" in used["t"]
