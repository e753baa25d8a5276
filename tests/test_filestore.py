"""The file stores beside their queries: counters of the write, buckets and their manifest."""

from pyspark.sql import functions as F

from roomledger.operators import merge
from roomledger.plans.filestore import read_buckets, upsert_buckets, upsert_files
from roomledger.schema import BIGINT, STRING, struct

KEYS = ("hotel", "day")
STORED = struct(hotel=STRING, day=STRING, price=BIGINT, note=STRING)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def batch(spark, rows):
    return spark.createDataFrame(rows, "hotel string, day string, price bigint, note string, seq bigint")


def test_counters_need_no_second_pass(spark, tmp_path):
    one = batch(spark, [("a", "1", 5, "n", 1), ("a", "1", 6, "n", 2), ("b", None, 7, None, 3)])
    counters = upsert_files(spark, one, ["seq"], None, f"{tmp_path}/one", None, KEYS, STORED)
    assert counters.inputFiles() == [] and tuple(counters.first()) == (2, 1, 2)
    two = batch(spark, [("a", "1", 9, "n", 4), ("c", "", 1, "n", 5), ("b", "", 8, "n", 6)])
    counters = upsert_files(spark, two, ["seq"], f"{tmp_path}/one", f"{tmp_path}/two", None, KEYS, STORED)
    assert tuple(counters.first()) == (1, 2, 3)
    empty = upsert_files(spark, two.limit(0), ["seq"], f"{tmp_path}/two", f"{tmp_path}/three", None, KEYS, STORED)
    assert tuple(empty.first()) == (0, 0, 3)


def test_bucketed_store_equals_one_merge(spark, tmp_path):
    store = str(tmp_path)
    rows = [(f"h{i % 40}", str(i % 3), i, "note" * (i % 9), i) for i in range(400)] + [(None, None, 1, "x", 500), ("", "", 2, "y", 501)]
    parts = [batch(spark, [r for r in rows if r[4] % 4 == k]) for k in range(4)]
    sums = [upsert_buckets(spark, p, ["seq"], store, KEYS, STORED, 8).first() for p in parts]
    store_rows = None
    for p in parts:
        p = p.withColumns({k: F.coalesce(k, F.lit("")) for k in KEYS})
        before = (p.limit(0) if store_rows is None else store_rows).select(*STORED.names).withColumn("seq", F.lit(0).cast("bigint"))
        store_rows = merge.upsert(before, p, list(KEYS), ["seq"])
    assert rows_of(read_buckets(spark, store, KEYS, STORED)) == rows_of(store_rows.select(*STORED.names))
    assert sum(s["inserted"] for s in sums) == store_rows.count() and all(s["rewritten"] <= 8 for s in sums)


def test_a_version_counts_once_it_is_committed(spark, tmp_path):
    store = str(tmp_path)
    first = batch(spark, [(f"h{i}", "1", i, "n", i) for i in range(100)])
    upsert_buckets(spark, first, ["seq"], store, KEYS, STORED, 16)
    want = rows_of(read_buckets(spark, store, KEYS, STORED))
    # The rows of a write that failed before its commit.
    read_buckets(spark, store, KEYS, STORED).withColumns({"price": F.lit(0), "bucket": F.lit(3)}).write.partitionBy("bucket").json(f"{store}/data/version=2")
    assert rows_of(read_buckets(spark, store, KEYS, STORED)) == want
    done = upsert_buckets(spark, batch(spark, [("h5", "1", 70, "n", 900)]), ["seq"], store, KEYS, STORED, 16).first()
    assert done["rewritten"] == 1 and (done["inserted"], done["updated"]) == (0, 1)
    rows = {r["hotel"]: r["price"] for r in read_buckets(spark, store, KEYS, STORED).collect()}
    assert rows == {f"h{i}": 70 if i == 5 else i for i in range(100)}
