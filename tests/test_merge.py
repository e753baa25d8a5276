"""The merge rule against a plain fold over the sequence."""

import random

from pyspark.sql import functions as F

from roomledger.operators import merge, rank

BLANK = {"", "None", "null", "[]", "{}"}


def fold(values):
    """Apply the rule one value after the other."""
    kept = values[0]
    for new in values[1:]:
        n = (new or "").strip()
        o = (kept or "").strip()
        if n in BLANK:
            continue
        if o in BLANK or len(o) < 20 or len(n) > len(o):
            kept = new
    return kept


def sequences(count, seed=7):
    random.seed(seed)
    pool = [None, "", " ", "None", "null", "[]", "{}", "a", "bb ", " ccc", "x" * 19, "y" * 20,
            "z" * 20, "w" * 21, "v" * 26, " " + "u" * 26 + " ", "t" * 30]
    return {k: [random.choice(pool) for _ in range(random.randint(1, 9))] for k in range(count)}


def frame(spark, data):
    rows = [(k, i, v) for k, values in data.items() for i, v in enumerate(values)]
    random.shuffle(rows)
    return spark.createDataFrame(rows, "k int, seq bigint, v string")


def test_merge_equals_fold(spark):
    data = sequences(3000)
    merged = merge.merge_rows(frame(spark, data), ["k"], ["seq"]).collect()
    assert {r["k"]: r["v"] for r in merged} == {k: fold(v) for k, v in data.items()}


def test_merge_ignores_repeated_delivery(spark):
    rows = frame(spark, sequences(300))
    once = {r["k"]: r["v"] for r in merge.merge_rows(rows, ["k"], ["seq"]).collect()}
    twice = merge.merge_rows(rows.unionByName(rows), ["k"], ["seq"]).collect()
    assert {r["k"]: r["v"] for r in twice} == once


def test_upsert_in_two_batches_equals_fold(spark):
    data = sequences(500, seed=9)
    rows = frame(spark, data)
    store = merge.merge_rows(rows.where("seq < 3"), ["k"], ["seq"]).withColumn("seq", F.lit(0))
    both = merge.upsert(store.select("k", F.col("seq").cast("bigint").alias("seq"), "v"),
                        rows.where("seq >= 3"), ["k"], ["seq"]).collect()
    assert {r["k"]: r["v"] for r in both} == {k: fold(v) for k, v in data.items()}


def test_typed_columns_and_null_keys(spark):
    rows = spark.createDataFrame(
        [(None, 1, 10.0, ["a"] * 8, True), (None, 2, None, [], None), (None, 3, 9.0, ["b"], False),
         (5, 1, None, None, None)],
        "k int, seq bigint, n double, tags array<string>, f boolean",
    )
    got = {r["k"]: (r["n"], r["tags"], r["f"]) for r in merge.merge_rows(rows, ["k"], ["seq"]).collect()}
    assert got == {None: (9.0, ["a"] * 8, False), 5: (None, None, None)}
    latest = merge.merge_rows(rows, ["k"], ["seq"], {"tags": merge.LATEST}).where("k is null").first()
    assert latest["tags"] == ["b"]


def test_counters(spark):
    empty = spark.createDataFrame([], "k string, d string")
    batch = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1")], "k string, d string")
    assert tuple(merge.upsert_counters(empty, batch, ["k", "d"]).first()) == (2, 1, 2)
    store = spark.createDataFrame([("a", "1"), (None, "1")], "k string, d string")
    more = batch.unionByName(spark.createDataFrame([(None, "1")], "k string, d string"))
    assert tuple(merge.upsert_counters(store, more, ["k", "d"]).first()) == (1, 3, 3)
    assert [tuple(r) for r in merge.inserted_keys(store, more, ["k", "d"]).collect()] == [("b", "1")]


def test_dense_rank_over_all_digits(spark):
    random.seed(3)
    rows = [("a", random.choice([random.randint(0, 70), random.randint(0, 2**40)])) for _ in range(2000)]
    rows += [("b", v) for v in (0, 65535, 65536, 65536, 2**32, 2**32 + 1)] + [("a", 5)] * 50
    table = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r["g"], r["v"]): r["rank"] for r in rank.dense_rank_in(table, ["g"], "v").collect()}
    for g in "ab":
        order = sorted({v for h, v in rows if h == g}, reverse=True)
        assert {v: got[g, v] for v in order} == {v: i + 1 for i, v in enumerate(order)}
    assert rank.dense_rank_in(table, ["g"], "v").count() == len(rows)
    holes = spark.createDataFrame([(None, 3), (None, 9), ("a", None), ("a", 1)], "g string, v bigint")
    ranked = rank.dense_rank_in(holes, ["g"], "v").collect()
    assert {(r["g"], r["v"], r["rank"]) for r in ranked} == {
        (None, 3, 2), (None, 9, 1), ("a", None, None), ("a", 1, 1)}


def test_values_are_measured_once(spark):
    """The plan of a merge trims a text twice, for its size and to tell blank ones, and writes a list once."""
    rows = spark.range(3).selectExpr("id AS k", "id AS seq", "concat(' ', id) AS v", "array(string(id)) AS list")
    stored = rows.localCheckpoint()
    for merged in (merge.merge_rows(stored, ["k"], ["seq"]), merge.merge_state(stored, ["k"], ["seq"])):
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("trim(") == 2
        assert plan.count("transform(") == 1
