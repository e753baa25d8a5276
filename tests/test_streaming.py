"""The state of winners and the removal of replays, beside their queries."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from roomledger.operators import merge
from roomledger.streaming import replays, state

KEYS, SEQ = ["item", "day"], ["at"]
SCHEMA = "item string, day date, at bigint, note string, tags array<string>, price double, room struct<name:string>"


def made(n):
    random.seed(8)
    texts = [None, "", "[]", "short", "x" * 20, "a text of more than twenty", "another text of over twenty", "y" * 26]
    day = lambda: random.choice([None, *(datetime.date(2024, 1, d) for d in (1, 2, 3))])
    return [
        (random.choice([None, "a", "b"]), day(), i, random.choice(texts), random.choice([None, [], ["pool"], ["pool", "a very long name of it"]]),
         random.choice([None, 1.0, 2.5]), random.choice([None, ("r",)]))
        for i in range(n)
    ]


def rows_of(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def test_states_combine_in_any_grouping(spark):
    rows = spark.createDataFrame(made(300), SCHEMA)
    want = rows_of(merge.merge_rows(rows, KEYS, SEQ))
    parts = [rows.where(F.col("at") % 3 == i) for i in (2, 0, 1, 2)]  # one of them twice
    states = [merge.merge_state(p, KEYS, SEQ) for p in parts]
    left = merge.combine_states(states[0].unionByName(states[1]), KEYS)
    all_ = merge.combine_states(left.unionByName(states[2]).unionByName(states[3]), KEYS)
    assert rows_of(merge.state_values(all_, KEYS)) == want


def test_state_batches_repeat_and_fail_without_harm(spark, tmp_path):
    rows = spark.createDataFrame(made(200), SCHEMA)
    home = str(tmp_path)
    schema = state.state_schema(rows, KEYS, SEQ)
    assert state.read_silver(spark, home, schema, KEYS, "day").count() == 0
    for i in (0, 1, 1, 2):  # the second batch is written again
        state.merge_batch(rows.where(F.col("at") % 3 == i), home, f"v{i}", KEYS, SEQ, "day")
    # A version that was never committed is not seen.
    state.read_state(spark, home, schema, "day").where("item = 'a'").write.partitionBy("day").parquet(f"{home}/data/version=v9")
    want = rows_of(merge.merge_rows(rows, KEYS, SEQ))
    assert rows_of(state.read_silver(spark, home, schema, KEYS, "day")) == want
    log = {r["version"]: r for r in state.commits(spark, home, schema["day"]).collect()}
    assert set(log) == {"v0", "v1", "v2"} and log["v2"]["batch_rows"] == 66
    assert log["v0"]["state_rows"] == 0 and log["v2"]["state_rows"] <= 12
    assert set(state.drop_superseded(spark, home, schema["day"])) <= {"v0", "v1"}
    assert rows_of(state.read_silver(spark, home, schema, KEYS, "day")) == want
    state.merge_batch(rows.limit(0), home, "v3", KEYS, SEQ, "day")
    assert rows_of(state.read_silver(spark, home, schema, KEYS, "day")) == want


def test_only_the_days_of_a_batch_are_read(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), datetime.date(2024, 1, 1 + i % 2), i, "n", None, None, None) for i in range(40)], SCHEMA)
    home, schema = str(tmp_path), state.state_schema(rows, KEYS, SEQ)
    first, second = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    state.merge_batch(rows, home, "v0", KEYS, SEQ, "day")
    state.merge_batch(rows.where(F.col("day") == first), home, "v1", KEYS, SEQ, "day")
    log = {(r["version"], r["day"]): r["state_rows"] for r in state.commits(spark, home, schema["day"]).collect()}
    assert log == {("v0", first): 0, ("v0", second): 0, ("v1", first): 20}
    files = state.read_state(spark, home, schema, "day").inputFiles()
    assert any("version=v0" in f for f in files) and any("version=v1" in f for f in files)


@pytest.mark.parametrize("again", [False, True])
def test_replays_and_late_rows(spark, tmp_path, again):
    home = str(tmp_path)
    schema = "id bigint, ts timestamp, note string"
    at = lambda day, hour=0: datetime.datetime(2024, 1, day, hour)
    batches = [
        [(1, at(1), "a"), (2, at(2), "b"), (None, at(2), "null id"), (9, None, "no time")],
        [(1, at(1), "a"), (3, at(10), "c"), (2, at(2), "b")],
        [(4, at(7), "behind"), (5, at(1), "late"), (5, at(2), "late again"), (1, at(1), "late replay"), (None, at(9), "null id"), (6, at(8), "on the mark")],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{home}/in")
        if again:  # a query per file, each going on from the checkpoint
            run(spark, home, schema)
    run(spark, home, schema)
    kind = spark.createDataFrame([], schema).schema
    main = {(r["id"], r["note"]) for r in replays.main_rows(spark, home, kind).collect()}
    late = {(r["id"], r["note"]) for r in replays.late_rows(spark, home, kind, ["id"], "ts").collect()}
    assert {i for i, _ in main} == {1, 2, 3, None, 9}
    assert late == {(4, "behind"), (5, "late"), (6, "on the mark")}
    log = {r["batch"]: r["late"] for r in replays.split_commits(spark, home).collect()}
    assert log == {0: 0, 1: 0, 2: 5}


def run(spark, home, schema):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    replays.split_stream(stream, home, "ts", "2 days").awaitTermination()
    replays.distinct_stream(spark, home, spark.createDataFrame([], schema).schema, ["id"], "ts", "2 days").awaitTermination()
