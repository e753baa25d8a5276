"""Line files, CSV, snapshots and layered tables."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.plans import listing
from roomledger.schema import BIGINT, DATE, FLAT, STRING, struct
from roomledger.sources import csvfile, jsonl, layers


def write(path, lines):
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def test_lines_last_wins_and_bad_lines(spark, tmp_path):
    lines = [
        json.dumps({"hotel_id": "a", "scrape_date": "2024-01-01", "name": "first"}),
        "", "   ", "{broken", "[1, 2]", '"text"', "7",
        json.dumps({"hotel_id": "a", "scrape_date": "2024-01-01", "name": "Phở", "extra": 1}, ensure_ascii=False),
        json.dumps({"scrape_date": "2024-01-01", "name": "no id"}),
        json.dumps({"hotel_id": None, "scrape_date": "2024-01-01", "name": "null id"}),
    ]
    path = write(tmp_path / "store.jsonl", lines)
    rows = jsonl.read_store(spark, path).collect()
    assert {(r["hotel_id"], r["name"]) for r in rows} == {("a", "Phở"), ("", "null id")}
    assert jsonl.rejected_lines(spark, path).count() == 4
    assert jsonl.count_lines(spark, path).first()["lines"] == 8


def test_long_line_file_keeps_line_order(spark, tmp_path):
    lines = [json.dumps({"hotel_id": f"h{i % 50}", "scrape_date": "d", "name": str(i)}) for i in range(60000)]
    path = write(tmp_path / "long.jsonl", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert jsonl.read_lines(spark, path).rdd.getNumPartitions() > 3
        rows = jsonl.read_store(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["hotel_id"]: r["name"] for r in rows} == {f"h{i}": str(59950 + i) for i in range(50)}


def test_jsonl_sink_writes_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("a", None)], "hotel_id string, name string")
    jsonl.write_jsonl(rows, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text) == {"hotel_id": "a", "name": None}


def test_csv_rebuild(spark, tmp_path):
    source = write(tmp_path / "s.jsonl", [
        json.dumps({"hotel_id": "a", "scrape_date": "2024-01-01", "name": 'say "hi",\nthere ', "latitude": None,
                    "badges": "[\"x\", \"y\"]", "meal_plan": "dropped"}),
    ])
    target = str(tmp_path / "csv")
    assert csvfile.rebuild_csv(spark, source, target) == 1
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert text.splitlines()[0].split(",") == fixed.FLAT_COLUMNS
    row = csvfile.read_csv(spark, target).first()
    assert row["name"] == 'say "hi",\nthere ' and row["badges"] == '["x", "y"]' and row["latitude"] is None
    empty = write(tmp_path / "e.jsonl", ["", "{"])
    assert csvfile.rebuild_csv(spark, empty, str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()


def test_flat_columns_match_schema():
    assert FLAT.names == fixed.FLAT_COLUMNS and len(fixed.FLAT_COLUMNS) == 35
    assert {c: listing.kind_of(c).simpleString() for c in ("badges", "rating_score")} == {
        "badges": "array<string>", "rating_score": "double"}


def test_file_store(spark, tmp_path):
    from roomledger.plans.filestore import upsert_files

    def batch(*rows):
        full = [dict({c: None for c in FLAT.names}, scrape_date="d", **r) for r in rows]
        table = spark.createDataFrame([tuple(r[c] for c in FLAT.names) for r in full], FLAT)
        return table.coalesce(1).selectExpr("*", "monotonically_increasing_id() as seq")

    first = batch({"hotel_id": "a", "name": "x" * 25, "badges": '["a", "b", "c", "d", "e"]', "rating_score": 8.0},
                  {"hotel_id": "a", "name": "y" * 24, "badges": "[]"}, {"hotel_id": None, "name": "lost"})
    got = upsert_files(spark, first, ["seq"], None, str(tmp_path / "1"), str(tmp_path / "c1"))
    assert tuple(got.first()) == (2, 1, 2)
    second = batch({"hotel_id": "a", "name": "z" * 26, "badges": '["f"]', "rating_score": 7.5}, {"hotel_id": "b"})
    got = upsert_files(spark, second, ["seq"], str(tmp_path / "1"), str(tmp_path / "2"), str(tmp_path / "c2"))
    assert tuple(got.first()) == (1, 1, 3)
    rows = {r["hotel_id"]: r for r in jsonl.read_store(spark, str(tmp_path / "2")).collect()}
    assert set(rows) == {"a", "b", ""}
    assert (rows["a"]["name"], rows["a"]["badges"], rows["a"]["rating_score"]) == (
        "z" * 26, '["a", "b", "c", "d", "e"]', 7.5)
    assert csvfile.read_csv(spark, str(tmp_path / "c2")).count() == 3


def test_html_files(spark, tmp_path):
    from roomledger.sources.html import extract
    from roomledger.sources.matchers import web_rules
    from roomledger.sources.pages import read_html_files

    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.html").write_text("<title>Một</title><h1>x</h1>", encoding="utf-8")
    (tmp_path / "in" / "deep" / "b.html").write_text("<title>Hai</title>", encoding="utf-8")
    (tmp_path / "in" / "c.txt").write_text("no", encoding="utf-8")
    pages = extract(read_html_files(spark, str(tmp_path / "in")), web_rules())
    assert {r["page_title"] for r in pages.collect()} == {"Một", "Hai"}


def test_publish(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        layers.publish_snapshot(spark, str(tmp_path / "missing"), str(tmp_path / "out"))
    source = write(tmp_path / "s.jsonl", ['{"a": 1}', '{"a": 2}'])
    for _ in range(2):
        layers.publish_snapshot(spark, source, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_silver_rewrites_only_touched_days(spark, tmp_path):
    one, two = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    schema = struct(k=STRING, seq=BIGINT, v=STRING, scrape_date=DATE)
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    first = spark.createDataFrame([("a", 1, "x", one), ("a", 1, "p", two)], schema)
    late = spark.createDataFrame([("a", 2, "y", two)], schema)
    for number, batch in enumerate([first, late, late]):
        layers.put_batch(batch, bronze, min(number, 1))
        rows = layers.read_layer(spark, bronze, schema)
        before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "silver").glob("*/part*")}
        layers.refresh_silver(rows, batch, silver, ["k", "scrape_date"], ["seq"])
    after = {p.name for p in (tmp_path / "silver").glob("scrape_date=2024-01-01/part*")}
    assert after <= set(before)
    got = layers.read_layer(spark, silver, struct(k=STRING, v=STRING, scrape_date=DATE)).collect()
    assert {(r["k"], r["scrape_date"], r["v"]) for r in got} == {("a", one, "x"), ("a", two, "y")}
    assert layers.read_layer(spark, bronze, schema).count() == 3


def test_line_store_keeps_every_object(spark, tmp_path):
    lines = [
        '{"hotel_id": "a", "scrape_date": "d", "latitude": "", "review_count": 10.0, "taxes_included": ""}',
        '{"hotel_id": "b", "scrape_date": "d", "latitude": "1.5", "review_count": "12", "taxes_included": true}',
        '{"hotel_id": "c", "scrape_date": "d", "latitude": null, "review_count": 1.5, "name": 7}',
        '{"hotel_id": "d", "scrape_date": "d", "latitude": {"x": 1}}',
    ]
    path = write(tmp_path / "u.jsonl", lines)
    rows = {r["hotel_id"]: r for r in jsonl.read_store(spark, path).collect()}
    assert set(rows) == set("abcd") and jsonl.rejected_lines(spark, path).count() == 0
    assert rows["a"]["latitude"] is None and rows["a"]["review_count"] == 10 and rows["a"]["taxes_included"] is None
    assert rows["b"]["latitude"] == 1.5 and rows["b"]["review_count"] == 12 and rows["b"]["taxes_included"] is True
    assert rows["c"]["review_count"] is None and rows["c"]["name"] == "7" and rows["d"]["latitude"] is None


def test_a_renewed_checkpoint_adds_to_bronze(spark, tmp_path):
    from roomledger.streaming.upsert import upsert_stream

    schema = "k string, v string, n bigint, scrape_date date"
    for key, value, number in (("a", "x", 1), ("b", "y", 1), ("a", "z", 0)):
        folder = str(tmp_path / f"in-{key}-{value}")
        spark.sql(f"SELECT '{key}' k, '{value}' v, {number}L n, DATE'2024-05-01' scrape_date").write.parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        upsert_stream(
            stream, str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / f"checkpoint-{value}"), ["k", "scrape_date"], ["n"]
        ).awaitTermination()
    silver = spark.read.schema("k string, v string, scrape_date date").parquet(str(tmp_path / "s"))
    assert {(r["k"], r["v"]) for r in silver.collect()} == {("a", "z"), ("b", "y")}


def test_a_repeated_batch_replaces_all_its_days(spark, tmp_path):
    from roomledger.sources import layers

    rows = spark.sql("SELECT 'a' k, DATE'2024-05-01' scrape_date UNION ALL SELECT 'b', DATE'2024-05-02'")
    layers.put_batch(rows, str(tmp_path / "b"), 3)
    layers.put_batch(rows.where("k = 'a'"), str(tmp_path / "b"), 3)
    assert [r["k"] for r in spark.read.parquet(str(tmp_path / "b")).collect()] == ["a"]


def test_rank_bound(spark):
    from roomledger.operators.rank import dense_rank_in

    """Values of any size and sign are ranked."""
    rows = spark.createDataFrame([("g", v) for v in (1 << 62, 1 << 32, -1, -(1 << 62))], "g string, v bigint")
    ranks = {r["v"]: r["rank"] for r in dense_rank_in(rows, ["g"], "v").collect()}
    assert ranks == {1 << 62: 1, 1 << 32: 2, -1: 3, -(1 << 62): 4}


def test_catalogued_table(spark, tmp_path):
    rows = spark.sql("SELECT 'a' k, 1 n, DATE'2024-05-01' day, 'x' dropped")
    schema = struct(k=STRING, n=BIGINT, day=DATE)
    for _ in range(2):
        layers.save_table(rows, "roomledger_saved", schema, str(tmp_path / "t"), ["day"])
    try:
        saved = spark.table("roomledger_saved")
        assert saved.schema.simpleString() == "struct<k:string,n:bigint,day:date>"
        assert [tuple(r) for r in saved.collect()] == [("a", 1, datetime.date(2024, 5, 1))]
    finally:
        spark.sql("DROP TABLE roomledger_saved")


def test_values_and_states_of_keys_from_one_parse(spark, tmp_path):
    path = write(tmp_path / "v.jsonl", [
        '{"a": 7.0, "b": {"c": "3"}, "l": ["x"]}', '{"a": null, "b": {"c": 1.5}}', '{"a": " ", "b": null, "l": "x"}',
        '{"b": {}}', "[1]", '{"a": 1, "a": 2}', "{", "null",
    ])
    lines = jsonl.read_variants(spark, path)
    fields = {"a": BIGINT, "b.c": BIGINT, "l": T.ArrayType(STRING)}
    at = [jsonl.value_at(F.col("record"), p, k).alias(p.replace(".", "_")) for p, k in fields.items()]
    frame = lines.select(*at)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in frame.collect()] == [(7, 3, ["x"]), (None, None, None), (None, None, None), (None, None, None)]
    assert plan.lower().count("parsejson") == 1
    states = {r["path"]: tuple(r)[1:] for r in jsonl.key_states(lines, fields).collect()}
    # path: absent, nulls, empty, given, unfit
    assert states == {"a": (1, 1, 1, 1, 0), "b.c": (2, 0, 0, 2, 1), "l": (2, 0, 0, 2, 1)}
    empty = jsonl.read_variants(spark, write(tmp_path / "none.jsonl", []))
    assert empty.count() == 0 and jsonl.key_states(empty, fields).count() == 0
