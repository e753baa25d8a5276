"""What the plans must look like to hold at scale."""

import datetime

import pytest

from roomledger.plans.queries import QUERIES
from roomledger.operators import coverage, merge
from roomledger.sources import layers


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_merge_has_one_shuffle(spark, sf):
    assert plan(QUERIES["observation_upsert"](spark, sf)).count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["structured_search"](spark, sf))
    assert "TakeOrderedAndProject" in text and "s_acctbal" not in text
    assert "In(n_name" in text


WITH_PYTHON = {
    "page_fields", "page_links", "card_records", "detail_records", "enriched_records",
    "flatten_record", "enrichment_counts", "room_table", "rejected_pages", "places_table",
    "search_near_place", "record_completeness", "card_dumps",
}
WRITING = {
    "daily_silver", "daily_two_batches", "child_gold_tables", "jsonl_untyped_values", "jsonl_roundtrip", "jsonl_scan", "jsonl_line_counts", "csv_roundtrip",
    "csv_rebuild", "snapshot_lines", "medallion", "stream_upsert", "stream_replays",
    "batch_split_merge", "file_store_upsert", "file_store_counters",
    "jsonl_key_states", "jsonl_nested_records", "html_file_pages", "stored_pages",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert ("Python" in text or "MapInArrow" in text) == (name in WITH_PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_silver_refresh_prunes_bronze_days(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", 1, "x", datetime.date(2024, 1, d)) for d in range(1, 6)],
        "k string, seq bigint, v string, day date",
    )
    layers.append_bronze(rows, str(tmp_path / "b"), "day")
    layers.append_bronze(rows.where("day = '2024-01-02'"), str(tmp_path / "c"), "day")
    bronze = spark.read.parquet(str(tmp_path / "b"))
    touched = spark.read.parquet(str(tmp_path / "c")).where("seq = 1")
    merged = merge.merge_rows(
        bronze.join(touched.select("day").distinct(), "day", "left_semi"), ["k", "day"], ["seq"]
    )
    assert "dynamicpruning" in plan(merged)


def test_rotation(spark):
    days = spark.createDataFrame([(datetime.date(2023, 1, d),) for d in (1, 2, 6)], "day date")
    got = {}
    for r in coverage.rotation(days, "day", 31, 6).orderBy("day", "slot").collect():
        got.setdefault(r["day"].day, []).append(r["position"])
    assert got == {1: [0, 1, 2, 3, 4, 5], 2: [6, 7, 8, 9, 10, 11], 6: [30, 0, 1, 2, 3, 4]}


def test_pages_of_one_split_are_dealt_without_the_setting(spark, sf):
    from roomledger.plans.queries import listings, pages
    from roomledger.session import dealt

    setting = spark.conf.get("spark.roomledger.tasks", None)
    spark.conf.unset("spark.roomledger.tasks")
    try:
        least = spark.sparkContext.defaultParallelism
        assert dealt(spark.range(0, 100, 1, 1), 1).rdd.getNumPartitions() == max(100, least)
        assert dealt(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 1
        for made in (listings.search_pages, listings.detail_pages):
            assert made(spark, sf).rdd.getNumPartitions() == least
    finally:
        if setting:
            spark.conf.set("spark.roomledger.tasks", setting)


def test_places_look_for_no_other_field(spark, sf):
    from pyspark.sql import functions as F

    from roomledger.plans import listing
    from roomledger.plans.queries import listings

    pages = listings.detail_pages(spark, sf)
    found = listing.extract_details(pages, only=["loaded", "place"])
    every = listing.extract_details(pages)
    assert found.schema == every.schema
    assert found.where((F.size("image") > 0) | (F.size("linked_data") > 0)).isEmpty()
    few, all_ = (
        {(r["hotel_id"], r["pos"], r["name"], r["distance_km"], r["type"]) for r in listing.child_places(d).collect()}
        for d in (listing.detail_records(found, only=["places"]), listing.detail_records(every))
    )
    assert few == all_ and few


def test_parts_of_room_rows_are_dealt_without_the_setting(spark, sf, monkeypatch):
    from roomledger.plans.queries import texts

    setting = spark.conf.get("spark.roomledger.tasks", None)
    spark.conf.unset("spark.roomledger.tasks")
    monkeypatch.setattr(texts, "PARTS", 10)
    try:
        parts = texts.table(spark, sf, "part").count()
        tasks = texts.room_rows(spark, sf).rdd.getNumPartitions()
        assert tasks == max(-(-parts // 10), spark.sparkContext.defaultParallelism)
    finally:
        if setting:
            spark.conf.set("spark.roomledger.tasks", setting)


@pytest.mark.parametrize("name", ["original_price_candidates", "price_parse", "discount_and_tax", "review_block"])
def test_rows_of_short_texts_are_dealt_without_the_setting(spark, sf, monkeypatch, name):
    from roomledger.plans.queries import texts

    setting = spark.conf.get("spark.roomledger.tasks", None)
    spark.conf.unset("spark.roomledger.tasks")
    monkeypatch.setattr(texts, "ROWS", 50)
    try:
        rows = texts.table(spark, sf, "events" if name == "review_block" else "lineitem").count()
        tasks = QUERIES[name](spark, sf).rdd.getNumPartitions()
        assert tasks == max(-(-rows // 50), spark.sparkContext.defaultParallelism)
    finally:
        if setting:
            spark.conf.set("spark.roomledger.tasks", setting)


def test_pages_are_written_as_files_by_more_than_one_task(spark, sf, monkeypatch):
    from roomledger import session
    from roomledger.plans.queries import stores

    dealt = []
    monkeypatch.setattr(stores, "dealt", lambda rows, each: dealt.append(session.dealt(rows, each)) or dealt[-1])
    assert QUERIES["html_file_pages"](spark, sf).count() == stores.table(spark, sf, "pages").count()
    assert dealt[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name, cards, details", [
    ("enrichment_counts", {"href"}, {"loaded"}),
    ("room_table", {"href"}, {"loaded", "room_name", "room_row", "room_occupancy", "room_occupancy_text", "room_price"}),
    ("record_completeness", {"href", "name", "price", "image"}, {"loaded", "description", "subscore", "popular"}),
])
def test_pages_are_searched_for_what_the_query_reads(spark, sf, monkeypatch, name, cards, details):
    from roomledger.plans import listing

    asked = []
    plain = listing.extract
    monkeypatch.setattr(listing, "extract", lambda *args, **named: asked.append(named.get("only")) or plain(*args, **named))
    QUERIES[name](spark, sf)
    assert None not in asked and cards <= set(asked[0]) and details <= set(asked[1])
    assert not {"badge", "card_text", "type_hint", "language", "facility_item"} & {*asked[0], *asked[1]}
