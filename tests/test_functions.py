"""Golden examples of the column library."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions import lists, numbers, places, reviews, text

CAND = "array<struct<prio:int,grp:int,text:string>>"


def each(spark, values, function, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}")
    result = frame.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in result]


def check(spark, function, pairs, kind="string"):
    got = each(spark, [p[0] for p in pairs], function, kind)
    for value, (source, expected) in zip(got, pairs):
        assert value == expected, (source, value, expected)


def test_score(spark):
    check(spark, numbers.score, [
        ("8.5", 8.5), ("Scored 8.5", 8.5), ("8,5", 8.5), ("8.5 Excellent", 8.5),
        ("8.55", 8.0), ("Score8.5", 5.0), ("100", None), ("0.5", None), ("", None), (None, None),
    ])


def test_review_count(spark):
    check(spark, numbers.review_count, [
        ("1,234 reviews", 1234), ("Based on 200 reviews", 200), ("2 nights", None),
        ("4.5 rating, 1,200 reviews", 5), ("none", None),
    ])


def test_price(spark):
    check(spark, numbers.price, [
        ("1.500.000", 1500000.0), ("1,500,000", 1500000.0), ("1500000", 1500000.0),
        ("1.500.000,00", 1500000.0), ("US$45.50", 45.5), ("1.500", 1500.0), ("1,500", 1500.0),
        ("45.50", 45.5), ("12,50", 12.5), ("12.3,4", 12.34), ("1.234.56", None), ("0", None),
        ("", None), (None, None), ("VND 2.000.000 ", 2000000.0), (".", None), ("1,500,000.50", 1500000.5),
    ])


def test_rooms_left(spark):
    check(spark, numbers.rooms_left, [
        ("Only 2 rooms left!", 2), ("Last room!", 1), ("3 rooms left at this price", 3),
        ("In high demand", None), ("last available unit", 1), (None, None),
    ])


def test_stars(spark):
    check(spark, numbers.stars, [("Rated 4 out of 5", 4), ("4-star hotel", 4), ("9 stars", None), (None, None)])
    check(spark, lambda c: numbers.stars(F.lit(None).cast("string"), c), [(3, 3), (7, None), (0, None)], "int")


def test_canonical_url(spark):
    host = "https://www.example.com"
    check(spark, places.canonical_url, [
        ("/hotel/vn/some-slug.en-gb.html?aid=1&x=2", f"{host}/hotel/vn/some-slug.html"),
        ("/hotel/vn/some-slug.vi.html#top", f"{host}/hotel/vn/some-slug.html"),
        ("http://other.example.org/a b/c|d.html;p=1?q", f"{host}/a b/c|d.html"),
        ("https://other.example.org", host),
        ("", None), (None, None),
    ])
    urls = each(spark, ["/hotel/vn/a.en-us.html?x", "x/y"], places.canonical_url)
    assert each(spark, urls, places.canonical_url) == urls


def test_slug(spark):
    check(spark, places.slug_id, [
        ("https://www.example.com/hotel/vn/some-slug.html", "some-slug"),
        ("https://www.example.com/other.html", None),
    ])


def test_rounding_equals_exact_binary_rounding(spark):
    random.seed(4)
    values = [12.25, 12.35, 0.15, 0.25, 99.95, 20.0, 0.05] + [
        (o - c) / o * 100
        for o, c in ((random.randint(2, 5000), random.randint(1, 5000)) for _ in range(3000))
        if o > c
    ]
    got = each(spark, values, lambda c: numbers.round_half_even(c, 1), "double")
    assert got == [round(v, 1) for v in values]
    values = [n / 1000 for n in range(1, 3000)] + [n * 1.609 for n in range(1, 500)]
    got = each(spark, values, lambda c: numbers.round_half_even(c, 2), "double")
    assert got == [round(v, 2) for v in values]


def test_discount(spark):
    rows = [(100.0, 80.0, 20.0), (80.0, 100.0, None), (None, 80.0, None), (0.0, 1.0, None)]
    frame = spark.createDataFrame(rows, "o double, c double, e double")
    for r in frame.withColumn("r", numbers.discount_percent(F.col("o"), F.col("c"))).collect():
        assert r["r"] == r["e"]


def test_taxes(spark):
    check(spark, numbers.taxes_included, [
        ("+ taxes and charges", False), ("Includes taxes", True), ("VAT", None),
        ("Taxes not included", False),
    ])


def test_review_block(spark):
    check(spark, reviews.review_block, [
        ("Review score\n8.5\nVery good\n1,234 reviews", (8.5, "Very good", 1234)),
        ("Scored 8.5\nGood\nBased on 200 reviews", (8.5, "Good", 200)),
        ("Very good\n8.1\n512 reviews", (8.1, "Very good", 512)),
        ("", (None, None, None)),
        ("Goodness\n45\nrating: 7,5", (7.5, None, None)),
    ])


def test_availability(spark):
    check(spark, lambda c: lists.availability(c == "SOLD", F.when(c != "SOLD", c)), [
        ("SOLD", ("sold_out", None)), ("", ("available", None)), ("Last room!", ("last_room", 1)),
        ("Only 2 rooms left!", ("limited", 2)), ("In high demand", ("limited", None)),
        ("Nice", ("available", None)),
    ])


def test_property_type(spark):
    nothing = F.array().cast(CAND)
    check(spark, lambda c: places.property_type(nothing, c), [
        ([(0, 0, "Capsule hotel")], "Hotel"), ([(0, 0, "Serviced apartment")], "Apartment"),
        ([(0, 0, "x" * 41), (0, 1, "Homestay")], "Homestay"), ([], None),
    ], CAND)


def test_times(spark):
    check(spark, numbers.time_of_day, [
        ("2:00 PM", "14:00"), ("From 14:00", "14:00"), ("14:00 – 24:00", "14:00"),
        ("12:30 AM", "00:30"), ("9:00", "9:00"), ("12:05 pm", "12:05"), ("noon", None), (None, None),
    ])


def test_places(spark):
    check(spark, places.nearby_place, [
        ("Airport 5 km", ("Airport 5 km", 5.0, "airport")),
        ("Beach 350 m", ("Beach 350 m", 0.35, "beach")),
        ("Museum 2 miles", ("Museum 2 miles", 3.22, "attraction")),
        ("Somewhere", ("Somewhere", None, "other")),
    ])


def test_tags_and_categories(spark):
    check(spark, lambda c: text.keywords_found(c, fixed.AMENITY_PHRASES), [
        ("spacious room with pool", ["swimming_pool", "spa"]), ("", []),
    ])
    check(spark, reviews.review_categories, [
        (["Staff\n9.2", "Facilities 8.1", "Staff 5.0"], {"staff": 9.2, "facilities": 8.1}),
        (["Staff 99", "Staff"], {}),
    ], "array<string>")


def test_badges_soft_cap(spark):
    many = [(0, i, f"Free thing {i}") for i in range(11)]
    more = [(1, i, f"Pool {i}") for i in range(4)]
    late = [(2, 0, "Parking")]
    noise = [(0, 20, "12345"), (0, 21, "https://free"), (0, 22, "***"), (0, 23, "plain text")]
    check(spark, lists.badges, [
        (many + noise + more + late, [c[2] for c in many + more]),
        (many + late + many, [c[2] for c in many + late]),
    ], CAND)


def test_facilities(spark):
    frame = spark.createDataFrame(
        [([(0, 0, "Pool"), (0, 2, "Pool")], [(0, 0, "Warm"), (0, 0, "Warm"), (0, 0, "Pool"),
                                              (0, 1, "Bar"), (0, 2, "Cold"), (0, 3, "")])],
        f"h {CAND}, i {CAND}",
    )
    got = frame.select(lists.facility_map(F.col("h"), F.col("i")).alias("m")).first()["m"]
    assert got == {"Pool": ["Cold"], "Group 2": ["Bar"]}


def test_images(spark):
    base = "https://img.example.com/"
    check(spark, lists.image_list, [
        ([(0, 0, base + "square240/a.jpg"), (0, 1, "data:x"), (1, 0, base + "max300/a.jpg"), (1, 1, base + "b")],
         [base + "max1280/a.jpg", base + "b"]),
    ], CAND)
    four = [(0, i, f"{base}{i}") for i in range(5)]
    check(spark, lists.card_images, [(four, [base + "0", base + "1", base + "2"])], CAND)


def test_room(spark):
    text_of = "Deluxe  2 double beds 30 m² max 3 guests x2 Free cancellation"
    row = spark.createDataFrame([(text_of,)], "t string").select(
        lists.room(F.lit("Deluxe"), F.col("t"), F.lit(None).cast("string"), F.lit("VND 900.000")).alias("r")
    ).first()["r"]
    assert tuple(row) == ("Deluxe", "2 double beds", 30, 3, 900000.0, "free")


def test_linked_data(spark):
    blobs = [
        ["{broken", '{"geo": {"latitude": 0, "longitude": 5}}',
         '{"@graph": [{"a": 1}, {"geo": {"latitude": 10.5, "longitude": "106.7"}, "address": {"streetAddress": " 1 Way ", "addressLocality": "Ward 1"}}]}'],
        ['{"latitude": 1.5, "longitude": 2.5, "address": " Plain 7 "}'],
        ['[{"latitude": 1.5, "longitude": 2.5}]'],
    ]
    nothing = F.lit(None).cast("string")
    got = each(spark, blobs, lambda c: places.coordinates(places.linked_items(c), nothing, nothing, nothing), "array<string>")
    assert [tuple(g) for g in got] == [(10.5, 106.7), (1.5, 2.5), (None, None)]
    got = each(spark, blobs, lambda c: places.linked_address(places.linked_items(c)), "array<string>")
    assert [g and tuple(g) for g in got] == [("1 Way", "Ward 1"), ("Plain 7", None), None]


def test_address_signal(spark):
    check(spark, places.looks_like_address, [
        ("12 QUẬN 1", True), ("Main Street 5", True), ("streetwise", False), ("road", False), ("q.7 here", True),
    ])


def test_squeeze_and_strip(spark):
    check(spark, text.squeeze, [(" a\n\n\n b  ", "a\n\nb"), ("a  b", "a  b")])


@pytest.mark.parametrize("value", ["", " None ", "null", "[]", "{}", None])
def test_blank(spark, value):
    assert each(spark, [value], text.is_blank) == [True]


def test_json_text_does_not_look_up_methods_by_row(spark):
    """A function called by its name looks its method up for every text inside of a lambda."""
    from roomledger.functions.jsontext import json_text

    rows = spark.createDataFrame([(["a", "b"],)], "t array<string>").select(json_text(F.col("t"), T.ArrayType(T.StringType())))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "valid_utf8" not in plan and "isvalid" not in plan


def test_a_review_block_is_only_read_for_what_the_elements_lack(spark):
    block = "Good\n8.1\n512 reviews"
    one = "array<struct<prio:int,grp:int,text:string>>"
    rows = spark.createDataFrame(
        [([(0, 0, block)], [(0, 0, "7.5")], [], [(0, 0, "Fine"), (0, 1, "9 reviews")]), ([(0, 0, block)], [], [], [])],
        f"b {one}, n {one}, r {one}, v {one}",
    )
    rating = reviews.card_rating(F.col("b"), F.col("n"), F.col("r"), F.col("v"))
    assert [tuple(r[0]) for r in rows.select(rating).collect()] == [(7.5, "Fine", 9), (8.1, "Good", 512)]
    # What is known is not read again: the lines of the first block would give another score.
    known = F.struct(F.lit(7.0).alias("score"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("bigint").alias("review_count"))
    assert tuple(rows.select(reviews.review_block(F.lit(block), known)).first()[0]) == (7.0, "Good", 512)
