"""Explicit schemas; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, BOOLEAN = T.StringType(), T.DoubleType(), T.BooleanType()
INT, BIGINT, DATE, TIMESTAMP_NTZ = T.IntegerType(), T.LongType(), T.DateType(), T.TimestampNTZType()
STRINGS = T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ROOM = struct(
    name=STRING, beds=STRING, size_sqm=INT, max_guests=INT, price_vnd=DOUBLE, cancellation=STRING
)

PAGE = struct(
    page_id=BIGINT, url=STRING, html=STRING, page_kind=STRING, city=STRING, page=INT,
    fetched_at=STRING, scrape_date=DATE,
)

RECORD = struct(
    scraped_at=STRING,
    hotel_id=STRING,
    name=STRING,
    url=STRING,
    location=struct(
        address=STRING, city=STRING, country=STRING, distance_from_center=STRING,
        latitude=DOUBLE, longitude=DOUBLE,
    ),
    detail=struct(
        description=STRING, checkin_time=STRING, checkout_time=STRING, languages=STRINGS
    ),
    pricing=struct(
        price_per_night_vnd=DOUBLE, original_price_vnd=DOUBLE, discount_pct=DOUBLE,
        currency=STRING, taxes_included=BOOLEAN, taxes_fees_text=STRING, meal_plan=STRING,
    ),
    rating=struct(
        score=DOUBLE, label=STRING, review_count=BIGINT,
        review_categories=T.MapType(STRING, DOUBLE),
    ),
    property=struct(
        type=STRING, star_rating=INT, availability_status=STRING, rooms_left=INT,
        room_types=T.ArrayType(ROOM),
    ),
    facilities=struct(popular=STRINGS, all=T.MapType(STRING, STRINGS)),
    badges=STRINGS,
    amenities=STRINGS,
    images=STRINGS,
)

# The flat row, nested columns as JSON text.
FLAT = struct(
    scrape_date=STRING, scraped_at=STRING, hotel_id=STRING, name=STRING, url=STRING,
    city=STRING, country=STRING, address=STRING, distance_from_center=STRING,
    latitude=DOUBLE, longitude=DOUBLE,
    price_per_night_vnd=DOUBLE, original_price_vnd=DOUBLE, discount_pct=DOUBLE,
    currency=STRING, taxes_included=BOOLEAN, taxes_fees_text=STRING,
    rating_score=DOUBLE, rating_label=STRING, review_count=BIGINT, review_categories=STRING,
    property_type=STRING, star_rating=INT, availability_status=STRING, rooms_left=INT,
    room_types=STRING, checkin_time=STRING, checkout_time=STRING, languages=STRING,
    description=STRING, facilities_popular=STRING, facilities_all=STRING,
    amenities=STRING, badges=STRING, images=STRING,
)
