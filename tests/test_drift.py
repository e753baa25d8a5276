"""Schema discovery and drift."""

from pyspark.sql import types as T

from roomledger.sources import drift


def day(spark, path, value, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{path}/scrape_date={value}")


def test_types_widen():
    w = drift.wider
    assert w(T.IntegerType(), T.LongType()) == T.LongType() and w(T.LongType(), T.FloatType()) == T.DoubleType()
    assert w(T.BooleanType(), T.LongType()) == T.StringType() and w(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    a, b = (T.StructType([T.StructField(n, k)]) for n, k in (("x", T.IntegerType()), ("y", T.StringType())))
    assert [f.name for f in w(a, b)] == ["x", "y"] and w(T.ArrayType(a), T.ArrayType(a)) == T.ArrayType(a)
    assert w(a, T.StringType()) == T.StringType()


def test_drift_and_one_schema(spark, tmp_path):
    path = str(tmp_path)
    day(spark, path, "2024-01-01", [(1, 5, (1,), None)], "id int, price int, room struct<a:int>, gone string")
    day(spark, path, "2024-01-02", [(2, 2.5, (1, "n"))], "id bigint, price double, room struct<a:int,b:string>")
    day(spark, path, "2024-01-02", [(3, 3.5, "late file")], "id bigint, price double, note string")
    day(spark, path, "2024-01-03", [("h4", 1, "back")], "id string, price int, gone string")
    days = drift.day_schemas(spark, path)
    assert [d for d, _ in days] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    got = {tuple(r) for r in drift.drift(spark, days).collect()}
    assert got == {
        ("2024-01-02", "id", "retyped", "int", "bigint"), ("2024-01-02", "price", "retyped", "int", "double"),
        ("2024-01-02", "room", "retyped", "struct<a:int>", "struct<a:int,b:string>"), ("2024-01-02", "gone", "missing", "string", None),
        ("2024-01-02", "note", "added", None, "string"), ("2024-01-03", "id", "retyped", "bigint", "string"),
        ("2024-01-03", "price", "retyped", "double", "int"), ("2024-01-03", "gone", "back", "string", "string"),
        ("2024-01-03", "room", "missing", "struct<a:int,b:string>", None), ("2024-01-03", "note", "missing", "string", None),
    }
    rows = {r["id"]: r for r in drift.read_all(spark, path, days).collect()}
    assert set(rows) == {"1", "2", "3", "h4"}
    assert rows["1"]["price"] == 5.0 and rows["1"]["room"] == (1, None) and rows["1"]["scrape_date"] == "2024-01-01"
    assert rows["3"]["note"] == "late file" and rows["3"]["room"] is None and rows["h4"]["gone"] == "back"


def test_equal_days_do_not_drift(spark, tmp_path):
    for d in (1, 2):
        day(spark, str(tmp_path), f"2024-01-0{d}", [(d,)], "id int")
    days = drift.day_schemas(spark, str(tmp_path))
    assert drift.drift(spark, days).count() == 0
    assert drift.read_all(spark, str(tmp_path), days).count() == 2
