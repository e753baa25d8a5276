"""Ranks, rollups and quantile summaries against plain versions."""

import math
import random

from pyspark.sql import functions as F

from roomledger.operators import gold, rank


def plain_ranks(rows):
    found = {}
    key = lambda v: (1, 0.0) if math.isnan(v) else (0, v + 0.0)
    for g, v in rows:
        if v is not None:
            found.setdefault(g, set()).add(key(v))
    places = {g: {v: i for i, v in enumerate(sorted(vs, reverse=True), 1)} for g, vs in found.items()}
    return sorted((str(g), str(v), None if v is None else places[g][key(v)]) for g, v in rows)


def test_rank_of_any_number(spark):
    random.seed(9)
    values = [None, -0.0, 0.0, math.nan, math.inf, -math.inf, 1e300, -1e-300, 2.0**60, -5.25, 0.1 + 0.2, 0.3]
    rows = [(random.choice(["x", "y", None]), random.choice(values)) for _ in range(300)]
    rows += [("hot", random.randrange(-50_000, 50_000) / 8) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = rank.dense_rank_in(frame, ["g"], "v").collect()
    fix = lambda v: v if v is None or v != 0 else 0.0
    assert sorted((str(r["g"]), str(fix(r["v"])), r["rank"]) for r in got) == plain_ranks([(g, fix(v)) for g, v in rows])
    assert rank.dense_rank_in(frame.limit(0), ["g"], "v").collect() == []
    whole = rank.dense_rank_in(spark.createDataFrame([(-3,), (2**62,), (-3,), (None,), (-(2**62),)], "v bigint"), [], "v")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted([(-3, 2), (2**62, 1), (-3, 2), (None, None), (-(2**62), 3)], key=str)


def test_rank_meets_few_rows_in_a_window(spark):
    """One group of 20,000 values: the window has a row per partition of the sort."""
    frame = spark.range(20_000).select(F.lit("one").alias("g"), (F.col("id") / 3 - 3000).alias("v"))
    got = rank.dense_rank_in(frame, ["g"], "v")
    assert got.where(F.col("rank") != 20_000 - F.round((F.col("v") + 3000) * 3)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") <= 6


def test_quantiles_lie_in_their_bounds_and_summaries_add_up(spark):
    random.seed(10)
    rows = [(random.choice("ab"), day, random.choice([None, 0, 7, -7, -random.randrange(10**9), random.randrange(10**12)])) for day in range(5) for _ in range(400)]
    rows += [("c", 0, None), ("d", 1, -(2**62)), ("d", 2, 2**62)]
    frame = spark.createDataFrame(rows, "city string, day int, cents bigint").repartition(4)
    daily = gold.quantile_summary(frame, ["city", "day"], "cents")
    added = gold.combine_summaries(daily, ["city"])
    at_once = gold.quantile_summary(frame, ["city"], "cents")
    assert sorted(map(tuple, added.select("city", "cell", "n").collect())) == sorted(map(tuple, at_once.collect()))
    shares = [0.0, 0.01, 0.5, 0.99, 1.0]
    got = gold.quantiles(added, ["city"], shares).collect()
    assert {r["city"] for r in got} == {"a", "b", "d"} and len(got) == 15
    for r in got:
        values = sorted(v for c, _, v in rows if c == r["city"] and v is not None)
        exact = values[max(math.ceil(r["share"] * len(values)), 1) - 1]
        assert r["n"] == len(values) and r["low"] <= exact <= r["high"]
        assert r["high"] - r["low"] <= abs(exact) * 2 ** (1 - gold.SUMMARY_BITS)


def test_rollup_of_partials_equals_one_over_rows(spark):
    rows = [("d1", "x", "hotel", 5), ("d1", "x", None, 7), ("d1", None, "hotel", None), ("d2", "x", "hotel", -4), ("d2", "y", "flat", 9)]
    frame = spark.createDataFrame(rows, "day string, city string, kind string, cents bigint")
    partials = gold.daily_partials(frame, ["day", "city", "kind"], "cents")
    got = {(r["day"], r["city"], r["kind"], r["depth"]): tuple(r)[4:] for r in gold.market_rollup(partials, ["day"], ["city", "kind"]).collect()}
    assert got[("d1", None, None, 0)] == (3, 6.0, 5, 7)
    assert got[("d1", None, None, 1)] == (1, None, None, None)  # the unnamed city
    assert got[("d1", "x", None, 1)] == (2, 6.0, 5, 7)
    assert got[("d1", "x", None, 2)] == (1, 7.0, 7, 7)  # the listing without a kind
    assert got[("d2", None, None, 0)] == (2, 2.5, -4, 9)
    assert len(got) == 11
