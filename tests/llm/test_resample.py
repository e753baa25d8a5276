"""Importance resampling against a plain version of it."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roomledger.llm import resample
from test_operators import SCHEMA, empty, odd

NAMES = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text, run):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, draw):
    bucket = lambda f: zlib.crc32(f.encode()) % draw.buckets
    found = [(doc_id, *features(text, draw.run)) for doc_id, text in docs]
    s = Counter(bucket(f) for _, _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, draw.run)[1])
    n, m = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, words, fs in found:
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n + draw.buckets) / ((s[b] + 1) * (m + draw.buckets)))) for b in map(bucket, fs)]
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        rows.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= draw.least_words), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(able[: draw.percent * len(able) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def of(frame):
    assert frame.columns == NAMES
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("draw", [resample.Draw(), resample.Draw(buckets=70_000, run=3, least_words=1, percent=60, last=1)])
def test_resampling_of_odd_rows(spark, draw):
    aims = spark.createDataFrame([(1, "the other one and the day"), (2, None), (3, "")], "item_id int, text string")
    docs = odd(spark)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in aims.collect()], draw)
    assert of(resample.drawn(docs, aims, draw)) == want
    assert resample.drawn(empty(spark), aims, draw).collect() == []
    assert sum(of(resample.drawn(docs, aims.limit(0), draw)).values()) == docs.count()


def test_cutoff_of_ties_and_repeats_over_many_rounds(spark):
    random.seed(4)
    words = "alpha beta gamma delta one two three".split()
    texts = [" ".join(random.choices(words, k=random.randrange(1, 40))) for _ in range(300)]
    # A third of all rows is one document; ids repeat with other texts too.
    rows = [(7, texts[0] * 5)] * 500 + [(random.randrange(400), random.choice(texts)) for _ in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    aims = spark.createDataFrame([("alpha beta gamma",)], "text string")
    draw = resample.Draw(last=3)
    got, want = of(resample.drawn(docs, aims, draw)), plain(rows, ["alpha beta gamma"], draw)
    # Rows of equal score and id may be drawn in any order.
    loose = lambda c: Counter((r[0], r[3], r[4]) for r in c.elements())
    assert loose(got) == loose(want)
    assert Counter(r[:4] for r in got.elements()) == Counter(r[:4] for r in want.elements())


def test_every_place_is_found(spark):
    random.seed(5)
    keys = sorted((random.randrange(5), random.randrange(3), random.randrange(2), i) for i in range(200))
    shuffled = random.sample(keys, len(keys))
    frame = spark.createDataFrame(shuffled, ", ".join(f"{k} bigint" for k in resample.KEY)).repartition(5)
    for place in (0, 1, 57, 100, 198, 199):
        assert resample.cutoff(frame, place, 2) == keys[place]
    assert resample.cutoff(frame, 200, 2) is None
    assert resample.cutoff(frame.limit(0), 0, 2) is None


def test_sample_keeps_all_columns(spark):
    docs = odd(spark)
    aims = spark.createDataFrame([("word1 and the other one",)], "text string")
    rows = resample.sample(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), aims, resample.Draw(least_words=1, percent=100))
    assert rows.select("row.*").columns == docs.columns
    assert rows.where(F.col("row.doc_id") == 5).count() == 1
    assert SCHEMA.startswith("doc_id")
