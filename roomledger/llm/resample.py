"""Importance resampling towards a target: the documents most like it, with Gumbel noise, are drawn.

Features are runs of one or two words, hashed to buckets. A bucket's gain is the logarithm of its share
in the target against its share in the documents; a document's weight is the floored mean of the gains
of its features, taken from an array by bucket number. Weight plus Gumbel noise from the document's id is
the score, so that the highest scores are a draw without replacement.

The exact cutoff is found by weighted median of medians. In each round every task reports one key: the
weighted median of its batches' medians, and how many keys it has left; the weighted median of these is
the pivot. At least an eighth of the keys lies on either side of it, and the side without the cutoff is
discarded. A few thousand keys that are left are sorted on the driver. Winners are sorted by range
partitions and numbered by their partition's offset, so no task holds them all.

The driver sees the bucket sums, one key of every task in a round, and at most `last` keys.

Defined results: null and empty texts have no features and weight 0; they are never drawn, as they
have too few words. A null id is hashed as an empty one and comes after all others in ties. Rows that
repeat are documents of their own; between equal ones it does not matter which is drawn. Very long
texts are handled one at a time. An empty table gives no rows, and with an empty target all gains
compare with a target of no features. Other columns, whatever their names, are kept in `row` if asked
for and not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import stored, text_of
from roomledger.session import ship_package

#: Bytes that separate words become blanks, A-Z become a-z. All bytes of other letters stay.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_LAST_ID = (1 << 63) - 1
_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition
KEY = ("k_score", "k_id", "k_tie", "k_row")


@dataclass(frozen=True)
class Draw:
    """What is counted and drawn."""

    buckets: int = 10_000
    run: int = 2  # words of the longest feature
    least_words: int = 20
    percent: int = 25
    seed: int = 7
    #: So many keys or fewer are sorted on the driver.
    last: int = 4096

    @property
    def kind(self) -> str:
        """How the number of a bucket is kept."""
        return "<u4" if self.buckets > 1 << 16 else "<u2"


def words_in(text: str) -> list[bytes]:
    """The words, as bytes; A-Z in lower case."""
    return text.encode().translate(_TABLE).split()


def buckets_of(words: Sequence[bytes], draw: Draw) -> np.ndarray:
    """The bucket of every run of words; a run goes on from the checksum of the shorter one."""
    crc = zlib.crc32
    runs = [crc(w) for w in words]
    found = list(runs)
    for n in range(1, draw.run):
        runs = [crc(b" " + w, c) for c, w in zip(runs, words[n:])]
        found += runs
    return (np.array(found, np.int64) % draw.buckets).astype(draw.kind)


def _bucketed(draw: Draw):
    schema = pa.schema([("k_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, packed = [], []
            for text in batch.column("text"):
                words = words_in(text.as_py())
                counts.append(len(words))
                packed.append(buckets_of(words, draw).tobytes())
            columns = [batch.column("k_id"), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _with_buckets(rows: DataFrame, draw: Draw) -> DataFrame:
    """(k_id, n_words, buckets) of rows (k_id, text); stored."""
    ship_package(rows.sparkSession)
    return stored(
        rows.mapInArrow(_bucketed(draw), "k_id bigint, n_words bigint, buckets binary"), "resample-buckets"
    )


def _counted(draw: Draw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(draw.buckets, np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), draw.kind)
            sums += np.bincount(numbers, minlength=draw.buckets)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=["bucket", "n"])

    return run


def histogram(packed: DataFrame, draw: Draw) -> np.ndarray:
    """How often every bucket occurs; the tasks' sums are added up by Spark."""
    sums = packed.select("buckets").mapInArrow(_counted(draw), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    full = np.zeros(draw.buckets, np.int64)
    for r in sums.collect():
        full[r["bucket"]] = r["n"]
    return full


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket, in thousandths."""
    n = len(source)
    below, above = float(int(target.sum()) + n), float(int(source.sum()) + n)
    return np.array(
        [math.floor(1000 * math.log(float(t + 1) * above / (float(s + 1) * below))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def _weighed(gain: np.ndarray, draw: Draw):
    schema = pa.schema([("k_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("k_tie", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights, ties = [], [], []
            for packed in batch.column("buckets").to_pylist():
                numbers = np.frombuffer(packed, draw.kind)
                sizes.append(len(numbers))
                weights.append(int(gain[numbers].sum()) // len(numbers) if len(numbers) else 0)
                ties.append(zlib.crc32(packed))
            arrays = [batch.column("k_id"), batch.column("n_words"), *(pa.array(x, pa.int64()) for x in (sizes, weights, ties))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# --- the cutoff -----------------------------------------------------------------------


def _under(keys: np.ndarray, pivot: Sequence[int]) -> np.ndarray:
    """Which rows of keys come before the pivot."""
    found = np.zeros(len(keys), bool)
    same = np.ones(len(keys), bool)
    for column, value in zip(keys.T, pivot):
        found |= same & (column < value)
        same &= column == value
    return found


def _weighted_median(keys: list, weights: list) -> tuple[list[int], int]:
    """The key at half of the weights, and all weights."""
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    total, below = sum(weights), 0
    for i in order:
        below += weights[i]
        if 2 * below >= total:
            return keys[i], total
    raise ValueError("no keys")


def _median_of(keys: np.ndarray) -> list[int]:
    order = np.lexsort(keys.T[::-1])
    return keys[order[(len(keys) - 1) // 2]].tolist()


def _reported(lower, pivot, upper):
    """One row of a task for each side of the pivot: (side, the median of medians, how many keys)."""
    names = ["side", *KEY, "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        medians = {0: ([], []), 1: ([], [])}
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in KEY], 1)
            if lower is not None:
                keys = keys[~_under(keys, lower)]
            if upper is not None:
                keys = keys[_under(keys, upper)]
            first = _under(keys, pivot) if pivot is not None else np.ones(len(keys), bool)
            for side, part in ((0, keys[first]), (1, keys[~first])):
                if len(part):
                    medians[side][0].append(_median_of(part))
                    medians[side][1].append(len(part))
        rows = [(side, *key, n) for side, found in medians.items() if found[0] for key, n in [_weighted_median(*found)]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)

    return run


def _literal(key: Sequence[int]) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in zip(KEY, key)])


def cutoff(keys: DataFrame, place: int, last: int) -> tuple[int, ...] | None:
    """The key at a place (from 0) of all keys in their order; None if there is none.

    Keys differ. The bounds are kept as [lower, upper); each round moves one of them to the pivot.
    """
    lower = pivot = upper = None
    remaining = None
    while remaining is None or remaining > last:
        rows = keys
        if lower is not None:
            rows = rows.where(F.col(KEY[0]) >= lower[0])
        if upper is not None:
            rows = rows.where(F.col(KEY[0]) <= upper[0])
        shape = ", ".join(f"{n} bigint" for n in ("side", *KEY, "n"))
        sides = {0: ([], []), 1: ([], [])}
        for r in rows.mapInArrow(_reported(lower, pivot, upper), shape).collect():
            sides[r["side"]][0].append([r[k] for k in KEY])
            sides[r["side"]][1].append(r["n"])
        here = sum(sides[0][1])
        if place < here:
            upper, side = pivot or upper, sides[0]
        else:
            lower, side, place = pivot, sides[1], place - here
        if not side[0]:
            return None
        pivot, remaining = _weighted_median(*side)
        if pivot == lower:  # the first of several: the one after it parts them
            pivot = [*pivot[:-1], pivot[-1] + 1]
    rows = keys
    if lower is not None:
        rows = rows.where(F.struct(*KEY) >= _literal(lower))
    if upper is not None:
        rows = rows.where(F.struct(*KEY) < _literal(upper))
    left = sorted(tuple(r) for r in rows.select(*KEY).collect())
    return left[place] if place < len(left) else None


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows sorted by key, with their rank from 1."""
    inside = (1 << _ROW_BITS) - 1
    ordered = stored(rows.orderBy(*KEY).withColumn("m", F.monotonically_increasing_id()), "resample-winners")
    part = F.shiftright("m", _ROW_BITS)
    offset, offsets = 0, []
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], offset))
        offset += r["count"]
    before = rows.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    return ordered.withColumn("part", part).join(before, "part").withColumn("rank", F.col("before") + F.col("m").bitwiseAND(inside) + 1)


def scored(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(k_id, n_words, n_features, weight, score and the key columns) of every document; stored."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("k_id"), text_of(docs).alias("text"))
    packed = _with_buckets(rows, draw)
    aims = _with_buckets(target.select(F.lit(0).cast("bigint").alias("k_id"), text_of(target).alias("text")), draw)
    gain = gains(histogram(packed, draw), histogram(aims, draw))
    shape = "k_id bigint, n_words bigint, n_features bigint, weight bigint, k_tie bigint"
    weighed = packed.mapInArrow(_weighed(gain, draw), shape)
    score = F.col("weight") + noise(F.col("k_id"), draw.seed)
    return stored(
        weighed.select(
            F.col("k_id").alias("doc_id"), "n_words", "n_features", "weight", score.alias("score"),
            (-score).alias("k_score"), F.coalesce("k_id", F.lit(_LAST_ID)).alias("k_id"), "k_tie",
            F.monotonically_increasing_id().alias("k_row"),
        ),
        "resample-scores",
    )


def drawn(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; the rank is null where not drawn."""
    rows = scored(docs, target, draw)
    able = F.col("n_words") >= draw.least_words
    size = rows.where(able).count() * draw.percent // 100
    names = ["doc_id", "n_features", "weight", "score"]
    edge = cutoff(rows.where(able).select(*KEY), size - 1, draw.last) if size else None
    if edge is None:
        return rows.select(*names, F.lit(None).cast("bigint").alias("rank"))
    won = able & (F.struct(*KEY) <= _literal(edge))
    winners = _numbered(rows.where(won)).select(*names, "rank")
    return winners.unionByName(rows.where(~won).select(*names, F.lit(None).cast("bigint").alias("rank")))


def sample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """The drawn documents with all their columns, in `row`, and their rank; ids are to be unique."""
    ranks = drawn(docs, target, draw).where("rank is not null").select(F.col("doc_id").alias("_id"), "rank")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("bigint").alias("_id"))
    return rows.join(ranks, "_id").select("row", "rank")
