"""Near duplicates by the Jaccard index of their word shingles: five words, 0.8 or more.

Every text is the set of its shingles. Texts of equal sets are one entry. Candidates are pairs that agree
in a band of MinHash values, and every link is verified by the exact index of the two sets. With 30 bands
of 5 values a pair at 0.8 is a candidate with probability 1 - (1 - 0.8^5)^30, 0.999993, and one at 0.9
misses once in 10^11.

A bucket is a band with its values. Buckets of the same sets are one. The sets of a bucket meet in blocks of a
bounded number of shingles, every block with every other, and a pair of blocks is compared in one task: a pivot
with all sets of other components that were no pivot before, until all sets but those of the largest component
were pivots. So no rows of pairs are made, no pair of a bucket is left out that could join two components, and a
large group of copies costs a few passes over its sets. A bucket costs its sets times those that stay outside.

Defined results: words are between white space, A-Z in lower case. A text of fewer than five words is one
shingle, and texts without words are equal. Shingles and sets are compared by 64-bit hashes. Rows without
an id take part. Columns other than the id and the text are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm import simhash
from roomledger.llm.common import sliced, stored
from roomledger.llm.components import components
from roomledger.session import ship_package

WIDTH = 5
BANDS, VALUES = 30, 5
SEED = 42
_CHUNK = 1 << 12
#: Shingles of a block of sets.
BLOCK = 1 << 20
# Odd multipliers and summands of the MinHash functions.
_RANDOM = np.random.RandomState(SEED)
_TIMES = _RANDOM.randint(0, 1 << 63, BANDS * VALUES, np.uint64) | np.uint64(1)
_PLUS = _RANDOM.randint(0, 1 << 63, BANDS * VALUES, np.uint64)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The different shingles of a text as sorted hashes."""
    words = (text or "").encode().lower().split()
    joined, n = b" ".join(words), len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n <= width:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        after = np.cumsum(lengths + 1) - 1
        starts, ends = (after - lengths)[: n - width + 1].tolist(), after[width - 1 :].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """One key for each band of MinHash values of a set; none for the empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * VALUES, ~np.uint64(0))
    for i in range(0, len(hashes), _CHUNK):
        np.minimum(least, (hashes[i : i + _CHUNK, None] * _TIMES + _PLUS).min(axis=0), out=least)
    digest = xxhash.xxh64_intdigest
    return [digest(v.tobytes(), i) - (1 << 63) for i, v in enumerate(least.reshape(BANDS, VALUES))]


_BANDS = "_row bigint, same bigint, n int, bands array<bigint>"
_SETS = "same bigint, hashes array<bigint>"


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [shingles(t.as_py()) for t in batch.column(1)]
        same = [xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63) for h in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(same, pa.int64()), pa.array(map(len, found), pa.int32()),
             pa.array(map(bands, found), pa.list_(pa.int64()))],
            ["_row", "same", "n", "bands"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["same", "hashes"])


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs (by place) of non-empty sets at 0.8 or more that connect all sets that such pairs connect.

    The common part c of sizes m and n is enough if 9 c >= 4 (m + n).
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(values), bool)
    group, fresh, found = np.arange(len(sets)), np.ones(len(sets), bool), []
    while True:
        main = np.bincount(group).argmax()
        outside = np.flatnonzero(fresh & (group != main))
        if not len(outside):
            return found
        p = outside[0]
        fresh[p] = False
        other = fresh & (group != group[p]) & (5 * np.minimum(sizes, sizes[p]) >= 4 * np.maximum(sizes, sizes[p]))
        if not other.any():
            continue
        own = ids[starts[p] : starts[p] + sizes[p]]
        marked[own] = True
        common = np.add.reduceat(marked[ids], starts, dtype=np.int64)
        marked[own] = False
        joined, first = np.unique(np.where(other & (9 * common >= 4 * (sizes + sizes[p])), group, -1), return_index=True)
        found += [(int(p), int(at)) for g, at in zip(joined, first) if g >= 0]
        group[np.isin(group, joined)] = group[p]


def _linked(block: pa.Table) -> pa.Table:
    """The links among the rows (same, hashes) of a pair of blocks."""
    same = block.column("same").to_pylist()
    lists = block.column("hashes").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    pairs = linked(np.split(flat, ends[:-1]))
    return pa.table({n: pa.array([same[x[i]] for x in pairs], pa.int64()) for i, n in enumerate("ab")})


def links(entries: DataFrame, texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect all candidates at 0.8 or more.

    `entries` are stored rows (same, n, bucket) of different sets of n shingles, `texts` has (same, text) once.
    Blocks have about `block` shingles. Sets are made once for each text that shares a bucket.
    """
    shared = entries.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum("n").alias("hashes"),
        F.bit_xor(F.xxhash64("same")).alias("x"), F.bit_xor(F.xxhash64("same", F.lit(1))).alias("y"),
    ).where("rows > 1")
    chosen = shared.groupBy("rows", "hashes", "x", "y").agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.ceil(F.col("hashes") / block).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("same", F.lit(2)), "blocks").cast("int")
    others = F.array_except(F.sequence(F.lit(0), F.col("blocks") - 1), F.array(own))
    at = stored(
        entries.join(chosen, "bucket")
        .select("same", "bucket", own.alias("own"), F.explode(F.when(F.col("blocks") > 1, others).otherwise(F.array(F.lit(0)))).alias("other"))
        .select("same", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")),
        "neardup-blocks",
    )
    sets = texts.join(at.select("same").distinct(), "same", "left_semi").mapInArrow(_hashed, _SETS)
    return stored(
        at.join(sets, "same").groupBy("bucket", "i", "j").applyInArrow(_linked, "a bigint, b bigint").distinct(), "neardup-links"
    )


def kept(docs: DataFrame, id_column: str = "doc_id", fingerprints: bool = False) -> DataFrame:
    """One row of every group: the smallest id, and of repeated ids the first row. All columns stay.

    With `fingerprints` the groups of `simhash` come first, and those by the index are made of what they leave:
    no two rows stay that either of the two links.
    """
    ship_package(docs.sparkSession)
    rows = stored(
        docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_row")),
        "neardup-rows",
    )
    made = stored(rows.select("_row", F.col("row.text").alias("text")).mapInArrow(_banded, _BANDS), "neardup-bands")
    if fingerprints:
        texts = rows.select("_row", F.col("row")[id_column].alias("id"), F.col("row.text").alias("text"))
        prints = stored(simhash.with_fingerprint(texts).select("_row", "id", "fp"), "neardup-prints")
        made = stored(made.join(simhash.firsts(prints), "_row", "left_semi"), "neardup-left")
    each = made.groupBy("same").agg(F.min("_row").alias("_row"))
    texts = rows.select("_row", F.col("row.text").alias("text")).join(each, "_row").select("same", "text")
    entries = stored(
        made.join(each.select("_row"), "_row", "left_semi").select("same", "n", F.explode("bands").alias("bucket")),
        "neardup-entries",
    )
    found = components(links(entries, texts))
    ids = rows.select("_row", F.col("row")[id_column].alias("id"))
    member = made.select("_row", "same").join(ids, "_row").join(found, F.col("same") == found["node"], "left")
    first = member.groupBy(F.coalesce("root", "same").alias("group")).agg(
        F.min_by("_row", F.struct(F.col("id").isNull(), F.col("id"), F.col("_row"))).alias("_row")
    )
    return rows.join(first.select("_row"), "_row", "left_semi").select("row.*")
