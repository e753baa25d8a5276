"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in at most four
bits differ in at most one bit of some segment, so one of them is found in the tables of the other's
ball of radius one. A pair at segment distance one has the bit set on one side only; it is enough to
look up, for every fingerprint, its segments and each segment with one set bit cleared. Whole
distances are verified.

Equal fingerprints are one entry, so copies cost one row. Within a bucket the links are a spanning
forest instead of all pairs; a bucket of very many different fingerprints is compared in blocks.

Defined results: null and empty texts have fingerprint zero and link like any other. Texts of fewer
words than a shingle are one shingle. Rows without an id take part; a group of them only has no id.
Repeated rows are copies. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import stored
from roomledger.llm.components import components
from roomledger.session import ship_package

#: (first bit, width) of the segments. With at most 5 differing bits one segment has at most one.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
DISTANCE = 4
SEED = 42
#: Rows of one bucket that are compared in one piece.
BLOCK = 4096
_CHUNK = 1 << 15


def fingerprint(text: str | None, width: int = 4) -> int:
    """The fingerprint of one text."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < width:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        after = np.cumsum(lengths + 1) - 1
        starts, ends = (after - lengths)[: n - width + 1].tolist(), after[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """The rows with their fingerprint as a signed long."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), width) for t in batch.column(place)]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{name}` bigint")


def _segment_entries(table: int, first: int, width: int) -> list[Column]:
    value = F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)

    def entry(key: Column, probe: bool) -> Column:
        return F.struct(key.bitwiseOR(F.lit(table)).alias("bucket"), F.lit(probe).alias("probe"))

    bits = F.filter(
        F.array(*(F.lit(1 << b).cast("long") for b in range(width))),
        lambda bit: value.bitwiseAND(bit) != 0,
    )
    return [
        F.array(entry(value, False)),
        F.transform(bits, lambda bit: entry(value.bitwiseXOR(bit), True)),
    ]


def _entries(prints: DataFrame) -> DataFrame:
    """(bucket, probe, fp): the own segments, and those with one set bit cleared."""
    parts = []
    for k, (first, width) in enumerate(SEGMENTS):
        parts.extend(_segment_entries(k << 32, first, width))
    return prints.select("fp", F.explode(F.concat(*parts)).alias("e")).select("e.bucket", "e.probe", "fp")


def forest(prints: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Edges that join all fingerprints of an array which links connect."""
    edges, todo, left = [], [], prints
    while left.size:
        if not todo:
            todo, left = [left[0]], left[1:]
            continue
        x = todo.pop()
        near = np.bitwise_count(left ^ x) <= distance
        if near.any():
            hits = left[near]
            edges.extend((int(x), int(y)) for y in hits)
            todo.extend(hits)
            left = left[~near]
    return edges


_LINKS = "a bigint, b bigint, bucket bigint"


def _batch(a, b, bucket) -> pa.RecordBatch:
    whole = lambda x: pa.array(np.asarray(x, np.uint64).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [whole(a), whole(b) if b is not None else pa.nulls(len(a), pa.int64()),
         pa.array(bucket, pa.int64()) if bucket is not None else pa.nulls(len(a), pa.int64())],
        ["a", "b", "bucket"],
    )


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted buckets; a bucket over the block size comes out as rows (fp, null, bucket)."""
    bucket, probe, fp = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.uint64)
    large = None  # the bucket whose rows are passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        b = batch.column(0).to_numpy(zero_copy_only=False)
        p = batch.column(1).to_numpy(zero_copy_only=False)
        f = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        bucket, probe, fp = np.concatenate([bucket, b]), np.concatenate([probe, p]), np.concatenate([fp, f])
        if large is not None:
            same = int(np.searchsorted(bucket, large, "right"))
            if same:
                yield _batch(fp[:same], None, bucket[:same])
            if same == len(bucket):
                bucket, probe, fp = bucket[:0], probe[:0], fp[:0]
                continue
            bucket, probe, fp, large = bucket[same:], probe[same:], fp[same:], None
        last = int(np.searchsorted(bucket, bucket[-1], "left"))
        yield from _closed(bucket[:last], probe[:last], fp[:last])
        bucket, probe, fp = bucket[last:], probe[last:], fp[last:]
        if len(bucket) > BLOCK:
            if probe[0]:  # nothing but probes: no link is found here
                bucket, probe, fp = bucket[:1], probe[:1], fp[:1]
            else:
                large = bucket[0]
                yield _batch(fp, None, bucket)
                bucket, probe, fp = bucket[:0], probe[:0], fp[:0]
    if len(bucket):
        yield from _closed(bucket, probe, fp)


def _closed(bucket: np.ndarray, probe: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(bucket):
        return
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    use = (sizes > 1) & ~probe[starts]
    small = np.repeat(use & (sizes <= 8), sizes)
    left, right = [], []
    if small.any():
        k, f = bucket[small], fp[small]
        for d in range(1, 8):
            ok = (k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= DISTANCE)
            left.append(f[:-d][ok])
            right.append(f[d:][ok])
    for i in np.flatnonzero(use & (sizes > 8)):
        rows = slice(starts[i], starts[i] + sizes[i])
        if sizes[i] > BLOCK:
            yield _batch(fp[rows], None, bucket[rows])
        elif edges := forest(fp[rows]):
            a, b = zip(*edges)
            left.append(np.array(a, np.uint64))
            right.append(np.array(b, np.uint64))
    if left and sum(map(len, left)):
        yield _batch(np.concatenate(left), np.concatenate(right), None)


def _forest_of_group(table: pa.Table) -> pa.Table:
    edges = forest(np.unique(table.column("a").to_numpy().view(np.uint64)))
    a, b = zip(*edges) if edges else ((), ())
    whole = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
    return pa.table({"a": whole(a), "b": whole(b)})


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between different fingerprints; every pair within the distance is connected by them."""
    ship_package(prints.sparkSession)
    found = stored(
        _entries(prints).repartition("bucket").sortWithinPartitions("bucket", "probe").mapInArrow(_links, _LINKS),
        "simhash-links",
    )
    rest = found.where("b is null")
    blocks = rest.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("a"), "n").cast("int")
    dealt = (
        rest.join(blocks, "bucket")
        .select("a", "bucket", own.alias("own"), F.explode(F.expr("sequence(0, n - 1)")).alias("other"))
        .select("a", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )
    return found.where("b is not null").select("a", "b").union(
        dealt.groupBy("bucket", "lo", "hi").applyInArrow(_forest_of_group, "a bigint, b bigint")
    )


def grouped(rows: DataFrame, id_column: str = "doc_id", name: str = "fp") -> DataFrame:
    """Stored rows with a fingerprint, `component_id`: the smallest id their links reach, and `group`:
    the smallest fingerprint, which a component without ids has as well."""
    prints = stored(rows.groupBy(name).agg(F.min(id_column).alias("least")).withColumnRenamed(name, "fp"), "simhash-prints")
    found = components(links(prints.select("fp")))
    rooted = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(
        rooted.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id", F.col("root").alias("group")),
        "simhash-groups",
    )
    return rows.join(named, rows[name] == named["_fp"]).drop("_fp")


def firsts(rows: DataFrame) -> DataFrame:
    """(_row): of every group of stored rows (id, fp, _row) the smallest id, and of repeated ids the first row."""
    first = grouped(rows, "id").groupBy("group").agg(
        F.min_by("_row", F.struct(F.col("id").isNull(), F.col("id"), F.col("_row"))).alias("_row")
    )
    return first.select("_row")


def kept(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row of every group: the smallest id, and of repeated ids the first row. All columns stay."""
    whole = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"))
    rows = stored(
        with_fingerprint(whole).select("row", "fp", F.monotonically_increasing_id().alias("_row")), "simhash-rows"
    )
    first = firsts(rows.select(F.col("row")[id_column].alias("id"), "fp", "_row"))
    return rows.join(first, "_row", "left_semi").select("row.*")
