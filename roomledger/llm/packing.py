"""Best-fit packing of documents into sequences of equal capacity, under conflicts.

No bin holds two documents of one source, nor two of one cluster of duplicates. Documents are dealt
evenly into shards by the hash of their id, and a shard is packed alone: largest first, each piece
into the bin with the least room that is enough and has no conflict. Bins are ordered by room; each
carries a bitmap of its sources and one of its clusters. The successor search starts at the least
sufficient room and goes on to the next larger one until a compatible bin is found, so the bin taken
is the tightest compatible one. Bins with equal room and bitmaps are one entry of the search.

A text longer than a bin is cut into whole bins and a rest; the rest is packed like a short text.
Shards are of bounded size and their number grows with the input, so nothing is gathered; at most the
last few bins of a shard are less full than in one large packing.

Defined results: null and empty texts have no tokens and get no bin (bin null, one row). A null source
or cluster conflicts with nothing. Repeated rows are packed like any others. Ties in size go by id,
then by row. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import text_of, words_of
from roomledger.session import ship_package

#: Tokens of a bin.
CAPACITY = 2048
#: Mean number of documents of a shard.
SHARD = 4096


class Bins:
    """Bins of one shard: rooms in order, and by room the bins by their bitmaps."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.rooms: list[int] = []  # rooms that have bins, ascending
        self.at: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.used: list[int] = []
        self.count: list[int] = []

    def _file(self, bin_: int, sources: int, clusters: int) -> None:
        room = self.capacity - self.used[bin_]
        if not room:
            return  # a full bin can take nothing
        if room not in self.at:
            insort(self.rooms, room)
            self.at[room] = {}
        self.at[room].setdefault((sources, clusters), []).append(bin_)

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int, int]:
        """Place a piece; source and cluster are bits, 0 for none. Gives bin, offset and position."""
        place = bisect_left(self.rooms, size)
        while place < len(self.rooms):
            room = self.rooms[place]
            kinds = self.at[room]
            for key in kinds:
                if not key[0] & source and not key[1] & cluster:
                    bins = kinds[key]
                    bin_ = bins.pop()
                    if not bins:
                        del kinds[key]
                        if not kinds:
                            del self.at[room]
                            self.rooms.pop(place)
                    return self._add(bin_, size, key[0] | source, key[1] | cluster)
            place += 1
        self.used.append(0)
        self.count.append(0)
        return self._add(len(self.used) - 1, size, source, cluster)

    def _add(self, bin_: int, size: int, sources: int, clusters: int) -> tuple[int, int, int]:
        offset, position = self.used[bin_], self.count[bin_]
        self.used[bin_] += size
        self.count[bin_] += 1
        self._file(bin_, sources, clusters)
        return bin_, offset, position


def pack(rows: list[tuple], capacity: int = CAPACITY) -> list[tuple]:
    """(row, piece, start, size, bin, offset, position) for rows (row, size, source, cluster), largest first."""
    bins, out = Bins(capacity), []
    bits: tuple[dict, dict] = ({}, {})

    def bit(kind: int, value) -> int:
        return 0 if value is None else 1 << bits[kind].setdefault(value, len(bits[kind]))

    rests = []
    for row, size, source, cluster in rows:
        whole, rest = divmod(size, capacity)
        for piece in range(whole):
            bin_, offset, position = bins.put(capacity, 0, 0)
            out.append((row, piece, piece * capacity, capacity, bin_, offset, position))
        if rest:
            rests.append((-rest, len(rests), row, whole, source, cluster))
    for size, _, row, piece, source, cluster in sorted(rests):
        bin_, offset, position = bins.put(-size, bit(0, source), bit(1, cluster))
        out.append((row, piece, piece * capacity, -size, bin_, offset, position))
    return out


_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("bin", pa.int64()), ("position", pa.int32()), ("doc_id", pa.int64()),
    ("piece", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("offset", pa.int32()),
])
_FIELDS = "shard bigint, bin bigint, position int, doc_id bigint, piece int, start bigint, n_tokens bigint, offset int"


def _packer(capacity: int):
    def close(shard: int, rows: list[dict]) -> pa.RecordBatch:
        packed = pack([(i, r["size"], r["source"], r["cluster"]) for i, r in enumerate(rows)], capacity)
        return pa.RecordBatch.from_pylist([
            {"shard": shard, "bin": bin_, "position": position, "doc_id": rows[i]["doc_id"], "piece": piece,
             "start": start, "n_tokens": size, "offset": offset}
            for i, piece, start, size, bin_, offset, position in packed
        ], _SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    if rows:
                        yield close(shard, rows)
                    shard, rows = r["shard"], []
                rows.append(r)
        if rows:
            yield close(shard, rows)

    return run


def packed(
    docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY, shard: int = SHARD
) -> DataFrame:
    """(bin_id, position, doc_id, piece, start, n_tokens, offset): a row per piece of a document.

    Tokens are words between white space; start counts them in the text, offset in the bin. Without
    a cluster, equal texts are one.
    """
    ship_package(docs.sparkSession)
    shards = max(1, -(-docs.count() // shard))
    text = text_of(docs)
    rows = docs.select(
        docs["doc_id"], docs["source"], F.size(words_of(text)).cast("long").alias("size"),
        (F.sha2(text, 256) if cluster is None else cluster.cast("string")).alias("cluster"),
    )
    dealt = (
        rows.where("size > 0")
        # The second hash spreads rows whose ids are equal or null.
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("cluster"))), F.lit(shards)))
        .repartition("shard").sortWithinPartitions("shard", F.desc("size"), "doc_id", "cluster", "source")
        .mapInArrow(_packer(capacity), _FIELDS)
    )
    bins = dealt.select(
        F.concat_ws("-", "shard", "bin").alias("bin_id"), "position", "doc_id", "piece", "start", "n_tokens", "offset"
    )
    empty = rows.where("size = 0").select(
        F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("position"), "doc_id",
        F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("int").alias("offset"),
    )
    return bins.union(empty)
