"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt into blocks of bounded size. In a block every dimension has its postings ordered by
quantised impact, cut into segments of one quantiser step. A component counts from the end of the
dimension's range that is worst for the query, so every contribution is at least zero, and a segment's
bound is the largest contribution its step allows. For a query the segments of all dimensions are
processed by falling bound, each adding to the sums of its members. A vector not met yet in some
dimensions gains at most the next bound in each of them. When all but a few vectors provably stay
below the k-th best sum the rest of the segments is skipped, and these few are scored exactly.

Blocks of queries meet all blocks of vectors; a query keeps k rows of each, and the best k of these
are its result.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor
do rows without an id; only vectors of equal width meet. Ties go to the smaller id. Rows with a
repeated id each count, but never for a query of their own id. Fewer candidates than k give fewer rows;
empty tables give none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import stored
from roomledger.session import ship_package

#: Vectors and queries of a block.
VECTORS, QUERIES = 8192, 512
#: Steps of the quantiser per dimension.
STEPS = 16
#: Parts in which the segments of a query are processed; the proof is tried after each.
ROUNDS = 4
#: The proof is good when at most one row in so many is left to be scored exactly.
RESCORED = 4

_PACKED = "block bigint, width int, ids binary, data binary"


def _packer(size: int):
    """Pack rows (vec_id, vector) into blocks of one width and at most `size` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}

        def out(width: int) -> pa.RecordBatch:
            rows = kept.pop(width)
            ids = np.array([r[0] for r in rows], np.int64)
            data = np.stack([r[1] for r in rows])
            return pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([data.tobytes()], pa.binary())],
                ["block", "width", "ids", "data"],
            )

        for batch in batches:
            column = batch.column(1)
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for i, vec_id in enumerate(batch.column(0).to_pylist()):
                row = values[offsets[i] : offsets[i + 1]]
                kept.setdefault(len(row), []).append((vec_id, row))
                if len(kept[len(row)]) == size:
                    yield out(len(row))
        for width in list(kept):
            yield out(width)

    return run


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Stored blocks (block, width, ids, data) of rows (vec_id, v: array<bigint>)."""
    ship_package(vectors.sparkSession)
    return stored(
        vectors.mapInArrow(_packer(size), _PACKED).withColumn("block", F.monotonically_increasing_id()), "topk-blocks"
    )


class Index:
    """Postings of one block: by dimension the rows in order of their quantised component."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n, dims = vectors.shape
        self.low, self.high = vectors.min(0), vectors.max(0)
        step = (self.high - self.low) // STEPS + 1
        level = (vectors - self.low) // step
        order = np.argsort(level, axis=0, kind="stable").T
        self.rows = np.ascontiguousarray(order, np.intp)
        values = np.take_along_axis(vectors.T, order, 1).astype(np.float64)
        # What a posting is above the worst end, for queries that want large and small components.
        self.gains = (self.high[:, None] - values, values - self.low[:, None])
        edges = self.low[:, None] + np.arange(STEPS + 1) * step[:, None]
        self.below, self.above = edges[:, :-1], np.minimum(edges[:, 1:] - 1, self.high[:, None])
        flat = (np.arange(dims)[:, None] * STEPS + level.T).ravel()
        sizes = np.bincount(flat, minlength=dims * STEPS).reshape(dims, STEPS)
        self.ends = np.concatenate([np.zeros((dims, 1), np.int64), np.cumsum(sizes, 1)], 1)
        self.filled = sizes > 0
        # Sums of products below 2**53 are exact in doubles.
        self.largest = float(np.abs(vectors).max())
        self.doubles = vectors.astype(np.float64)

    def candidates(self, query: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
        """The rows of `other` that may be among its best k; all others are proven not to be."""
        n, dims = self.vectors.shape
        q = query.astype(np.float64)
        up = q >= 0
        worst = np.where(up, self.low, self.high)
        reach = np.where(up[:, None], self.above - worst[:, None], worst[:, None] - self.below)
        bound = np.where(self.filled, np.abs(q)[:, None] * reach, 0.0)
        falling = np.sort(bound[self.filled])[::-1]
        # The segments of a dimension with a bound above a limit are neighbours at its better end.
        done = np.where(up, n, 0)
        size, up_list, both = np.abs(q), up.astype(int).tolist(), np.zeros(n)
        unit = 2.0 ** np.ceil(np.log2(bound.max(1).sum() + 2))
        if unit * (dims + 1) > 2.0**53:
            return other  # too large for exact sums in doubles: all are scored exactly
        for part in range(1, ROUNDS):
            left = falling[len(falling) * part // ROUNDS]  # the largest bound that stays open
            above = bound > left
            any_ = above.any(1)
            lowest = np.where(any_, np.argmax(above, 1), STEPS)  # first level that is taken, upwards
            beyond = np.where(any_, STEPS - np.argmax(above[:, ::-1], 1), 0)  # after the last, downwards
            d = np.arange(dims)
            to = np.where(up, self.ends[d, lowest], self.ends[d, beyond])
            lo, hi = np.where(up, to, done), np.where(up, done, to)
            rows = np.concatenate([self.rows[i, lo[i] : hi[i]] for i in range(dims)])
            if len(rows):
                gain = np.concatenate([self.gains[up_list[i]][i, lo[i] : hi[i]] for i in range(dims)])
                gain *= np.repeat(size, hi - lo)
                gain += unit  # counts the dimensions met beside the sums
                both += np.bincount(rows, gain, n)
            met = np.floor(both / unit)
            sums = both - met * unit
            done = to
            floor = np.partition(sums[other], -k)[-k]
            upper = sums + left * (dims - met)
            may = other[upper[other] >= floor - 1e-6 * (1 + abs(floor))]
            if len(may) <= n // RESCORED:
                return may
        return other

    def best(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best k, without rows of the query's own id."""
        rows = np.flatnonzero(ids != own)
        if len(rows) > 16 * k:
            rows = self.candidates(query, rows, k)
        exact = self.largest * float(np.abs(query).max()) * len(query) < 2.0**53
        if exact:
            scores = (self.doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        else:
            scores = self.vectors[rows] @ query
        top = np.lexsort((ids[rows], -scores))[:k]
        return ids[rows][top], scores[top]


def _meet(k: int):
    """Blocks of queries against blocks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index, ids = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if last != r["block"]:
                    ids = np.frombuffer(r["ids"], np.int64)
                    index = Index(np.frombuffer(r["data"], np.int64).reshape(len(ids), r["width"]))
                    last = r["block"]
                own = np.frombuffer(r["q_ids"], np.int64)
                queries = np.frombuffer(r["q_data"], np.int64).reshape(len(own), r["width"])
                out = [index.best(q, ids, o, k) for q, o in zip(queries, own)]
                count = [len(x[0]) for x in out]
                place = np.repeat(np.arange(len(own)), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), r["q_block"], np.int64)), pa.array(place), pa.array(own[place]),
                     pa.array(np.concatenate([x[0] for x in out])), pa.array(np.concatenate([x[1] for x in out]))],
                    ["q_block", "place", "query_id", "vec_id", "score"],
                )

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (vec_id, v: array<bigint>) on both sides."""
    spark = vectors.sparkSession
    blocks, asked = packed(vectors, VECTORS), packed(queries, QUERIES)
    # Numbers without gaps; a row per block of queries.
    number = F.row_number().over(Window.orderBy("block")) - 1
    numbered = asked.select("block").withColumn("no", number).join(asked, "block").select(
        "no", F.col("block").alias("q_block"), F.col("width").alias("q_width"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")
    )
    n_asked, n_blocks = asked.count(), blocks.count()
    if not n_asked or not n_blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pairs = (
        blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("no"))
        .join(numbered, "no").where("width = q_width")
        .repartition(max(n_blocks, spark.sparkContext.defaultParallelism), "block", "no")
        .sortWithinPartitions("block")
    )
    found = pairs.select("block", "width", "ids", "data", "q_block", "q_ids", "q_data").mapInArrow(
        _meet(k), "q_block bigint, place bigint, query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("q_block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the components; rows that take no part are left out."""
    x_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", x_ok)
    ).select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
