"""Repeated passages, by merging Burrows-Wheeler transforms.

A byte is removed when a string of 200 bytes that covers it starts anywhere else as well, in the same
document or another. All strings are judged on the input.

*Deal.* Every string of 200 bytes has an anchor: its gram of least hash, the first of equals. Equal
strings have equal anchors, so strings can only repeat within one anchor's group. The strings of an
anchor in a document are a row of neighbours; the bytes they cover are a context. Anchors that occur
once are out.

*Equal contexts.* All strings of a context that occurs twice repeat. Copies end here: of each
different context one is looked at further, and only beside different contexts of its anchor.

*Merge.* Each of these contexts is a shard with its own transform. Shards are merged by iterative
interleave refinement: a stable sort of the merged transform's symbols takes an order by h symbols to
one by h + 1, without sorting suffixes anew. Blocks of suffixes with equal prefixes split as the order
is refined; suffixes that stand alone leave the work. Blocks that are left after 200 rounds are the
intervals with a common prefix of 200.

An anchor with very many different contexts is not given to one task: its strings are counted by a
128-bit hash over the whole cluster.

Defined results: null and empty texts, and texts under 200 bytes, lose nothing. Repeated rows are repeats of each other. Removed runs may cut a character; where a text
is asked for, parts of a character go with the run. Extra columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import sliced, stored, text_of
from roomledger.session import ship_package

LENGTH, GRAM = 200, 32
#: Places that are hashed at a time.
_PART = 1 << 18
#: Bytes of contexts that are merged together, and different contexts of an anchor up to which they are.
MERGED, HOT = 1 << 18, 4096
_ODD = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    up, down = np.full(n, _ODD, np.uint64), np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(_PART + 2 * LENGTH)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the gram that starts at each place; equal grams have equal hashes anywhere."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _DOWN[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h


def leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value in every run of `width`, the first of equals.

    In blocks of the width, a run is the end of one block and the start of the next.
    """
    n = len(h) - width + 1
    grid = np.concatenate([h, np.full(-len(h) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    index = np.arange(grid.size).reshape(grid.shape)
    low = np.minimum.accumulate(grid, axis=1)
    fresh = np.ones(grid.shape, bool)
    fresh[:, 1:] = grid[:, 1:] < low[:, :-1]
    start = np.maximum.accumulate(np.where(fresh, index, 0), axis=1).ravel()
    turned = grid[:, ::-1]
    low_end = np.minimum.accumulate(turned, axis=1)
    fresh[:, 1:] = turned[:, 1:] <= low_end[:, :-1]
    end = np.minimum.accumulate(np.where(fresh, index[:, ::-1], grid.size), axis=1)[:, ::-1].ravel()
    a, b = end[:n], start[width - 1 : width - 1 + n]
    flat = grid.ravel()
    return np.where(flat[a] <= flat[b], a, b)


def contexts(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, first string, strings) of the contexts of a document, part by part."""
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(data) - LENGTH + 1, _PART):
        part = whole[at : at + _PART + LENGTH - 1]
        h = gram_hashes(part)
        place = leftmost_least(h, LENGTH - GRAM + 1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        yield h[place[first]], first + at, np.diff(np.r_[first, len(place)])


_OCCURRENCE = "k1 bigint, k2 bigint, a bigint, c bigint, lo bigint, n int"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of the texts (k1, k2, text)."""
    digest = xxhash.xxh3_64_intdigest
    for batch in sliced(batches):
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        rows, anchors, lows, sizes, hashes = [], [], [], [], []
        for i, text in enumerate(batch.column(2)):
            data = text.as_py().encode()
            for a, lo, n in contexts(data):
                rows.append(np.full(len(a), i))
                anchors.append(a)
                lows.append(lo)
                sizes.append(n)
                hashes.extend(
                    digest(data[s:e]) for s, e in zip(lo.tolist(), (lo + n + LENGTH - 1).tolist())
                )
        if rows:
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[row]), pa.array(k2[row]), pa.array(np.concatenate(anchors).view(np.int64)),
                 pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.concatenate(lows)),
                 pa.array(np.concatenate(sizes), pa.int32())],
                ["k1", "k2", "a", "c", "lo", "n"],
            )


def transform(data: bytes) -> np.ndarray:
    """The order of a short shard's suffixes, the empty one first."""
    text = data.decode("latin-1")  # letters in the order of the bytes
    suffixes = sorted([text[i:] for i in range(len(text) + 1)])
    return len(text) - np.fromiter(map(len, suffixes), np.int32, len(suffixes))


def _dense(values: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Values below a size by their rank among the different ones, and how many these are."""
    present = np.zeros(size, bool)
    present[values] = True
    rank = np.cumsum(present) - 1
    return rank[values], int(rank[-1]) + 1


def repeated(shards: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each shard the places where a string of the length starts that starts elsewhere as well.

    A round takes the order from h symbols to h + k: it sorts stably by the k symbols before each
    suffix, which are the shards' transforms read k at a time, and goes on to the suffixes that begin
    there. Suffixes with fewer than `length` symbols before them can not end a string and take no part, so
    there always are k symbols left. The largest k up to 4 is taken whose words fit 16 bits; what then lacks
    of the length is rounds of one.
    """
    sizes = np.array([len(s) + 1 for s in shards])
    ends = np.cumsum(sizes)
    suffix = np.concatenate([transform(s) for s in shards])
    first = np.repeat(ends - sizes, sizes).astype(np.int32)
    at = first + suffix
    place = np.empty(len(at), np.int32)
    place[at] = np.arange(len(at), dtype=np.int32)
    text = np.frombuffer(b"\0".join(shards) + b"\0", np.uint8)

    # Numbers for the words of one, two and four symbols that end before a text position.
    words = np.concatenate([text[-1:], text[:-1]]).astype(np.int64)
    kinds, step = 256, 1
    while step < min(4, length) and kinds * kinds <= 1 << 22:
        longer, more = _dense(words[np.arange(len(words)) - step] * kinds + words, kinds * kinds)
        if more > 1 << 16:
            break
        words, kinds, step = longer, more, 2 * step
    order = np.flatnonzero(suffix >= length).astype(np.int32)
    block = np.zeros(len(order), np.int32)
    for k, rounds in ((1, length % step), (step, length // step)):
        symbols = (text[at - 1] if k == 1 else words[at]).astype(np.uint16)
        back = np.where(suffix >= k, place[at - k], -1)
        for _ in range(rounds):
            if not len(order):
                break
            s = symbols[order]
            sort = np.argsort(s, kind="stable")
            s, block = s[sort], block[sort]
            order = back[order[sort]]
            # A block begins where the symbols or the old block change.
            begins = np.ones(len(order) + 1, bool)
            begins[1:-1] = (s[1:] != s[:-1]) | (block[1:] != block[:-1])
            company = ~(begins[:-1] & begins[1:])
            order = order[company]
            block = np.cumsum(begins[:-1][company], dtype=np.int32)
    found = np.sort(at[order])
    cuts = np.searchsorted(found, np.r_[0, ends]).tolist()
    return [found[i:j] - end + size for i, j, end, size in zip(cuts, cuts[1:], ends.tolist(), sizes.tolist())]


_FOUND = "a bigint, c bigint, spans array<struct<s:int,e:int>>"
_FOUND_SCHEMA = pa.schema([
    ("a", pa.int64()), ("c", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
])


def _runs(places: np.ndarray) -> list[dict]:
    """Neighbouring places as (s, e), e included."""
    cut = np.flatnonzero(places[1:] - places[:-1] > 1)
    starts, ends = places[cut + 1].tolist(), places[cut].tolist()
    return [{"s": s, "e": e} for s, e in zip([int(places[0]), *starts], [*ends, int(places[-1])])]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted contexts (a, c, data): whole anchors are merged together until enough bytes are there."""
    kept: list[tuple[int, int, bytes]] = []
    size = 0

    def close() -> pa.RecordBatch:
        found = repeated([k[2] for k in kept])
        return pa.RecordBatch.from_pylist(
            [{"a": k[0], "c": k[1], "spans": _runs(p)} for k, p in zip(kept, found) if len(p)], _FOUND_SCHEMA
        )

    for batch in batches:
        for a, c, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if kept and kept[-1][:2] == (a, c):
                continue  # from a repeated row
            if size >= MERGED and kept[-1][0] != a:
                yield close()
                kept, size = [], 0
            kept.append((a, c, data))
            size += len(data)
    if kept:
        yield close()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the contexts that are looked at further: their bytes."""
    schema = pa.schema([("a", pa.int64()), ("c", pa.int64()), ("kinds", pa.int64()), ("data", pa.binary())])
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1)):
            data = text.as_py().encode()
            yield pa.RecordBatch.from_pylist(
                [{"a": w["a"], "c": w["c"], "kinds": w["kinds"], "data": data[w["lo"] : w["lo"] + w["n"] + LENGTH - 1]}
                 for w in wanted.as_py()], schema
            )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts (a, c, data) by its hash."""
    for batch in batches:
        for a, c, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            n = len(data) - LENGTH + 1
            hashes = [xxhash.xxh3_128_intdigest(data[i : i + LENGTH]) for i in range(n)]
            low = (1 << 64) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([a] * n, pa.int64()), pa.array([c] * n, pa.int64()), pa.array(range(n), pa.int32()),
                 pa.array(np.array([h >> 64 for h in hashes], np.uint64).view(np.int64)),
                 pa.array(np.array([h & low for h in hashes], np.uint64).view(np.int64))],
                ["a", "c", "i", "h1", "h2"],
            )


def _counted(hot: DataFrame) -> DataFrame:
    """(a, c, spans) of the repeated strings of anchors with very many contexts."""
    strings = hot.mapInArrow(_strings, "a bigint, c bigint, i int, h1 bigint, h2 bigint")
    twice = strings.groupBy("h1", "h2").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y")
    return strings.join(twice, ["h1", "h2"], "left_semi").groupBy("a", "c").agg(
        F.collect_set(F.struct(F.col("i").alias("s"), F.col("i").alias("e"))).alias("spans")
    )


def _keys(docs: DataFrame) -> list[Column]:
    """A key of the row's id and text; rows that share it have equal texts and so equal results."""
    return [
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0).cast("long")).alias("k1"),
        F.xxhash64(text_of(docs), docs["doc_id"].isNull()).alias("k2"),
    ]


def spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, found): per document the contexts with repeated strings, as (lo, spans)."""
    ship_package(docs.sparkSession)
    text = text_of(docs)
    base = docs.select(*_keys(docs), text.alias("text")).where(F.octet_length("text") >= LENGTH)
    every = stored(base.mapInArrow(_occurrences, _OCCURRENCE), "repeats-occurrences")
    again = stored(every.groupBy("a").agg(F.count("*").alias("m")).where("m > 1").select("a"), "repeats-anchors")
    places = stored(every.join(again, "a", "left_semi").select("k1", "k2", "a", "c", "lo", "n"), "repeats-places")
    kinds = stored(
        places.groupBy("a", "c").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2", "lo", "n")).alias("r")),
        "repeats-contexts",
    )
    groups = kinds.groupBy("a").agg(F.count("*").alias("kinds"), F.min("m").alias("least")).where("kinds > 1 and least = 1")
    wanted = (
        kinds.join(groups, "a").select("r.k1", "r.k2", F.struct("a", "c", "kinds", "r.lo", "r.n").alias("w"))
        .groupBy("k1", "k2").agg(F.collect_list("w").alias("wanted"))
    )
    cut = stored(
        base.join(wanted, ["k1", "k2"]).select("text", "wanted")
        .mapInArrow(_cut, "a bigint, c bigint, kinds bigint, data binary"),
        "repeats-bytes",
    )
    merged = (
        cut.where(F.col("kinds") <= HOT).select("a", "c", "data")
        .repartition("a").sortWithinPartitions("a", "c").mapInArrow(_merge, _FOUND)
    )
    whole = kinds.where("m > 1").select(
        "a", "c", F.array(F.struct(F.lit(0).alias("s"), (F.col("r.n") - 1).alias("e"))).alias("spans")
    )
    found = whole.union(merged).union(_counted(cut.where(F.col("kinds") > HOT).select("a", "c", "data")))
    return stored(
        places.join(found, ["a", "c"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "spans")).alias("found")),
        "repeats-spans",
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, found) with what remains of their texts."""
    for batch in sliced(batches):
        rows = batch.column(0)
        place = rows.type.get_field_index("text")
        kept, texts, counts = [], [], []
        for text, found in zip(rows.field(place), batch.column(1)):
            data, found = (text.as_py() or "").encode(), found.as_py()
            if not found:
                kept.append(data)
                texts.append(None)
                counts.append((len(data), 0, 0))
                continue
            change = np.zeros(len(data) + 1, np.int32)
            for f in found:
                for span in f["spans"]:
                    change[f["lo"] + span["s"]] += 1
                    change[f["lo"] + span["e"] + LENGTH] -= 1
            gone = np.cumsum(change[:-1]) > 0
            whole = np.frombuffer(data, np.uint8)
            kept.append(whole[~gone].tobytes())
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).tolist()
            counts.append((len(data), int(gone.sum()), len(edges)))
            # In the text the parts of a cut character go as well.
            for start, end in edges:
                while data[start] & 0xC0 == 0x80:
                    start -= 1
                    gone[start] = True
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    gone[end] = True
                    end += 1
            texts.append(whole[~gone].tobytes().decode())
        yield pa.RecordBatch.from_arrays(
            [rows, *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3)), pa.array(kept, pa.binary()),
             pa.array(texts, pa.string())],
            ["row", "n_bytes", "n_removed", "n_spans", "kept", "text"],
        )


def removed(docs: DataFrame) -> DataFrame:
    """Every row as `row`, with n_bytes, n_removed, n_spans and the remaining bytes `kept`; where bytes
    are removed, `text` is what remains in whole characters."""
    whole = docs.select(F.struct("*").alias("row"), *_keys(docs))
    joined = whole.join(spans(docs), ["k1", "k2"], "left").select("row", "found")
    fields = docs.select(F.struct("*").alias("row")).schema[0].dataType.simpleString()
    return joined.mapInArrow(
        _kept, f"row {fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, text string"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the remaining text; the count of characters follows it."""
    cut = F.col("n_removed") > 0
    row = F.col("row").withField("text", F.when(cut, F.col("text")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        count = F.when(cut, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", count)
    return removed(docs).select(row.alias("row")).select("row.*")
