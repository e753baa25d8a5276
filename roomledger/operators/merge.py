"""The keyed "richer value wins" merge and what belongs to it.

The rule is defined over a sequence: a blank new value changes nothing, a
blank or short kept value is replaced, a long kept value is replaced by a
strictly longer one. Over the whole sequence of a key that equals

* the longest value of at least the rich length, the earliest of equals,
* else the last value that is not blank,
* else the first value,

so one ordering per column decides, and the merge is a plain aggregation:
partial results are combined before the shuffle, a key with very many rows
never gathers in one task, and batches may be split or repeated at will.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions.jsontext import json_text
from roomledger.functions.text import built_once, is_blank, strip

RICHER = "richer"
LATEST = "latest"


def _named(name: str) -> str:
    """A column's name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _winner(name: str, seq: Sequence[str]) -> Column:
    """The value of the highest rank: the earliest of equally rich ones, the last of short ones.

    As SQL text: it is built once per column, and each part of a Column is a call to the JVM.
    """
    rank = _named(f"_rank_{name}")
    late = ", ".join(f"{_named(s)} AS {_named(s)}" for s in seq)
    early = ", ".join(f"-{_named(s)} AS {_named(s)}" for s in seq)
    order = f"CASE WHEN {rank} = 1 THEN struct({rank} AS rank, {late}) ELSE struct({rank} AS rank, {early}) END"
    return F.expr(f"max_by({_named(name)}, {order})")


def _latest(name: str, seq: Sequence[str]) -> Column:
    """The last value that is there."""
    order = f"struct({', '.join(map(_named, seq))})"
    return F.expr(f"max_by({_named(name)}, CASE WHEN {_named(name)} IS NOT NULL THEN {order} END)")


@built_once
def _size(name: str, kind: T.DataType) -> Column | None:
    """The length of a value as text, trimmed; None where no value is ever rich."""
    value = F.col(_named(name))
    if isinstance(kind, T.StringType):
        return F.length(strip(value))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.length(json_text(value, kind))
    return None


@built_once
def _rank(name: str, kind: T.DataType, policy: str) -> Column:
    """0 for a blank value, the length of a rich one, else 1."""
    value, size = _named(name), _named(f"_size_{name}")
    rich = "" if policy == LATEST else f"WHEN {size} >= {fixed.RICH_LENGTH} THEN {size} "

    def ranked(blank: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN 0 WHEN {blank} THEN 0 {rich}ELSE 1 END"

    if isinstance(kind, T.StringType):
        # Only a text of the length of a blank one is compared with those.
        return F.when(F.expr(f"{size} IN ({_BLANK_SIZES})") & is_blank(F.col(value)), F.lit(0)).otherwise(
            F.expr(ranked("false"))
        )
    return F.expr(ranked("false" if isinstance(kind, T.StructType) else f"size({value}) = 0"))


_BLANK_SIZES = ", ".join(str(n) for n in sorted({len(text) for text in fixed.BLANK_TEXTS}))


def _ranked(rows: DataFrame, fields: Sequence[T.StructField], policies: Mapping[str, str]) -> DataFrame:
    """Adds the rank of every field that can be rich.

    The sizes are columns first, which are used more than once, so Spark works them out once per row.
    """
    kinds = {f.name: f.dataType for f in fields}
    sizes = {n: size for n, kind in kinds.items() if (size := _size(n, kind)) is not None}
    ranks = {f"_rank_{n}": _rank(n, kinds[n], policies.get(n, RICHER)) for n in sizes}
    sized = rows.withColumns({f"_size_{n}": size for n, size in sizes.items()})
    return sized.withColumns(ranks).drop(*[f"_size_{n}" for n in sizes])


def merge_rows(
    rows: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    policies: Mapping[str, str] | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key (null keys are one key) with every other column merged.

    ``seq`` names the integral columns that order the rows. Ranks are columns of
    their own, so a value is trimmed and measured once per row.
    """
    policies = policies or {}
    fields = [f for f in rows.schema if f.name not in keys and f.name not in seq]
    rows = _ranked(rows, fields, policies)
    ranks = set(rows.columns)
    # numbers, flags and dates are always short: the last one that is there
    merged = [
        (_winner(f.name, seq) if f"_rank_{f.name}" in ranks else _latest(f.name, seq)).alias(f.name) for f in fields
    ]
    return rows.groupBy(*keys).agg(*merged, *extra)


def _order(value: Column, rank: Column | None, seq: Sequence[str]) -> Column:
    """What decides between two values of a column: the larger order wins, null never does."""
    late = [F.col(s).cast("bigint").alias(s) for s in seq]
    if rank is None:
        return F.when(value.isNotNull(), F.struct(F.lit(1).alias("rank"), *late))
    early = [(-F.col(s)).cast("bigint").alias(s) for s in seq]
    rank = rank.cast("int").alias("rank")
    return F.when(rank == 1, F.struct(rank, *late)).otherwise(F.struct(rank, *early))


def merge_state(
    rows: DataFrame, keys: Sequence[str], seq: Sequence[str], policies: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per key with, for every other column, its winner and the order that made it win.

    States merge with each other (`combine_states`), in any grouping, sequence and
    number of times, so rows that are part of a state are never needed again.
    """
    policies = policies or {}
    fields = [f for f in rows.schema if f.name not in keys and f.name not in seq]
    rows = _ranked(rows, fields, policies)
    ranks = set(rows.columns)
    orders = {
        f"_order_{f.name}": _order(F.col(f.name), F.col(f"_rank_{f.name}") if f"_rank_{f.name}" in ranks else None, seq)
        for f in fields
    }
    winners = []
    for f in fields:
        order = F.col(f"_order_{f.name}")
        pair = F.struct(order.alias("order"), F.col(f.name).alias("value"))
        winners.append(F.max_by(pair, order).alias(f.name))
    return rows.withColumns(orders).groupBy(*keys).agg(*winners)


def combine_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of several states to one row per key."""
    rest = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*[F.max_by(c, F.col(c)["order"]).alias(c) for c in rest])


def state_values(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merged rows of a state."""
    return state.select(*[F.col(c) if c in keys else F.col(c)["value"].alias(c) for c in state.columns])


def upsert(
    store: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    policies: Mapping[str, str] | None = None,
) -> DataFrame:
    """Merge a batch into a store; stored rows count as earlier than the batch."""
    stage = "_stage"
    both = store.withColumn(stage, F.lit(0)).unionByName(
        batch.withColumn(stage, F.lit(1)), allowMissingColumns=True
    )
    return merge_rows(both, keys, [stage, *seq], policies)


def counted_upsert(
    store: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    counters: Observation,
    policies: Mapping[str, str] | None = None,
) -> DataFrame:
    """`upsert` that counts while its rows are written; `observed_counters` has the result after that."""
    stage = "_stage"
    both = store.withColumn(stage, F.lit(0)).unionByName(
        batch.withColumn(stage, F.lit(1)), allowMissingColumns=True
    )
    extra = [F.min(stage).alias("_new"), F.sum(stage).alias("_arrived")]
    merged = merge_rows(both, keys, [stage, *seq], policies, extra)
    seen = merged.observe(
        counters, F.sum("_new").alias("inserted"), F.sum("_arrived").alias("arrived"), F.count(F.lit(1)).alias("total")
    )
    return seen.drop("_new", "_arrived")


def observed_counters(spark: SparkSession, counters: Observation) -> DataFrame:
    """One row (inserted, updated, total) of an upsert whose rows were written."""
    found = counters.get
    inserted, arrived = found["inserted"] or 0, found["arrived"] or 0
    return spark.createDataFrame([(inserted, arrived - inserted, found["total"])], "inserted bigint, updated bigint, total bigint")


def upsert_counters(store: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (inserted, updated, total); repeats inside a batch are updates.

    Only the keys are read, counted per key before the shuffle.
    """
    flagged = store.select(*keys, F.lit(0).alias("_new")).unionByName(
        batch.select(*keys, F.lit(1).alias("_new"))
    )
    per_key = flagged.groupBy(*keys).agg(
        F.min("_new").alias("only_new"), F.sum("_new").alias("arrived")
    )
    inserted = F.coalesce(F.sum("only_new"), F.lit(0)).cast("bigint")
    arrived = F.coalesce(F.sum("arrived"), F.lit(0)).cast("bigint")
    return per_key.agg(
        inserted.alias("inserted"),
        (arrived - inserted).alias("updated"),
        F.count(F.lit(1)).alias("total"),
    )


def inserted_keys(store: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of a batch that the store lacks; null keys match null keys."""
    new = batch.select(*keys).distinct().alias("b")
    old = store.select(*keys).distinct().alias("s")
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return new.join(old, same, "left_anti")


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; missing key parts count as the empty text."""
    text_keys = {f.name for f in rows.schema if isinstance(f.dataType, T.StringType)}
    grouped = [
        (F.coalesce(F.col(k), F.lit("")) if k in text_keys else F.col(k)).alias(k) for k in keys
    ]
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*grouped).agg(best).select(*keys, *[F.col(f"_row.{c}") for c in rest])
