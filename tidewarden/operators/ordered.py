"""Running values over an ordered stream, without one task per stream.

A plain window partitioned by shard sorts a whole shard in one task. Here a key's rows
are cut into chunks by time: buckets of a fixed width, a documented option. The chunks are
aggregated, the few chunk totals are accumulated, and each chunk gets its carried total
as a first row, so that one window inside the chunk gives the running value. All rows move
once, by (keys, chunk). The result equals the plain window for any width, so one hot key
costs no more than many cold ones; nothing is sampled, counted or written first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Width of a chunk, in seconds where the order starts with a time. It bounds a task's rows to what
#: one key has in that time; a key has as many chunk totals as its history has such spans.
CHUNK_SECONDS = 3600
#: Width of a chunk where the order starts with a number.
CHUNK_NUMBERS = 1_000_000
KEYS = ("shard",)
ORDER = ("ts", "event_id")
_NULLS_FIRST = -(1 << 62)


@dataclass(frozen=True)
class Running:
    """One running value: ``how`` (sum, max, min) of ``value`` over the rows so far.

    ``inclusive=False`` leaves the current row out. ``start`` is the value before the
    first row (null by default for max and min, 0 for sums).
    """

    how: str
    value: Column
    inclusive: bool = True
    start: object = None


def chunked(df: DataFrame, order: tuple[str, ...] = ORDER, width: int | None = None) -> DataFrame:
    """Add ``chunk``, the bucket of the first order column; rows without a value come first."""
    first = F.col(order[0])
    if isinstance(df.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType)):
        first, width = F.unix_micros(first.cast("timestamp")), (width or CHUNK_SECONDS) * 1_000_000
    bucket = F.floor(first / (width or CHUNK_NUMBERS)).cast("bigint")
    return df.withColumn("chunk", F.coalesce(bucket, F.lit(_NULLS_FIRST)))


def with_running(
    rows: DataFrame,
    values: dict[str, Running],
    keys: tuple[str, ...] = KEYS,
    order: tuple[str, ...] = ORDER,
) -> DataFrame:
    """Add running values to a table from :func:`chunked`. Rows with a null key are kept,
    as a key of their own."""
    spec = {name: (getattr(F, r.how), f"_at_{name}", r) for name, r in values.items()}
    totals = rows.groupBy(*keys, "chunk").agg(*[agg(r.value).alias(at) for agg, at, r in spec.values()])
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.lit(0 if r.how == "sum" and r.start is None else r.start) for r in values.values()]
    carried = totals.select(
        *keys,
        "chunk",
        F.lit(False).alias("_row"),
        *[F.coalesce(agg(at).over(before), start).alias(at) for (agg, at, _), start in zip(spec.values(), starts)],
    )
    own = rows.withColumns({"_row": F.lit(True), **{at: r.value for _, at, r in spec.values()}})
    chunk = Window.partitionBy(*keys, "chunk").orderBy("_row", *order)
    columns = {
        name: agg(at).over(chunk.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1))
        for name, (agg, at, r) in spec.items()
    }
    both = own.unionByName(carried, allowMissingColumns=True)
    return both.withColumns(columns).filter("_row").drop("_row", *[at for _, at, _ in spec.values()])


def running(
    df: DataFrame,
    values: dict[str, Running],
    keys: tuple[str, ...] = KEYS,
    order: tuple[str, ...] = ORDER,
    width: int | None = None,
) -> DataFrame:
    return with_running(chunked(df, order, width), values, keys, order).drop("chunk")


def instance_number(df: DataFrame, **options) -> DataFrame:
    """1-based position of each event in its detector's stream."""
    return running(df, {"instance_number": Running("sum", F.lit(1).cast("bigint"))}, **options)


def as_of(
    probes: DataFrame,
    facts: DataFrame,
    values: tuple[str, ...],
    tie: str,
    keys: tuple[str, ...] = KEYS,
    order: str = "ts",
    width: int | None = None,
) -> DataFrame:
    """Each probe with the ``values`` of the newest fact of its key at or before its ``order``.

    Of facts at the same time the one with the highest ``tie`` counts. Facts and probes run
    through one ordered stream, and the last fact is carried from chunk to chunk as a running
    value: there is no range join, and a key with most of the rows is cut like any other. Probes
    without an earlier fact get nulls; a probe without a time has no fact.
    """
    fact = F.struct(F.col(order).alias("_at"), F.col(tie).alias("_tie"), *values)
    told = facts.filter(F.col(order).isNotNull()).select(*keys, order, F.lit(False).alias("_probe"), fact.alias("_fact"))
    asked = probes.withColumns({"_probe": F.lit(True), "_fact": F.lit(None).cast(told.schema["_fact"].dataType)})
    both = chunked(asked.unionByName(told, allowMissingColumns=True), (order,), width)
    carried = with_running(both, {"_last": Running("max", F.col("_fact"))}, keys, (order, "_probe"))
    return carried.filter("_probe").select(*probes.columns, *[F.col("_last")[v].alias(v) for v in values])


def rolling_sums(
    numbered: DataFrame,
    values: dict[str, Column],
    size: int,
    keys: tuple[str, ...] = KEYS,
    block_rows: int | None = None,
) -> DataFrame:
    """Sums over the last ``size`` rows of rows that carry ``instance_number``.

    Rows are cut into blocks by number; each block's last ``size - 1`` rows are repeated
    in the next block, so every frame lies in one block of bounded size.
    """
    block_rows = max(block_rows or 100 * size, size)
    position = F.col("instance_number") - 1
    block = F.floor(position / block_rows).cast("bigint")
    spills = position % block_rows >= block_rows - (size - 1)
    repeated = numbered.withColumn(
        "_block", F.explode(F.when(spills, F.array(block, block + 1)).otherwise(F.array(block)))
    )
    frame = (
        Window.partitionBy(*keys, "_block").orderBy("instance_number").rowsBetween(1 - size, 0)
    )
    summed = repeated.withColumns({name: F.sum(v).over(frame) for name, v in values.items()})
    return summed.filter(F.col("_block") == block).drop("_block")
