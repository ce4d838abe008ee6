"""The adaptive window over blocks of errors, and what it says of every detection.

Detections are numbered per shard and their errors summed in blocks of consecutive rows, all in
parallel; only those sums, one row for each block, go through the window in order, one
fold a shard. The window is an exponential histogram, so a fold holds a few dozen buckets however long the
history is. Its histogram is a table (shard, level, place, n, errors): a later fold can go on from
it, and :func:`windows_in_segments` hands it from one span of the history to the next.

A cut is looked for at the end of every full block. After a cut the older buckets are gone; with
``reset`` the detector has answered the drift and its next window starts empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.learning.adwin import AdaptiveWindow
from tidewarden.operators.drift import CUT_BLOCK_ROWS, running_error
from tidewarden.operators.metrics import ratio
from tidewarden.session import scratch_path, ship_package, shuffle_width, written
from tidewarden.sources.model_store import is_written, numbered_folders

_BUCKETS = "array<struct<level:int,place:int,n:bigint,errors:bigint>>"
_FOLD = (
    "shard int, block bigint, n bigint, errors bigint, instance_number bigint, ts timestamp, errors_before bigint, "
    "width_before bigint, window_errors_before bigint, drift_before boolean, width bigint, window_errors bigint, drift boolean, "
    f"ticks bigint, after_drift boolean, span bigint, buckets {_BUCKETS}"
)
_NAMES = [field.split()[0] for field in _FOLD.split(", ")]
_STATE = ("shard", "block", "ticks", "after_drift", "buckets")
#: Spans that are folded and written together; a stopped run goes on after the last of them.
SPANS_PER_WRITE = 64


def error_sums(errors: DataFrame, block_rows: int = CUT_BLOCK_ROWS) -> DataFrame:
    """Sums of ``block_rows`` consecutive rows of :func:`running_error`, with the errors before them."""
    block = F.floor((F.col("instance_number") - 1) / block_rows).cast("bigint")
    return errors.groupBy("shard", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("error").alias("errors"),
        F.max("instance_number").alias("instance_number"),
        F.max("ts").alias("ts"),
        F.min(F.col("errors") - F.col("error")).alias("errors_before"),
    )


def fold_windows(
    sums: DataFrame, delta: float, reset: bool = True, start: DataFrame | None = None,
    spans: tuple[int, int, int] | None = None,
) -> DataFrame:
    """One row a block with the window before and after it, then one row a shard with its histogram.

    ``spans`` (blocks of a span, first and last span of ``sums``) gives a shard's histogram at the end of
    every ``span``, not of the last one only.

    Use :func:`block_windows` and :func:`final_windows` on the (written) result. ``start`` is what
    :func:`final_windows` gave for an earlier part of the history; shards without one start empty,
    shards without new blocks keep theirs.
    """
    names = _NAMES
    size, first_span, last_span = spans or (0, 0, 0)
    ship_package(sums.sparkSession)

    def fold(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window, after_drift, block, span = AdaptiveWindow(delta), False, -1, None

        def state() -> pd.DataFrame:
            buckets = [
                {"level": level, "place": place, "n": int(n), "errors": int(s)}
                for level, row in enumerate(window.rows) for place, (n, s) in enumerate(row)
            ]
            kept = {"shard": int(key[0]), "block": block, "ticks": window.ticks, "after_drift": after_drift, "span": span, "buckets": buckets}
            return pd.DataFrame([dict.fromkeys(names) | kept], columns=names)

        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                if row["buckets"] is not None:
                    window, after_drift = _window_of(row, delta), bool(row["after_drift"])
                    block, span = int(row["block"]), first_span
                    continue
                here = int(row["block"]) // size if size else 0
                span = here if span is None else span
                if span < here and rows:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
                while span < here:
                    yield state()
                    span += 1
                before = (window.width, int(window.total), after_drift)
                drift = window.add(float(row["errors"]), int(row["n"]))
                rows.append((*(row[c] for c in names[:7]), *before, window.width, int(window.total), drift, None, None, None, None))
                if drift and reset:
                    window = AdaptiveWindow(delta)
                after_drift, block = drift, int(row["block"])
            if rows:
                yield pd.DataFrame(rows, columns=names)
        for span in range(first_span if span is None else span, last_span + 1):
            yield state()

    kept = F.lit(None).cast(_BUCKETS)
    rows = sums.select("*", F.lit(0).cast("bigint").alias("ticks"), F.lit(False).alias("after_drift"), kept.alias("buckets"))
    if start is not None:
        zeros = [F.lit(0).cast("bigint").alias(c) for c in ("n", "errors", "instance_number", "errors_before")]
        first = start.select(*_STATE, *zeros, F.lit(None).cast("timestamp").alias("ts"))
        rows = rows.unionByName(first)
    ordered = rows.repartitionById(shuffle_width(sums.sparkSession), F.col("shard")).sortWithinPartitions(
        "shard", F.col("buckets").isNull(), "block"
    )
    return ordered.groupBy("shard").applyInPandas(fold, _FOLD)


def _window_of(row: dict, delta: float) -> AdaptiveWindow:
    levels: list[list[tuple]] = [[]]
    for bucket in sorted(row["buckets"], key=lambda b: (b["level"], b["place"])):
        while len(levels) <= bucket["level"]:
            levels.append([])
        levels[bucket["level"]].append((bucket["n"], float(bucket["errors"])))
    return AdaptiveWindow(delta, levels, int(row["ticks"]))


def block_windows(folded: DataFrame) -> DataFrame:
    return folded.filter("buckets is null").drop(*_STATE[2:], "span")


def final_windows(folded: DataFrame) -> DataFrame:
    """(shard, block, ticks, after_drift, buckets): what a later fold needs to go on."""
    return folded.filter("buckets is not null").select(*_STATE)


def histogram(final: DataFrame) -> DataFrame:
    """(shard, level, place, n, errors), one row a bucket; place 0 is the newest of its level."""
    return final.select("shard", F.inline("buckets"))


def windows_in_segments(
    sums: DataFrame, delta: float, segment_blocks: int, reset: bool = True, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(block windows, final windows) of a history folded span by span of ``segment_blocks`` blocks.

    Spans are folded one after the other, :data:`SPANS_PER_WRITE` in one job, which writes their rows and the
    histograms at the end of each under ``path``, in a folder named by its last span. Spans that are already
    written there are not folded again: a run that was stopped goes on after them.
    """
    spark = sums.sparkSession
    path = path or scratch_path(spark, "windows")
    sums = written(sums.sort("block"), "sums")  # read for each group of spans, by its blocks
    last = sums.agg(F.max("block")).first()[0]
    end = 0 if last is None else last // segment_blocks
    done = [span for span in numbered_folders(spark, path, "span") if is_written(spark, f"{path}/span={span}")]
    read = lambda spans: spark.read.schema(_FOLD).parquet(*[f"{path}/span={span}" for span in spans])
    while not done or done[-1] < end:
        first = done[-1] + 1 if done else 0
        until = min(first + SPANS_PER_WRITE - 1, end)
        own = sums.filter(F.col("block").between(first * segment_blocks, (until + 1) * segment_blocks - 1))
        start = final_windows(read(done[-1:]).filter(F.col("span") == done[-1])) if done else None
        folded = fold_windows(own, delta, reset, start, (segment_blocks, first, until))
        folded.write.mode("overwrite").parquet(f"{path}/span={until}")
        done.append(until)
    rows = read(done).filter(F.coalesce("span", F.floor(F.col("block") / segment_blocks)) <= end)
    return block_windows(rows), final_windows(rows.filter(F.col("span") == end))


def watched_errors(
    errors: DataFrame, blocks: DataFrame, warning_level: float, block_rows: int = CUT_BLOCK_ROWS
) -> DataFrame:
    """Every row of :func:`running_error` under the window it is in.

    Adds ``error_rate`` (the window's estimate), ``window_length``, ``drift``, ``in_warning_zone`` and the
    zone's ``warning_entered`` and ``warning_left``. Rows meet the window of their own block by (shard, block),
    so no shard gathers in one task.
    """
    block = F.floor((F.col("instance_number") - 1) / block_rows).cast("bigint")
    windows = blocks.select(
        "shard", "block", F.col("instance_number").alias("_end"), "errors_before", "width_before", "window_errors_before",
        "drift_before", "width", "window_errors", F.col("drift").alias("_drift"),
    )
    rows = errors.drop("error_rate").withColumn("block", block).join(windows, ["shard", "block"])
    place = F.col("instance_number") - block * block_rows
    inside = F.col("errors") - F.col("errors_before")
    at_end = F.col("instance_number") == F.col("_end")
    drift = at_end & F.col("_drift")
    whole = F.col("width_before") + place
    rate = F.when(at_end, F.col("window_errors") / F.col("width")).otherwise((F.col("window_errors_before") + inside) / whole)
    zone = ~drift & (rate > warning_level)
    first = place == 1
    earlier = ratio(F.col("window_errors_before") + inside - F.col("error"), whole - 1)
    was = (earlier > warning_level) & ~(first & F.col("drift_before"))
    entered, left = zone & ~was, ~zone & was & ~drift
    return rows.select(
        "shard", "ts", "event_id", "error", "instance_number", rate.alias("error_rate"),
        F.when(at_end, F.col("width")).otherwise(whole).alias("window_length"), drift.alias("drift"),
        zone.alias("in_warning_zone"), entered.alias("warning_entered"), left.alias("warning_left"),
    )


def watch(detections: DataFrame, delta: float, warning_level: float, reset: bool = True, start: DataFrame | None = None) -> DataFrame:
    """Detections (shard, ts, event_id, is_bot_pred, is_bot) under their adaptive window; see :func:`watched_errors`."""
    errors = written(running_error(detections), "errors")
    folded = written(fold_windows(error_sums(errors), delta, reset, start), "windows")
    return watched_errors(errors, block_windows(folded), warning_level)


def watched_history(watched: DataFrame) -> DataFrame:
    """All WARNING and DRIFT events, as they happened."""
    kind: Column = F.when(F.col("drift"), "DRIFT").otherwise("WARNING")
    return watched.filter("drift or warning_entered").select(
        "shard", "instance_number", "ts", "error_rate", kind.alias("type")
    )
