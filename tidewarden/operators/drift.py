"""Error indicators, cut tests and summaries of a drift history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.operators.metrics import ratio
from tidewarden.operators.ordered import Running, running

CUT_BLOCK_ROWS = 32


def error_flag() -> Column:
    return (F.col("is_bot_pred") != F.col("is_bot")).cast("bigint")


def running_error(detections: DataFrame, **options) -> DataFrame:
    """0/1 error of each detection with the shard's error rate so far."""
    errors = detections.select("shard", "ts", "event_id", error_flag().alias("error"))
    summed = running(
        errors,
        {
            "instance_number": Running("sum", F.lit(1).cast("bigint")),
            "errors": Running("sum", F.col("error")),
        },
        **options,
    )
    return summed.withColumn("error_rate", F.col("errors") / F.col("instance_number"))


def cut_bound(n0: Column, n1: Column, mean: Column, delta: float) -> Column:
    """How far the means of two sub-windows may differ under no change (0/1 values)."""
    n = n0 + n1
    log_term = F.log(2 * F.log(n) / delta)
    inverse = 1 / n0 + 1 / n1
    return F.sqrt(2 * inverse * mean * (1 - mean) * log_term) + 2 / 3 * inverse * log_term


def error_blocks(errors: DataFrame, block_rows: int = CUT_BLOCK_ROWS) -> DataFrame:
    """Rows and errors per ``block_rows`` consecutive rows of :func:`running_error`."""
    block = F.floor((F.col("instance_number") - 1) / block_rows).cast("bigint")
    return errors.groupBy("shard", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("error").alias("errors"),
        F.max("instance_number").alias("instance_number"),
        F.max("ts").alias("ts"),
    )


def drift_cut_scan(blocks: DataFrame, delta: float, **options) -> DataFrame:
    """Every split of a shard's error sequence at a block end, with its cut test."""
    split = running(
        blocks,
        {"n0": Running("sum", F.col("n")), "s0": Running("sum", F.col("errors"))},
        order=("block",),
        **options,
    )
    whole = blocks.groupBy("shard").agg(
        F.sum("n").alias("total"), F.sum("errors").alias("total_errors")
    )
    n1 = F.col("total") - F.col("n0")
    s1 = F.col("total_errors") - F.col("s0")
    return (
        split.join(whole, "shard")
        .withColumns({"n1": n1, "s1": s1})
        .filter(F.col("n1") > 0)
        .withColumns(
            {
                "mean0": F.col("s0") / F.col("n0"),
                "mean1": F.col("s1") / F.col("n1"),
                "bound": cut_bound(
                    F.col("n0"), F.col("n1"), F.col("total_errors") / F.col("total"), delta
                ),
            }
        )
        .withColumn("cut", F.abs(F.col("mean0") - F.col("mean1")) > F.col("bound"))
    )


def recent_events(history: DataFrame, count: int) -> DataFrame:
    """The last ``count`` events of each shard, oldest first within a shard.

    The rank filter is applied per input partition before the shuffle, so a shard with
    a long history sends no more than ``count`` rows per task.
    """
    newest = Window.partitionBy("shard").orderBy(F.desc("instance_number"), F.desc("type"))
    return history.withColumn("newest", F.row_number().over(newest)).filter(
        F.col("newest") <= count
    )


def retrain_flags(history: DataFrame) -> DataFrame:
    """True for shards whose latest event is a drift."""
    latest = F.max_by("type", F.struct("instance_number", "type"))
    return history.groupBy("shard").agg((latest == "DRIFT").alias("should_retrain"))


def time_since_drift(detections: DataFrame, history: DataFrame) -> DataFrame:
    """Milliseconds from the last drift (or the first detection) to the last detection."""
    span = detections.groupBy("shard").agg(F.min("ts").alias("first"), F.max("ts").alias("as_of"))
    drifts = (
        history.filter(F.col("type") == "DRIFT").groupBy("shard").agg(F.max("ts").alias("drift"))
    )
    since = F.unix_millis("as_of") - F.unix_millis(F.coalesce("drift", "first"))
    return span.join(drifts, "shard", "left").select("shard", since.alias("ms_since_drift"))


def drift_summary(watched: DataFrame, history: DataFrame, reset: bool = True) -> DataFrame:
    """Checks, warnings, drifts, drift rate, latest error, window and zone per shard.

    ``watched`` is what :func:`tidewarden.operators.windows.watch` gives. With ``reset`` a drift at the last
    row leaves an empty window.
    """
    latest = F.struct("instance_number", "error_rate", "window_length", "in_warning_zone", "drift")
    checks = watched.groupBy("shard").agg(
        F.count(F.lit(1)).alias("checks"), F.max(latest).alias("last")
    )
    counts = history.groupBy("shard").agg(
        F.count_if(F.col("type") == "WARNING").alias("warnings"),
        F.count_if(F.col("type") == "DRIFT").alias("drifts"),
    )
    drifts = F.coalesce("drifts", F.lit(0))
    emptied = F.col("last.drift") & F.lit(reset)
    return checks.join(counts, "shard", "left").select(
        "shard",
        "checks",
        F.coalesce("warnings", F.lit(0)).alias("warnings"),
        drifts.alias("drifts"),
        ratio(drifts, F.col("checks")).alias("drift_rate"),
        F.when(emptied, 0.0).otherwise(F.col("last.error_rate")).alias("current_error_rate"),
        F.when(emptied, 0).otherwise(F.col("last.window_length")).alias("window_length"),
        F.col("last.in_warning_zone").alias("in_warning_zone"),
    )
