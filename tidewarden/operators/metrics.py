"""Confusion counts, rates and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.operators.ordered import Running, as_of, rolling_sums, running
from tidewarden.schema import DetectorOptions

CELLS = ("tp", "tn", "fp", "fn")


def cell_flags(predicted: Column, actual: Column) -> dict[str, Column]:
    hits = {
        "tp": predicted & actual,
        "tn": ~predicted & ~actual,
        "fp": predicted & ~actual,
        "fn": ~predicted & actual,
    }
    return {name: hit.cast("bigint") for name, hit in hits.items()}


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def rates(tp: Column, tn: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision = ratio(tp, tp + fp)
    recall = ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": F.when(
            precision + recall > 0, 2 * (precision * recall) / (precision + recall)
        ).otherwise(0.0),
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
    }


def _rates_of_cells() -> dict[str, Column]:
    return rates(*[F.col(name) for name in CELLS])


def confusion_matrix(detections: DataFrame, *by: str) -> DataFrame:
    flags = cell_flags(F.col("is_bot_pred"), F.col("is_bot"))
    return detections.groupBy(*by).agg(
        *[F.coalesce(F.sum(flag), F.lit(0)).alias(name) for name, flag in flags.items()]
    )


def detection_metrics(detections: DataFrame, *by: str) -> DataFrame:
    """Confusion counts with precision, recall, F1 and accuracy."""
    cells = confusion_matrix(detections, *by)
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return cells.withColumns({"detections": total, **_rates_of_cells()})


def bot_rate(detections: DataFrame, *by: str) -> DataFrame:
    events = F.count(F.lit(1))
    bots = F.count_if("is_bot_pred")
    return detections.groupBy(*by).agg(
        events.alias("events"),
        bots.alias("bots"),
        ratio(bots, events).alias("bot_rate"),
        ratio(bots * 100.0, events).alias("bot_percent"),
    )


def throughput(events: DataFrame, *by: str) -> DataFrame:
    """Events per second between the first and the last event."""
    span = F.unix_millis(F.max("ts")) - F.unix_millis(F.min("ts"))
    count = F.count(F.lit(1))
    return events.groupBy(*by).agg(
        count.alias("events"),
        span.alias("span_ms"),
        ratio(count * 1000.0, span).alias("events_per_second"),
    )


def bad_record_rate(decoded: DataFrame, bad: Column, *by: str) -> DataFrame:
    errors = F.count_if(bad)
    return decoded.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        errors.alias("errors"),
        ratio(errors, F.count(F.lit(1))).alias("error_rate"),
    )


def ensemble_accuracy(detections: DataFrame, *by: str) -> DataFrame:
    """Share of plain votes (before the confidence threshold) equal to the label."""
    correct = F.count_if(F.col("vote") == F.col("is_bot"))
    return detections.groupBy(*by).agg(
        F.count(F.lit(1)).alias("seen"),
        correct.alias("correct"),
        ratio(correct, F.count(F.lit(1))).alias("accuracy"),
    )


def model_accuracy(model_votes: DataFrame) -> DataFrame:
    """Per (shard, model): seen, correct and accuracy of single-model votes."""
    correct = F.count_if(F.col("bot") == F.col("is_bot"))
    return model_votes.groupBy("shard", "model_id").agg(
        F.count(F.lit(1)).alias("seen"),
        correct.alias("correct"),
        ratio(correct, F.count(F.lit(1))).alias("accuracy"),
    )


def model_accuracy_summary(accuracies: DataFrame, *by: str) -> DataFrame:
    return accuracies.groupBy(*by).agg(
        *[
            F.coalesce(agg("accuracy"), F.lit(0.0)).alias(f"{name}_accuracy")
            for name, agg in (("avg", F.avg), ("min", F.min), ("max", F.max))
        ]
    )


def best_model(accuracies: DataFrame) -> DataFrame:
    """Highest accuracy per shard; the lowest index wins a tie."""
    key = F.struct(-F.col("accuracy"), F.col("model_id"))
    return accuracies.groupBy("shard").agg(F.min_by("model_id", key).alias("model_id"))


def worst_model(accuracies: DataFrame) -> DataFrame:
    """Lowest accuracy per shard; the lowest index wins a tie."""
    key = F.struct("accuracy", "model_id")
    return accuracies.groupBy("shard").agg(F.min_by("model_id", key).alias("model_id"))


def periodic_metrics(detections: DataFrame, every: int, **options) -> DataFrame:
    """Metrics as they stood after each ``every``-th detection of a shard."""
    flags = cell_flags(F.col("is_bot_pred"), F.col("is_bot"))
    narrow = detections.select("shard", "ts", "event_id", "is_bot_pred", "is_bot")
    counted = running(
        narrow,
        {
            "instance_number": Running("sum", F.lit(1).cast("bigint")),
            **{name: Running("sum", flag) for name, flag in flags.items()},
        },
        **options,
    )
    due = counted.filter(F.col("instance_number") % every == 0)
    return due.select("shard", "ts", "event_id", "instance_number", *CELLS).withColumns(
        _rates_of_cells()
    )


def metrics_in_force(
    detections: DataFrame, probes: DataFrame, options: DetectorOptions, **as_of_options
) -> DataFrame:
    """Each probe (shard, ts, ...) with the metrics that stand at its time.

    They are those of the last detection whose number is a multiple of ``options.update_frequency``;
    before the first such one all are 0, as a detector starts.
    """
    facts = periodic_metrics(detections, options.update_frequency)
    measured = ("instance_number", *CELLS, "precision", "recall", "f1", "accuracy")
    found = as_of(probes, facts, measured, "instance_number", **as_of_options)
    return found.withColumns({m: F.coalesce(F.col(m), F.lit(0).cast(found.schema[m].dataType)) for m in measured})


def rolling_metrics(detections: DataFrame, size: int, **options) -> DataFrame:
    """Metrics over the last ``size`` detections of each shard."""
    flags = cell_flags(F.col("is_bot_pred"), F.col("is_bot"))
    narrow = detections.select("shard", "ts", "event_id", "is_bot_pred", "is_bot")
    numbered = running(
        narrow, {"instance_number": Running("sum", F.lit(1).cast("bigint"))}, **options
    )
    summed = rolling_sums(numbered, flags, size)
    return summed.drop("is_bot_pred", "is_bot").withColumns(_rates_of_cells())


def metric_evolution(detections: DataFrame, width: str, *by: str) -> DataFrame:
    """Metrics per tumbling window of event time; works on streams with a watermark."""
    window = F.window("ts", width)
    flags = cell_flags(F.col("is_bot_pred"), F.col("is_bot"))
    return (
        detections.groupBy(window, *by)
        .agg(*[F.sum(flag).alias(name) for name, flag in flags.items()])
        .withColumns({"window_start": F.col("window.start"), **_rates_of_cells()})
        .drop("window")
    )
