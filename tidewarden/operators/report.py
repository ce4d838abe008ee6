"""The nested metrics document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.operators import metrics


def metrics_snapshot(detections: DataFrame, drift: DataFrame) -> DataFrame:
    """One JSON document: detector metrics with drift totals, and processor rates.

    Over several shards the error rate is that of all their windows together, and the
    warning zone counts the shards that are in it.

    All inputs are aggregated to single rows first; only those meet on the join.
    """
    one = F.lit(1).alias("_one")
    detector = metrics.detection_metrics(detections).withColumn("_one", F.lit(1))
    wrong = F.col("current_error_rate") * F.col("window_length")
    totals = drift.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("checks", "warnings", "drifts", "window_length")],
        F.coalesce(F.sum(wrong), F.lit(0.0)).alias("wrong"),
        F.count_if("in_warning_zone").alias("in_warning_zone"),
    )
    state = F.struct(
        "checks",
        "warnings",
        "drifts",
        metrics.ratio(F.col("drifts"), F.col("checks")).alias("drift_rate"),
        metrics.ratio(F.col("wrong"), F.col("window_length")).alias("current_error_rate"),
        "window_length",
        "in_warning_zone",
    )
    totals = totals.select(one, state.alias("drift"))
    rate = metrics.bot_rate(detections).withColumn("_one", F.lit(1))
    speed = metrics.throughput(detections).select(one, "events_per_second")
    joined = detector.join(totals, "_one").join(rate, "_one").join(speed, "_one")
    return joined.select(
        F.to_json(
            F.struct(
                F.struct(
                    "detections", *metrics.CELLS, "accuracy", "precision", "recall", "f1", "drift"
                ).alias("detector"),
                F.struct("events", "bots", "bot_percent", "events_per_second").alias("processor"),
            )
        ).alias("document")
    )
