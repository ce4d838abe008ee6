"""Report formatting: status bands, percentages, event summaries, model size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewarden.functions.scoring import clamp
from tidewarden.schema import N_FEATURES

# Fixed values: (good, warning) limits; error is good when low, the rest when high.
BANDS = {
    "accuracy": (0.9, 0.7),
    "precision": (0.9, 0.7),
    "f1": (0.9, 0.7),
    "recall": (0.85, 0.65),
    "error": (0.05, 0.1),
}


def status_band(value: Column, kind: str) -> Column:
    if kind not in BANDS:
        return F.lit("")
    good, warning = BANDS[kind]
    if kind == "error":
        return F.when(value <= good, "good").when(value <= warning, "warning").otherwise("danger")
    return F.when(value >= good, "good").when(value >= warning, "warning").otherwise("danger")


def format_percent(value: Column) -> Column:
    return F.when(value.isNull(), "0%").otherwise(F.format_string("%.2f%%", value * 100))


def bar_width(value: Column) -> Column:
    return clamp(value * 100, 0.0, 100.0)


def model_size(rules: Column) -> Column:
    """Estimated bytes: 100 per rule plus three arrays of doubles."""
    return (F.size(rules) * 100 + 3 * N_FEATURES * 8).cast("double")


def event_summary() -> Column:
    return F.format_string(
        "TrafficEvent{session=%s, ip=%s, rps=%d, isBot=%s, confidence=%.2f}",
        F.col("session_id"),
        F.col("ip_address"),
        F.col("requests_per_second"),
        F.col("is_bot").cast("string"),
        F.col("confidence"),
    )
