"""Exact learning: one ordered fold per shard, every shard in parallel.

The fold streams its group in Arrow batches and keeps one detector in memory, so a
group's size never has to fit in a task. Its running time does grow with the group:
shards are an even hash split, and their number has to grow with the data
(:func:`shards_for`). One global model over any amount of
data is what :mod:`tidewarden.learning.mixing` is for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.draws import copies_per_model
from tidewarden.functions.features import feature_value
from tidewarden.learning.detector import (
    BLOCK_ROWS,
    Detector,
    detector_from_json,
    detector_to_json,
    fold_block,
)
from tidewarden.learning.kernel import row_of_model
from tidewarden.operators.control import CONTROL_COLUMNS
from tidewarden.schema import (
    DETECTION_SCHEMA,
    FEATURES,
    MODEL_STATE_SCHEMA,
    N_FEATURES,
    DetectorOptions,
)
from tidewarden.session import ship_package, shuffle_width
from tidewarden.sources.model_store import is_written

FEATURE_COLUMNS = [f"f{i}" for i in range(N_FEATURES)]
_WATCHED = [
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("window_length", T.IntegerType()),
    T.StructField("instance_number", T.LongType()),
    T.StructField("warning", T.BooleanType()),
    T.StructField("drift", T.BooleanType()),
    T.StructField("in_warning_zone", T.BooleanType()),
]
WATCHED_SCHEMA = T.StructType(DETECTION_SCHEMA.fields + _WATCHED)
FOLD_SCHEMA = T.StructType(
    WATCHED_SCHEMA.fields + [T.StructField("models", T.ArrayType(MODEL_STATE_SCHEMA))]
)
EXACT_SCHEMA = T.StructType(FOLD_SCHEMA.fields + [T.StructField("detector", T.StringType())])


def shards_for(rows: int, rows_per_shard: int, at_least: int = 8) -> int:
    """Detectors needed so that none holds much more than ``rows_per_shard`` rows."""
    return max(at_least, math.ceil(rows / rows_per_shard))


def copy_columns(options: DetectorOptions) -> list[str]:
    return [f"k{m}" for m in range(options.n_models)]


def fold_input(events: DataFrame, options: DetectorOptions) -> DataFrame:
    """Flat numeric columns: they reach the fold as Arrow buffers, not as objects.

    Columns of :mod:`tidewarden.operators.control` go along where the events have them.
    """
    flat = events.select(
        "shard",
        "ts",
        "event_id",
        *[feature_value(f).alias(c) for f, c in zip(FEATURES, FEATURE_COLUMNS)],
        "is_bot",
        *[c for c in CONTROL_COLUMNS if c in events.columns],
        copies_per_model("event_id", options.n_models, options.seed).alias("_copies"),
    )
    copies = [F.col("_copies")[m].alias(c) for m, c in enumerate(copy_columns(options))]
    return flat.select("*", *copies).drop("_copies")


def fold_frame(detector: Detector, frame: pd.DataFrame, options: DetectorOptions) -> pd.DataFrame:
    """Detections of an ordered frame; the detector learns from it block by block."""
    parts = []
    x = frame[FEATURE_COLUMNS].to_numpy(float)
    is_bot = frame["is_bot"].to_numpy(bool)
    copies = frame[copy_columns(options)].to_numpy()
    control = {c: frame[c].to_numpy() for c in CONTROL_COLUMNS if c in frame}
    for at in range(0, len(frame), BLOCK_ROWS):
        rows = slice(at, at + BLOCK_ROWS)
        obeyed = {c: values[rows] for c, values in control.items()}
        parts.append(
            pd.DataFrame(fold_block(detector, x[rows], is_bot[rows], copies[rows], options, **obeyed))
        )
    folded = pd.concat(parts, ignore_index=True)
    for name in ("event_id", "shard", "ts", "is_bot"):
        folded[name] = frame[name].to_numpy()
    return folded


def _state_frame(shard: int, detector: Detector) -> pd.DataFrame:
    empty = {name: [None] for name in EXACT_SCHEMA.fieldNames()}
    rows = [row_of_model(shard, m, 1, model) for m, model in enumerate(detector.models)]
    kept = {"models": [rows], "detector": [detector_to_json(detector)]}
    return pd.DataFrame({**empty, "shard": [shard], **kept})


def dealt(rows: DataFrame, group: str, *first: Column, width: int | None = None) -> DataFrame:
    """Rows in event order within their group (after ``first``), the numbered groups dealt out in turn.

    Hashing a few group numbers can put many on one task, and so can merging small
    partitions; here each task gets as many groups as any other. The grouped fold that
    follows needs no shuffle or sort of its own. ``width`` is the number of tasks, where fewer groups than
    the session's partitions are known.
    """
    width = width or shuffle_width(rows.sparkSession)
    return rows.repartitionById(width, F.col(group)).sortWithinPartitions(
        group, *first, "ts", "event_id"
    )


def exact_fold(
    events: DataFrame, options: DetectorOptions, start: DataFrame | None = None
) -> DataFrame:
    """Detections of every event, then one row per shard with the final models.

    Use :func:`detections_of`, :func:`final_state` and :func:`final_detectors` on the
    (written) result. ``start`` (shard, detector; one row per shard) holds detectors of an
    earlier fold to go on from, with drift window, zone and counters; it travels as the first
    row of its shard. Shards without one start fresh; those without events keep theirs.
    """
    names = EXACT_SCHEMA.fieldNames()
    ship_package(events.sparkSession)

    def fold(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = None
        for frame in frames:
            if detector is None and len(frame):
                kept = frame["detector"].iloc[0] if "detector" in frame else None
                detector = detector_from_json(kept, options) if kept else Detector.fresh(options)
                frame = frame.iloc[1:] if kept else frame
            if len(frame):
                folded = fold_frame(detector, frame, options)
                yield folded.assign(models=None, detector=None)[names]
        yield _state_frame(int(key[0]), detector)[names]

    rows = fold_input(events, options)
    if start is None:
        ordered = dealt(rows, "shard")
    else:
        zeros = [  # no nulls, so that whole numbers stay whole numbers in the fold
            F.lit(0).cast(field.dataType).alias(field.name)
            for field in rows.schema
            if field.name not in ("shard", "ts")
        ]
        first = start.filter("detector is not null").select("shard", "detector", *zeros)
        rows = rows.unionByName(first, allowMissingColumns=True)
        ordered = dealt(rows, "shard", F.col("detector").isNull())
    return ordered.groupBy("shard").applyInPandas(fold, EXACT_SCHEMA)


def exact_fold_in_segments(
    events: DataFrame, options: DetectorOptions, seconds: int, path: str, start: DataFrame | None = None
) -> DataFrame:
    """:func:`exact_fold` time segment by time segment, the detectors written between them.

    A segment holds ``seconds`` of event time (events without a time come first). Each is written
    under ``path`` before the next one starts, and one that is already written is not folded
    again, so a stopped run goes on where it was, a lost executor repeats one segment at
    most, and no task runs longer than a segment takes. The result is that of one fold.
    ``events`` are read once for each segment, by their time: store them sorted or partitioned by it.
    """
    spark = events.sparkSession
    segment = F.coalesce(F.floor(F.unix_micros("ts") / (seconds * 1_000_000)), F.lit(-(1 << 62)))
    found = [r["segment"] for r in events.select(segment.alias("segment")).distinct().orderBy("segment").collect()]
    parts: list[DataFrame] = []
    for number in found:
        place = f"{path}/segment={number}"
        if not is_written(spark, place):
            exact_fold(events.filter(segment == number), options, start).write.mode("overwrite").parquet(place)
        folded = spark.read.schema(EXACT_SCHEMA).parquet(place)
        start = final_detectors(folded)
        parts.append(folded)
    if not parts:
        return exact_fold(events, options, start)
    whole = spark.read.schema(EXACT_SCHEMA).parquet(*[f"{path}/segment={n}" for n in found])
    return whole.filter(F.col("event_id").isNotNull()).unionByName(parts[-1].filter(F.col("event_id").isNull()))


def detections_of(folded: DataFrame) -> DataFrame:
    return folded.filter(F.col("event_id").isNotNull()).drop("models", "detector")


def final_detectors(folded: DataFrame) -> DataFrame:
    """(shard, detector): everything a later fold needs to go on."""
    return folded.filter(F.col("event_id").isNull()).select("shard", "detector")


def final_state(folded: DataFrame) -> DataFrame:
    return folded.filter(F.col("event_id").isNull()).select(F.inline("models"))


def drift_events_of(detections: DataFrame) -> DataFrame:
    """WARNING and DRIFT events the fold raised."""
    kind = F.when(F.col("drift"), "DRIFT").otherwise("WARNING")
    return detections.filter("drift OR warning").select(
        "shard", "instance_number", "ts", "error_rate", kind.alias("type")
    )
