"""Exact test-then-train detection on a stream, one keyed state per shard."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewarden.learning.detector import Detector, detector_from_json, detector_to_json
from tidewarden.learning.exact import WATCHED_SCHEMA, fold_frame, fold_input
from tidewarden.schema import DetectorOptions
from tidewarden.session import ship_package


class ShardDetector(StatefulProcessor):
    """Folds a shard's new events into its detector, in event order per micro-batch."""

    def __init__(self, options: DetectorOptions):
        self.options = options

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("detector", "detector string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.kept.update((initialState["detector"].iloc[0],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One shard's share of one micro-batch; the trigger's admission limit bounds it.
        frames = [frame for frame in rows if len(frame)]
        if not frames:
            return
        frame = pd.concat(frames).sort_values(["ts", "event_id"], ignore_index=True)
        if self.kept.exists():
            detector = detector_from_json(self.kept.get()[0], self.options)
        else:
            detector = Detector.fresh(self.options)
        folded = fold_frame(detector, frame, self.options)
        self.kept.update((detector_to_json(detector),))
        yield folded[WATCHED_SCHEMA.fieldNames()]

    def close(self) -> None:
        pass


def exact_stream(
    events: DataFrame, options: DetectorOptions, start: DataFrame | None = None
) -> DataFrame:
    """Detections of a stream of events with features, id, shard and label.

    State is one detector per shard in the state store, so it survives restarts from the
    query's checkpoint. ``start`` (shard, detector; see ``load_detectors``) is what the first run
    begins with; a restart goes on from its checkpoint. Needs the RocksDB state store provider.
    """
    ship_package(events.sparkSession)
    kept = None if start is None else start.select("shard", "detector").groupBy("shard")
    return (
        fold_input(events, options)
        .groupBy("shard")
        .transformWithStateInPandas(
            statefulProcessor=ShardDetector(options),
            outputStructType=WATCHED_SCHEMA,
            outputMode="Append",
            timeMode="None",
            initialState=kept,
        )
    )


def stream_detectors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(shard, detector) as the last finished batch of a stopped :func:`exact_stream` left them.

    Read from the state store of its checkpoint, so nothing has to be kept beside it; save them
    with ``save_detectors`` to start another stream or a batch fold.
    """
    state = spark.read.format("statestore").option("stateVarName", "detector").load(checkpoint)
    return state.select(F.col("key.shard").alias("shard"), F.col("value.detector").alias("detector"))
