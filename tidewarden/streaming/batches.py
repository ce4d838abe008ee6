"""The exact micro-batch job: decode, set bad records apart, detect and learn in order, save, report.

Every batch starts from the detectors the batch before it saved and writes all it produces under
its own number, so a batch that is run again after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.learning.exact import EXACT_SCHEMA, detections_of, exact_fold, final_detectors
from tidewarden.operators.metrics import detection_metrics
from tidewarden.schema import DetectorOptions
from tidewarden.sources.codec import CORRUPT, apply_defaults, decode_events, is_bad, split_bad_records
from tidewarden.sources.model_store import append_log, load_detectors, newest_version, read_log, save_detectors
from tidewarden.sources.streams import with_event_ids, with_record_ids


@dataclass(frozen=True)
class ExactRun:
    """Where a job keeps its tables."""

    spark: SparkSession
    root: str

    @property
    def detectors_path(self) -> str:
        return f"{self.root}/detectors"

    def detections(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/detections")

    def rejected(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/rejected")

    def batches(self) -> DataFrame:
        """One row a batch: records read, good and rejected ones, and the metrics of its detections."""
        return read_log(self.spark, f"{self.root}/batches")

    def detectors(self) -> DataFrame:
        """The detectors the newest batch left, to start another run from."""
        return load_detectors(self.spark, self.detectors_path)


class ExactBatches:
    """``foreachBatch`` handler over ``value`` records: one ordered fold a shard and micro-batch.

    ``start`` holds detectors to begin with. ``event_id`` is the column to take the id from (after
    decoding); without it, an event's id is a hash of its record's own text. A batch without
    records writes nothing.
    """

    def __init__(
        self, run: ExactRun, options: DetectorOptions, shards: int,
        event_id: Callable[[], Column] | None = None, start: DataFrame | None = None,
    ):
        self.run, self.options, self.shards, self.event_id, self.start = run, options, shards, event_id, start

    def _before(self, batch: int) -> DataFrame | None:
        earlier = newest_version(self.run.spark, self.run.detectors_path, below=batch)
        return self.start if earlier is None else load_detectors(self.run.spark, self.run.detectors_path, earlier)

    def __call__(self, records: DataFrame, batch: int) -> None:
        if records.isEmpty():
            return
        spark, root = self.run.spark, self.run.root
        decoded = decode_events(with_record_ids(records))
        append_log(decoded, f"{root}/decoded", batch)
        decoded = spark.read.schema(decoded.schema).parquet(f"{root}/decoded/batch={batch}")
        good, rejected = split_bad_records(decoded)
        append_log(rejected.select("reason", CORRUPT), f"{root}/rejected", batch)
        events = with_event_ids(apply_defaults(good), self.shards, self.event_id and self.event_id())
        folded = exact_fold(events, self.options, self._before(batch))
        append_log(folded, f"{root}/folds", batch)
        folded = spark.read.schema(EXACT_SCHEMA).parquet(f"{root}/folds/batch={batch}")
        found = detections_of(folded)
        append_log(found, f"{root}/detections", batch)
        counts = decoded.agg(
            F.lit(batch).alias("_batch"), F.count(F.lit(1)).alias("records"), F.count_if(is_bad()).alias("rejected")
        )
        measured = detection_metrics(found.withColumn("_batch", F.lit(batch)), "_batch")
        append_log(counts.join(measured, "_batch", "left").drop("_batch"), f"{root}/batches", batch)
        save_detectors(final_detectors(folded), self.run.detectors_path, batch)


def exact_batches(records: DataFrame, handler: ExactBatches, checkpoint: str):
    """A writer that hands every micro-batch of ``value`` rows to the handler; set its trigger and start it."""
    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handler)
