"""The micro-batch job: decode, set bad records apart, detect, learn, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewarden.learning.exact import detections_of
from tidewarden.learning.mixing import ROWS_PER_SLICE, MixRun, mix_batch, sliced
from tidewarden.operators.ensemble import initial_state, shard_list
from tidewarden.operators.metrics import cell_flags, detection_metrics
from tidewarden.schema import DetectorOptions
from tidewarden.sources.codec import CORRUPT, apply_defaults, decode_events, split_bad_records
from tidewarden.sources.model_store import append_log, is_written, save_model, versions
from tidewarden.sources.streams import TRIGGER_SECONDS, with_event_ids, with_record_ids


#: Name under which a stream's detections are counted.
OBSERVED = "detections"


def decoded_stream(
    records: DataFrame, shards: int, event_id: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events ready for detection, rejected records) of a ``value`` stream."""
    good, rejected = split_bad_records(decode_events(with_record_ids(records)))
    return with_event_ids(apply_defaults(good), shards, event_id), rejected.select("reason", CORRUPT)


class MixingBatches:
    """``foreachBatch`` handler: one :func:`mix_batch` per micro-batch.

    Everything it writes is keyed by the batch id, so a batch that is run again after a
    failure replaces its own output.
    """

    def __init__(
        self, run: MixRun, options: DetectorOptions, rows_per_slice: int = ROWS_PER_SLICE
    ):
        self.run, self.options, self.rows_per_slice = run, options, rows_per_slice
        if not versions(run.spark, run.models_path):
            save_model(initial_state(shard_list(run.spark, 1), options), run.models_path, 0)

    def __call__(self, records: DataFrame, batch: int) -> None:
        if records.isEmpty():
            return
        decoded = decode_events(with_record_ids(records)).persist()  # read three times below
        try:
            good, rejected = split_bad_records(decoded)
            append_log(rejected.select("reason", CORRUPT), f"{self.run.root}/rejected", batch)
            events = with_event_ids(apply_defaults(good), 1)
            path = f"{self.run.slices_path}/batch={batch}"
            if not is_written(self.run.spark, path):
                cut = sliced(events, self.options, self.rows_per_slice)
                cut.write.mode("overwrite").parquet(path)
        finally:
            decoded.unpersist()
        slices = self.run.spark.read.parquet(path)
        if slices.isEmpty():
            return
        mix_batch(self.run, slices, batch, self.options)
        found = detections_of(self.run.spark.read.parquet(f"{self.run.folds_path}/batch={batch}"))
        append_log(detection_metrics(found), f"{self.run.root}/metrics", batch)


def mixing_stream(
    records: DataFrame, handler: MixingBatches, checkpoint: str
) -> DataStreamWriter:
    """A writer that hands every micro-batch of ``value`` rows to the handler."""
    return (
        records.writeStream.option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{TRIGGER_SECONDS} seconds")
        .foreachBatch(handler)
    )


def write_detections(detections: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        detections.writeStream.option("checkpointLocation", checkpoint)
        .format("parquet")
        .option("path", path)
    )


def observed(detections: DataFrame, name: str = OBSERVED) -> DataFrame:
    """Attach per-batch counts, reported to streaming query listeners (see :mod:`tidewarden.streaming.live`)."""
    right = F.col("is_bot_pred") == F.col("is_bot")
    cells = cell_flags(F.col("is_bot_pred"), F.col("is_bot"))
    return detections.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_bot_pred").alias("bots"),
        F.count_if(right).alias("correct"),
        *[F.coalesce(F.sum(flag), F.lit(0)).alias(cell) for cell, flag in cells.items()],
    )


def bounded_run(query: StreamingQuery, seconds: float) -> dict:
    """Let a query run for a while, stop it, and return its last progress."""
    query.awaitTermination(seconds)
    progress = query.lastProgress
    query.stop()
    return {} if progress is None else {
        "batch": progress["batchId"],
        "rows": progress["numInputRows"],
        "rows_per_second": progress["processedRowsPerSecond"],
    }
