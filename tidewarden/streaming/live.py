"""Live figures of a running stream: one row a batch, from what the batch observed and its progress."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewarden.operators.metrics import CELLS, rates
from tidewarden.streaming.pipeline import OBSERVED

_COUNTS = ("events", "bots", *CELLS)
LIVE_SCHEMA = (
    "run string, batch bigint, at timestamp, records bigint, records_per_second double, "
    + ", ".join(f"{name} bigint" for name in _COUNTS)
)


class LiveSnapshots(StreamingQueryListener):
    """Collects a row for every batch of the streams whose detections are ``observed``.

    Add it with ``spark.streams.addListener``. :meth:`drain` hands out the rows so far as a
    table and forgets them; called now and then, what is held stays small.
    """

    def __init__(self, name: str = OBSERVED):
        self.name, self._rows, self._lock = name, [], Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None or not (progress.numInputRows or seen["events"]):
            return
        row = (str(progress.runId), progress.batchId, progress.timestamp, progress.numInputRows, progress.processedRowsPerSecond)
        with self._lock:
            self._rows.append((*row, *(seen[name] for name in _COUNTS)))

    def drain(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows, self._rows = self._rows, []
        text = LIVE_SCHEMA.replace("at timestamp", "at string")
        return spark.createDataFrame(rows, text).withColumn("at", F.to_timestamp("at"))

    def drain_to(self, spark: SparkSession, path: str, number: int) -> None:
        """Write the rows so far as one numbered part of a log."""
        self.drain(spark).write.mode("overwrite").parquet(f"{path}/part={number}")


def live_report(snapshots: DataFrame) -> DataFrame:
    """Counts and metrics so far after every batch, in the order of the batches of a run."""
    so_far = Window.partitionBy("run").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)  # a row a batch
    summed = snapshots.select("run", "batch", "at", "records_per_second", *[F.sum(c).over(so_far).alias(c) for c in ("records", *_COUNTS)])
    return summed.withColumns(rates(*[F.col(c) for c in CELLS]))
