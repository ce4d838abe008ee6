"""Event streams in and out: Kafka on a cluster, files anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewarden.functions.draws import shard_of

# The producer's delivery settings.
PRODUCER_SETTINGS = {
    "kafka.acks": "1",
    "kafka.retries": "3",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
    "kafka.buffer.memory": "33554432",
    "kafka.compression.type": "snappy",
}
RECORDS_PER_SECOND = 1000
TRIGGER_SECONDS = 5
FILES_PER_TRIGGER = 64


def kafka_source_options(servers: str, topic: str, partitions: int = 3) -> dict[str, str]:
    """Start at the latest offsets and admit at most the configured rate per trigger."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(RECORDS_PER_SECOND * TRIGGER_SECONDS * partitions),
    }


def read_event_stream(
    spark: SparkSession, kind: str, location: str, topic: str | None = None, **options
) -> DataFrame:
    """A streaming frame with a JSON ``value`` column.

    ``kind`` is ``kafka`` (``location`` lists the servers) or ``text`` (``location`` is a
    folder of files with one record per line). A batch is limited either way: by offsets, or by
    ``maxFilesPerTrigger`` files (:data:`FILES_PER_TRIGGER` unless set).
    """
    reader = spark.readStream.format(kind)
    if kind == "kafka":
        settings = {**kafka_source_options(location, topic), **options}
        return reader.options(**settings).load().select(F.col("value").cast("string"))
    if kind == "text":
        settings = {"maxFilesPerTrigger": str(FILES_PER_TRIGGER), **options}
        return reader.options(**settings).load(location).select("value")
    raise ValueError(f"unknown stream kind {kind!r}")


def write_event_stream(
    records: DataFrame, kind: str, location: str, checkpoint: str, topic: str | None = None
) -> DataStreamWriter:
    """A writer for ``key`` and ``value`` columns; start it with ``.start()``."""
    columns = ("value",) if kind == "text" else ("key", "value")
    writer = records.select(*columns).writeStream.option("checkpointLocation", checkpoint)
    if kind == "kafka":
        settings = {"kafka.bootstrap.servers": location, "topic": topic, **PRODUCER_SETTINGS}
        return writer.format("kafka").options(**settings)
    return writer.format(kind).option("path", location)


def publish_events(records: DataFrame, servers: str, topic: str) -> None:
    """Write a batch of ``key`` and ``value`` rows to a topic."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_SETTINGS}
    records.write.format("kafka").options(**settings).save()


def with_record_ids(records: DataFrame, value: str = "value") -> DataFrame:
    """Add ``record_id``, a hash of the record's own text: the same in every replay."""
    return records.withColumn("record_id", F.xxhash64(value))


def with_event_ids(events: DataFrame, shards: int, event_id: Column | None = None) -> DataFrame:
    """Add the id and the shard an event from the wire is learned under.

    The id is ``event_id`` where one is given and not null, else ``record_id`` (see
    :func:`with_record_ids`), which no clock enters: records without a time keep their id in a replay.
    """
    own = F.col("record_id") if event_id is None else F.coalesce(event_id, F.col("record_id"))
    return events.withColumn("event_id", own).withColumn("shard", shard_of("event_id", shards))
