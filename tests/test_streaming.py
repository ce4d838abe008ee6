"""Streams give what a batch over the same rows gives."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewarden.learning.exact import detections_of, exact_fold, final_detectors
from tidewarden.learning.mixing import MixRun
from tidewarden.plans import queries
from tidewarden.operators.metrics import metric_evolution
from tidewarden.operators.sessions import session_features, session_features_stream
from tidewarden.schema import DetectorOptions
from tidewarden.sources.codec import encode_events
from tidewarden.sources.model_store import read_log
from tidewarden.sources.streams import (
    kafka_source_options,
    read_event_stream,
    write_event_stream,
)
from tidewarden.streaming.batches import ExactBatches, ExactRun, exact_batches
from tidewarden.streaming.exact import exact_stream, stream_detectors
from tidewarden.streaming.pipeline import (
    MixingBatches,
    bounded_run,
    decoded_stream,
    mixing_stream,
    observed,
    write_detections,
)

OPTIONS = DetectorOptions(n_models=3, drift_delta=0.3)


def write_records(traffic, folder, extra=()):
    """Four files of JSON lines, in event order over the files."""
    spark = traffic.sparkSession
    encoded = encode_events(traffic, "event_id").repartitionByRange(4, "event_id")
    encoded.sortWithinPartitions("event_id").select("value").write.text(str(folder))
    if extra:
        rows = spark.createDataFrame([(line,) for line in extra], "value string").coalesce(1)
        rows.write.mode("append").text(str(folder))


def test_exact_stream_equals_batch(spark, traffic, tmp_path):
    write_records(traffic, tmp_path / "in")
    records = read_event_stream(spark, "text", str(tmp_path / "in"))
    events, _ = decoded_stream(records, shards=2)
    writer = write_detections(
        observed(exact_stream(events, OPTIONS)), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(120)
    counts = [p["observedMetrics"].get("detections") for p in query.recentProgress]
    assert sum(c["events"] for c in counts if c) == 1000
    streamed = spark.read.parquet(str(tmp_path / "out"))

    wire, _ = decoded_stream(spark.read.text(str(tmp_path / "in")), 2)
    batch = detections_of(exact_fold(wire, OPTIONS))
    assert streamed.count() == 1000
    columns = ("event_id", "is_bot_pred", "vote", "bot_votes", "drift", "warning", "window_length")
    assert streamed.select(*columns).exceptAll(batch.select(*columns)).isEmpty()


def test_exact_stream_keeps_state_over_batches_and_restarts(spark, keyed, tmp_path):
    from derived_traffic import TrafficOptions, labelled_traffic

    ordered = labelled_traffic(keyed, TrafficOptions(shards=2))
    for part in range(2):
        half = ordered.filter(F.col("event_id").between(part * 500, part * 500 + 499))
        half.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ordered.schema).parquet(str(tmp_path / "in"))
        writer = write_detections(
            exact_stream(stream, OPTIONS), str(tmp_path / "out"), str(tmp_path / "cp")
        )
        writer.trigger(availableNow=True).start().awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = detections_of(exact_fold(ordered, OPTIONS))
    columns = ("event_id", "is_bot_pred", "bot_votes", "drift", "window_length", "instance_number")
    assert streamed.count() == 1000
    assert streamed.select(*columns).exceptAll(batch.select(*columns)).isEmpty()


def test_stream_starts_from_saved_detectors_and_leaves_its_own(spark, keyed, tmp_path):
    """Fold, stream, stream again after a restart: together one fold, also in the state that is left."""
    from derived_traffic import TrafficOptions, labelled_traffic

    ordered = labelled_traffic(keyed, TrafficOptions(shards=3))
    before = exact_fold(ordered.filter("event_id < 300"), OPTIONS).cache()
    start = final_detectors(before)
    for part in range(2):
        later = ordered.filter(F.col("event_id").between(300 + part * 350, 649 + part * 350))
        later.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ordered.schema).parquet(str(tmp_path / "in"))
        writer = write_detections(exact_stream(stream, OPTIONS, start), str(tmp_path / "out"), str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination(120)
    whole = exact_fold(ordered, OPTIONS).cache()
    columns = ("event_id", "is_bot_pred", "bot_votes", "drift", "window_length", "instance_number")
    found = detections_of(before).select(*columns).unionByName(spark.read.parquet(str(tmp_path / "out")).select(*columns))
    assert found.count() == 1000 and found.exceptAll(detections_of(whole).select(*columns)).isEmpty()
    kept, plain = ({r["shard"]: json.loads(r["detector"]) for r in d.collect()} for d in (stream_detectors(spark, str(tmp_path / "cp")), final_detectors(whole)))
    assert set(kept) == set(plain) == {0, 1, 2}
    for shard, one in kept.items():
        models, others = one.pop("models"), plain[shard].pop("models")
        assert one == plain[shard]  # window, zone and counters
        for a, b in zip(models, others, strict=True):
            assert a.pop("rules") == b.pop("rules")
            for name in ("mean", "m2", "weights"):  # sums of other blocks of rows, so other last digits
                assert a.pop(name) == pytest.approx(b.pop(name), rel=1e-9)
            assert a == b


def test_exact_batches_run_again_and_replayed(spark, traffic, tmp_path):
    """A batch run twice, and a replay of records without a time, give the same ids and results."""
    untimed = F.regexp_replace("value", '"timestamp":[0-9]+,', "")
    records = encode_events(traffic, "event_id").withColumn("value", F.when(F.col("event_id") % 10 == 0, untimed).otherwise(F.col("value")))
    parts = [records.filter(F.col("event_id") % 2 == k).select("value") for k in range(2)]
    runs = [ExactRun(spark, str(tmp_path / f"run{k}")) for k in range(2)]
    for run, batches in zip(runs, ([0, 1], [0, 0, 1, 0, 1])):
        handler = ExactBatches(run, OPTIONS, shards=2)
        for batch in batches:
            handler(parts[batch], batch)
        handler(parts[0].limit(0), 2)
        assert {r["batch"]: (r["records"], r["rejected"], r["detections"]) for r in run.batches().collect()} == {0: (500, 0, 500), 1: (500, 0, 500)}
    columns = ("event_id", "shard", "is_bot", "batch")
    first, second = (run.detections().select(*columns) for run in runs)
    assert first.count() == 1000 and first.exceptAll(second).isEmpty()
    assert runs[0].detectors().count() == 2


def test_exact_batches_report_rejects(spark, tmp_path):
    bad = ['{"sessionId":', "null", '{"sessionId":"y"}', '{"sessionId":"z","httpVersion":"HTTP/2"}', '{"sessionId":"z","httpVersion":"HTTP/2"}']
    for k, line in enumerate(bad):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    run = ExactRun(spark, str(tmp_path / "run"))
    records = read_event_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="2")
    writer = exact_batches(records, ExactBatches(run, OPTIONS, shards=1), str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination(120)
    counts = {r["batch"]: (r["records"], r["rejected"], r["detections"]) for r in run.batches().collect()}
    assert counts == {0: (2, 2, None), 1: (2, 1, 1), 2: (1, 0, 1)}
    assert {r["reason"] for r in run.rejected().collect()} == {"unparsable", "null_event", "missing_http_version"}


def test_mixing_stream_counts_every_good_record(spark, traffic, tmp_path):
    bad = ['{"sessionId":', "null", '{"sessionId":"x","errorRate":"zz","httpVersion":"HTTP/2"}',
           '{"sessionId":"y"}']
    write_records(traffic, tmp_path / "in", bad)
    records = read_event_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger=2)
    run = MixRun(spark, str(tmp_path / "run"))
    quiet = OPTIONS.with_(drift_enabled=False)
    handler = MixingBatches(run, quiet, rows_per_slice=100)
    writer = mixing_stream(records, handler, str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination(300)
    assert run.detections().count() == 1000
    assert read_log(spark, f"{run.root}/rejected").count() == len(bad)
    state = run.state().collect()
    assert len(state) == OPTIONS.n_models and all(row["seen"] == 1000 for row in state)
    totals = read_log(spark, f"{run.root}/metrics").agg(F.sum("detections")).first()[0]
    assert totals == 1000


def test_mixing_batch_run_twice_changes_nothing(spark, traffic, tmp_path):
    run = MixRun(spark, str(tmp_path / "run"))
    handler = MixingBatches(run, OPTIONS.with_(drift_enabled=False), rows_per_slice=300)
    records = encode_events(traffic).select("value")
    handler(records, 0)
    first = run.state().drop("rules").collect()
    handler(records, 0)
    assert sorted(run.state().drop("rules").collect()) == sorted(first)
    assert run.detections().count() == 1000
    handler(records.limit(0), 1)
    assert run.detections().count() == 1000


def test_event_writer_round_trip(spark, traffic, tmp_path):
    traffic.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(traffic.schema).parquet(str(tmp_path / "events"))
    writer = write_event_stream(
        encode_events(stream), "text", str(tmp_path / "lines"), str(tmp_path / "cp")
    )
    query = writer.trigger(availableNow=True).start()
    assert bounded_run(query, 60) is not None
    assert spark.read.text(str(tmp_path / "lines")).count() == 1000


def test_session_stream_equals_batch(spark, tmp_path):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw = raw.withColumn("ts", F.col("ts").cast("timestamp"))
    raw.filter("event_id < 500").coalesce(1).write.parquet(str(tmp_path / "in"))
    raw.filter("event_id >= 500").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    sessions = session_features_stream(stream, 8 * 3600, "30 days")
    query = (
        sessions.writeStream.format("memory").queryName("sessions").outputMode("complete")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination(120)
    columns = ("user_id", "session_start", "session_end", "events", "errors")
    batch = session_features(raw, 8 * 3600).select(*columns)
    assert spark.table("sessions").select(*columns).exceptAll(batch).isEmpty()
    assert spark.table("sessions").count() == batch.count()


def test_metric_evolution_on_a_stream(spark, traffic, tmp_path):
    found = detections_of(exact_fold(traffic, OPTIONS)).select("shard", "ts", "is_bot_pred", "is_bot")
    found.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(found.schema).parquet(str(tmp_path / "in"))
    query = (
        metric_evolution(stream.withWatermark("ts", "1 hour"), "1 day")
        .writeStream.format("memory").queryName("evolution").outputMode("complete")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination(120)
    batch = metric_evolution(found, "1 day")
    assert spark.table("evolution").exceptAll(batch).isEmpty()


def test_admission_limit(spark, tmp_path):
    for k in range(3):
        spark.range(1).selectExpr("'x' as value").write.mode("append").text(str(tmp_path / "in"))
    stream = read_event_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert kafka_source_options("h:9092", "t")["maxOffsetsPerTrigger"] == "15000"


def test_keyed_streams_have_few_state_stores(spark, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        for given, shards, width in ((600, 8, 48), (600, 36, 144), (20, 8, 20)):
            spark.conf.set(name, str(given))
            monkeypatch.setattr(queries, "_shards", lambda spark, shards=shards: shards)
            with queries._keyed_state(spark):
                assert int(spark.conf.get(name)) == width
            assert int(spark.conf.get(name)) == given
    finally:
        spark.conf.set(name, before)
