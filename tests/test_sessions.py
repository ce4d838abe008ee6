"""Sessions of raw events as traffic, in a batch, in a stream, and under the detectors."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewarden.learning.exact import detections_of, exact_fold
from tidewarden.operators.metrics import CELLS, detection_metrics
from tidewarden.operators.sessions import KINDS, session_traffic, session_traffic_stream
from tidewarden.schema import FEATURES, DetectorOptions
from tidewarden.streaming.exact import exact_stream
from tidewarden.streaming.live import LiveSnapshots, live_report
from tidewarden.streaming.pipeline import observed, write_detections

START = dt.datetime(2024, 1, 1)
GAP = 600
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def drawn_events():
    """One user holds most events; values, types and properties are missing here and there."""
    draw = random.Random(2)
    rows, at = [], 0.0
    for i in range(1500):
        at += draw.choice([1, 30, 200, 400])
        user = 1 if draw.random() < 0.6 else draw.choice([2, 3, 4, None])
        props = draw.choice([None, "not json", json.dumps({"k": draw.randint(0, 99)}), json.dumps({"k": "x"}), "{}"])
        value = draw.choice([None, round(draw.random() * 100, 2), float("nan")]) if i % 9 == 0 else round(draw.random() * 50, 2)
        rows.append((i, START + dt.timedelta(seconds=at), user, draw.choice([*KINDS, "purchase", "other", None]), value, props))
    return rows


def plain_sessions(rows):
    """first event -> (end, label, 14 slots)."""
    found, open_sessions = [], {}
    for row in rows:
        own = open_sessions.get(row[2])
        if own is None or (row[1] - own[-1][1]).total_seconds() >= GAP:
            own = open_sessions[row[2]] = []
            found.append(own)
        own.append(row)
    out = {}
    for own in found:
        n, count = len(own), lambda kind, own=own: sum(r[3] == kind for r in own)
        micros = (own[-1][1] - own[0][1]) // dt.timedelta(microseconds=1)
        total = sum(Decimal(str(r[4])) for r in own if r[4] is not None and r[4] == r[4])
        numbers = [json.loads(r[5])["k"] for r in own if r[5] and r[5].startswith("{\"k\": ") and r[5] != '{"k": "x"}']
        slots = [n, float(total) / n, sum(count(k) > 0 for k in KINDS), count("click") / n, count("view") / n, micros // 1_000_000, count("view"),
                 count("error"), micros / (n - 1) / 1000 if n > 1 else 0, sum(r[5] is not None for r in own), count("click") > 0, count("signup") > 0, 0,
                 "HTTP/2" if numbers and max(numbers) >= 50 else "HTTP/1.1"]
        out[own[0][0]] = (own[-1][1], count("purchase") > 0, slots)
    return out


@pytest.mark.parametrize("width", [None, 700])
def test_sessions_equal_the_plain_reading(spark, width):
    rows = drawn_events()
    table = spark.createDataFrame(rows, SCHEMA).withColumn("chunk", F.lit(1)).withColumn("n", F.lit("x"))
    found = {r["event_id"]: r for r in session_traffic(table.repartition(7), GAP, 3, width).collect()}
    plain = plain_sessions(rows)
    assert set(found) == set(plain) and len(plain) > 100
    for first, (end, label, slots) in plain.items():
        row = found[first]
        assert row["ts"] == end and row["is_bot"] == label and 0 <= row["shard"] < 3
        assert all(row[name] == s if isinstance(s, str) else abs(row[name] - s) < 1e-9 for name, s in zip(FEATURES, slots, strict=True))
    assert session_traffic(table.limit(0), GAP, 3, width).isEmpty()


def test_chained_stream_equals_batch_and_reports_live(spark, tmp_path):
    """Sessions from a stream go straight on to the keyed detectors; a listener reports every batch."""
    rows = [r for r in drawn_events() if r[2] is not None]
    table = spark.createDataFrame(rows, SCHEMA)
    for part in range(3):
        table.filter(F.floor(F.col("event_id") / 500) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    options = DetectorOptions(n_models=2, drift_delta=0.3)
    found = observed(exact_stream(session_traffic_stream(stream, GAP, "0 seconds", 3), options))
    live = LiveSnapshots()
    spark.streams.addListener(live)
    try:
        write_detections(found, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(180)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(live)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = session_traffic(table, GAP, 3).filter(F.unix_micros("ts") + GAP * 1_000_000 <= F.unix_micros(F.lit(rows[-1][1])))
    columns = ("event_id", "shard", "is_bot_pred", "bot_votes", "drift", "window_length", "instance_number")
    whole = detections_of(exact_fold(batch, options)).cache()
    assert streamed.count() == whole.count() > 100
    assert streamed.select(*columns).exceptAll(whole.select(*columns)).isEmpty()
    live.drain_to(spark, str(tmp_path / "live"), 0)
    report = live_report(spark.read.parquet(str(tmp_path / "live"))).orderBy("batch").collect()
    # a row a batch; the last batch has no records and detects the sessions that close behind them
    assert [r["batch"] for r in report] == [0, 1, 2, 3] and report[-1]["records"] == len(rows)
    plain = detection_metrics(whole).first()
    assert all(report[-1][name] == plain[name] for name in (*CELLS, "precision", "recall", "f1", "accuracy"))
    assert report[-1]["events"] == plain["detections"] and live.drain(spark).isEmpty()
