"""The adaptive window over blocks against a plain reading, event by event."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewarden.learning.adwin import AdaptiveWindow
from tidewarden.operators import drift, windows
from tidewarden.sources.model_store import numbered_folders

DELTA, LEVEL, BLOCK = 0.002, 0.05, 32
START = dt.datetime(2024, 1, 1)
SCHEMA = "shard int, ts timestamp, event_id long, is_bot_pred boolean, is_bot boolean"


def drawn_errors():
    """Shards whose error rate stays, steps once, and steps several times; one short, one of a single block."""
    draw = random.Random(4)
    rates = {0: [0.04] * 20, 1: [0.02] * 12 + [0.6] * 12, 2: ([0.05] * 10 + [0.9] * 10) * 2, 3: [0.5], 4: [0.0] * 3, 5: [1.0] * 4}
    errors = {s: [int(draw.random() < p) for p in blocks for _ in range(BLOCK)] for s, blocks in rates.items()}
    errors[3] = errors[3][:7]
    errors[1] = errors[1][:-5]
    return errors


def plain_watch(errors, reset):
    """(rate, width, drift, zone, entered, left) of every row, and the window at the end."""
    window, zone, out = AdaptiveWindow(DELTA), False, []
    for at in range(0, len(errors), BLOCK):
        block = errors[at : at + BLOCK]
        width, total = window.width, window.total
        drift_found = window.add(sum(block), len(block))
        for place, error in enumerate(block):
            total, width = total + error, width + 1
            last = place == len(block) - 1
            rate, length = (window.estimate, window.width) if last else (total / width, width)
            found = last and drift_found
            now = not found and rate > LEVEL
            out.append((rate, length, found, now, now and not zone, zone and not now and not found))
            zone = now
        if drift_found and reset:
            window = AdaptiveWindow(DELTA)
    return out, window


@pytest.fixture(scope="module")
def detections(spark):
    rows = [
        (s, START + dt.timedelta(minutes=i), i, bool(e), False)
        for s, errors in drawn_errors().items() for i, e in enumerate(errors)
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def sums(detections):
    return windows.error_sums(drift.running_error(detections)).cache()


@pytest.mark.parametrize("reset", [True, False])
def test_watch_equals_the_plain_reading(detections, reset):
    watched = windows.watch(detections, DELTA, LEVEL, reset)
    found = {}
    for r in watched.collect():
        found.setdefault(r["shard"], {})[r["event_id"]] = (
            r["error_rate"], r["window_length"], r["drift"], r["in_warning_zone"], r["warning_entered"], r["warning_left"])
    drifts = []
    for shard, errors in drawn_errors().items():
        plain, _ = plain_watch(errors, reset)
        assert [found[shard][i] for i in range(len(errors))] == plain
        drifts.append(sum(row[2] for row in plain))
    assert max(drifts) > 1 and ({0, 1} <= set(drifts) if reset else 0 in drifts)
    history = windows.watched_history(watched)
    assert history.filter("type = 'DRIFT'").count() == sum(drifts)
    summary = {r["shard"]: r for r in drift.drift_summary(watched, history, reset).collect()}
    assert [summary[s]["drifts"] for s in sorted(summary)] == drifts
    assert summary[3]["window_length"] == 7 and summary[5]["in_warning_zone"]


def test_histograms_are_handed_on(spark, sums, tmp_path):
    """Any span length, and a run stopped between spans, give what one fold gives."""
    whole = windows.fold_windows(sums, DELTA).cache()
    rows = sorted(map(tuple, windows.block_windows(whole).collect()))
    buckets = sorted(map(tuple, windows.histogram(windows.final_windows(whole)).collect()))
    for shard, errors in drawn_errors().items():
        _, window = plain_watch(errors, True)
        plain = [(shard, level, place, n, s) for level, row in enumerate(window.rows) for place, (n, s) in enumerate(row)]
        assert [b for b in buckets if b[0] == shard] == plain
    path = str(tmp_path / "spans")
    windows.windows_in_segments(sums.filter("block < 14"), DELTA, 7, path=path)
    for place in (path, None):
        blocks, final = windows.windows_in_segments(sums, DELTA, 7, path=place)
        assert sorted(map(tuple, blocks.collect())) == rows
        assert sorted(map(tuple, windows.histogram(final).collect())) == buckets


def test_many_spans_are_written_together(spark, sums, tmp_path, monkeypatch):
    """Few writes for many spans, and the histogram at the end of each of them."""
    path = str(tmp_path / "spans")
    blocks, final = windows.windows_in_segments(sums, DELTA, 1, path=path)
    assert numbered_folders(spark, path, "span") == [39]
    assert blocks.count() == sums.count()
    state = spark.read.schema(windows._FOLD).parquet(f"{path}/span=39")
    for span in (0, 2, 13, 30):
        plain = windows.final_windows(windows.fold_windows(sums.filter(F.col("block") <= span), DELTA))
        kept = windows.final_windows(state.filter(F.col("span") == span))
        assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    monkeypatch.setattr(windows, "SPANS_PER_WRITE", 16)
    again, last = windows.windows_in_segments(sums, DELTA, 1, path=str(tmp_path / "more"))
    assert numbered_folders(spark, str(tmp_path / "more"), "span") == [15, 31, 39]
    assert sorted(map(str, last.collect())) == sorted(map(str, final.collect()))
    assert sorted(map(str, again.collect())) == sorted(map(str, blocks.collect()))


def test_nothing_to_watch(spark, detections):
    none = detections.limit(0)
    assert windows.watch(none, DELTA, LEVEL).isEmpty()
    blocks, final = windows.windows_in_segments(windows.error_sums(drift.running_error(none)), DELTA, 5)
    assert blocks.isEmpty() and final.isEmpty()
    assert drift.retrain_flags(windows.watched_history(windows.watch(detections.filter("shard = 4"), DELTA, LEVEL))).isEmpty()
    assert detections.filter("shard = 4").agg(F.count("*")).first()[0] == 96
